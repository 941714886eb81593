"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insult, threat, target, negation, report or other. Five small transducers read the
symbols of a clause one after another, each rewriting what the one before it wrote: an insult is a
hit; a threat is one once a target stands in the same clause; a target makes later hits count more; a
negation makes hits in the next words count less; reported speech (a verb of saying, a quotation
mark) makes all later hits of the clause count less. They are composed into one machine up front. A clause scores the
sum of its hits' lexical weights times what the machine gives them.

The lexicon starts from the short lists below; insults are added from a bounded sample of labelled rows: word
beginnings and words that toxic documents have far more often, weighted by their log odds. A beginning
is lengthened while nearly all its occurrences share the next letter. A logistic regression turns the best
and the summed clause scores into the document's score; it is fitted on scores that each half of the sample gets
with the terms learned from the other half.

Defined cases: a null, empty or wordless text has no clause and gets the score of a document without
hits; without labelled rows of both classes the lists and fixed calibration are used; labels other
than 0 and 1 and null ids are not learned from; null ids and repeated rows are scored like others; an
empty table gives no rows. Other columns are neither read nor changed. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import free_name, id_and_text, labelled_sample, staged

SAMPLE_ROWS = 8000
THRESHOLD = 0.3
SHORTEST, LONGEST = 4, 12  # letters of a learned beginning
LEAST_ROWS = 4  # toxic rows that must hold a learned word, whatever their number, so that small languages count too
LEAST_WEIGHT = 3.0
DOUBT = 2.0  # clean rows that a term is taken to have been in besides those seen
LISTED_WEIGHT = 4.0
SHARED_NEXT = 0.85

# The starting lexicon in English, German, French and Spanish.
INSULTS = (
    "idiot stupid moron scum pathetic worthless loser disgusting imbecile dumb "
    "dummkopf trottel abschaum versager idiotisch imbécile abruti connard ordure estúpido imbécil basura inútil"
).split()
THREATS = "kill hurt destroy beat töten umbringen verletzen tuer frapper détruire matar golpear destruir".split()
TARGETS = (
    "you your yourself he she they them him her du dich dir dein ihr euch sie "
    "tu toi vous ton votre usted ustedes tú te ti él ella"
).split()
NEGATIONS = "not no never isn't aren't don't nicht nie kein keine ne pas jamais nunca jamás".split()
REPORTS = (
    "said says say quoted reported wrote told sagte sagt schrieb meldete dit disait écrit dijo dice escribió"
).split()

INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER, HIT = "insult", "threat", "target", "negation", "report", "other", "hit"
SYMBOLS = (INSULT, THREAT, TARGET, NEGATION, REPORT, OTHER)
NEGATED_WORDS = 3
BY_TARGET, BY_NEGATION, BY_REPORT = 1.25, 0.25, 0.5

_CLAUSE = re.compile(r"[^.,;:!?\n|()…]+")
# A word ends at an apostrophe, as the terms it is looked up by do (l'idiot, idiot's), but for English negations.
_TOKEN = re.compile(r"[^\W_]+n['’]t(?![^\W_])|[^\W_]+|[\"“”«»„]")
_QUOTES = frozenset('"“”«»„')
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Transducer:
    """Arcs (state, symbol read) -> (next state, symbol written, factor); start state 0. A symbol without
    an arc is passed on in the same state."""

    arcs: dict[tuple[int, str], tuple[int, str, float]]

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def transducers() -> list[Transducer]:
    insult = Transducer({(0, INSULT): (0, HIT, 1.0)})
    threat = Transducer(
        {
            (0, THREAT): (1, OTHER, 1.0),  # waits for a target
            (0, TARGET): (2, TARGET, 1.0),
            (1, TARGET): (2, HIT, 1.0),
            (2, THREAT): (2, HIT, 1.0),
        }
    )
    target = Transducer({(0, TARGET): (1, OTHER, 1.0), (1, TARGET): (1, OTHER, 1.0), (1, HIT): (1, HIT, BY_TARGET)})
    scope = range(1, NEGATED_WORDS + 1)  # states: words left that a negation reaches
    negation = Transducer(
        {(left, NEGATION): (NEGATED_WORDS, OTHER, 1.0) for left in (0, *scope)}
        | {(left, symbol): (left - 1, symbol, 1.0) for left in scope for symbol in (OTHER, REPORT)}
        | {(left, HIT): (left - 1, HIT, BY_NEGATION) for left in scope}
    )
    report = Transducer({(0, REPORT): (1, OTHER, 1.0), (1, REPORT): (1, OTHER, 1.0), (1, HIT): (1, HIT, BY_REPORT)})
    return [insult, threat, target, negation, report]


def compose(chain: list[Transducer]) -> dict[tuple[tuple[int, ...], str], tuple[tuple[int, ...], float]]:
    """The chain as one machine over tuples of states: (state, symbol) -> (next state, factor of a hit)."""
    start = (0,) * len(chain)
    machine, waiting = {}, [start]
    while waiting:
        state = waiting.pop()
        for symbol in SYMBOLS:
            following, written, factor = [], symbol, 1.0
            for part, own in zip(chain, state):
                own, written, by = part.step(own, written)
                following.append(own)
                factor *= by
            after = tuple(following)
            machine[state, symbol] = (after, factor if written == HIT else 0.0)
            if (after, SYMBOLS[0]) not in machine and after != state and after not in waiting:
                waiting.append(after)
    return machine


@dataclass(frozen=True)
class Grammar:
    """``insults``: word, or beginning of words with ``*`` behind it, and weight. The score is the logistic
    function of intercept + by_best * best clause + by_sum * log(1 + sum of clauses)."""

    insults: dict[str, float]
    intercept: float = -4.0
    by_best: float = 1.0
    by_sum: float = 1.0


class Matcher:
    def __init__(self, grammar: Grammar):
        self.machine = compose(transducers())
        self.start = next(iter(self.machine))[0]
        self.insults = grammar.insults
        self.symbols = dict.fromkeys(TARGETS, TARGET) | dict.fromkeys(NEGATIONS, NEGATION) | dict.fromkeys(REPORTS, REPORT)
        self.symbols |= dict.fromkeys(THREATS, THREAT)
        # Only a clause with an insult or a threat can score: the automaton finds these at once.
        self.triggers = ahocorasick.Automaton()
        for term in [*self.insults, *THREATS]:
            self.triggers.add_word(term.rstrip("*"), len(term.rstrip("*")))
        self.triggers.make_automaton()
        self.beginnings = sorted({len(t) - 1 for t in self.insults if t.endswith("*")})

    def _read(self, token: str) -> tuple[str, float]:
        weight = self.insults.get(token)
        for size in self.beginnings if weight is None else ():
            if len(token) >= size and (weight := self.insults.get(token[:size] + "*")) is not None:
                break
        if weight is not None:
            return INSULT, weight
        return (REPORT if token in _QUOTES else self.symbols.get(token, OTHER)), LISTED_WEIGHT

    def clause(self, clause: str) -> float:
        """Sum of the clause's hits."""
        state, total = self.start, 0.0
        for token in _TOKEN.findall(clause):
            symbol, weight = self._read(token.replace("’", "'"))
            state, factor = self.machine[state, symbol]
            total += factor * weight
        return total

    def clauses(self, text: str) -> tuple[float, float]:
        """Best and summed score of the text's clauses."""
        text = text.lower()
        hits = [
            last + 1 - size
            for last, size in self.triggers.iter(text)
            if last < size or not text[last - size].isalnum()
        ]
        best = total = 0.0
        if hits:
            hits.sort(reverse=True)
            for found in _CLAUSE.finditer(text):
                if hits and hits[-1] < found.end():
                    while hits and hits[-1] < found.end():
                        hits.pop()
                    score = self.clause(found[0])
                    best, total = max(best, score), total + score
        return best, total


def _terms(text: str) -> set[str]:
    """The words of a text, and their beginnings with ``*``."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        found.add(word)
        found.update(word[:n] + "*" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return found


def count_terms(rows: DataFrame) -> DataFrame:
    """(term, toxic0, clean0, toxic1, clean1): numbers of rows (text, label, half) that hold a term."""
    columns = [f"{label}{half}" for half in (0, 1) for label in ("toxic", "clean")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, Counter] = {c: Counter() for c in columns}
            for text, label, half in zip(*(c.to_pylist() for c in batch.columns)):
                counts[f"{'toxic' if label else 'clean'}{half}"].update(_terms(text))
            terms = list(set().union(*counts.values()))
            numbers = {c: pa.array([counts[c][t] for t in terms], pa.int64()) for c in columns}
            yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), **numbers})

    schema = ", ".join(["term string", *(f"{c} long" for c in columns)])
    counted = rows.select("text", "label", "half").mapInArrow(run, schema)
    return counted.groupBy("term").agg(*(F.sum(c).alias(c) for c in columns))


def choose_terms(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weights of the terms that mark toxic rows; ``counts`` holds every term of enough toxic rows."""

    def weight(term: str) -> float:
        a, b = counts[term]
        return math.log(a / (toxic + 1)) - math.log((b + DOUBT) / (clean + 1))

    marked = {t for t in counts if weight(t) >= LEAST_WEIGHT}
    longer: dict[str, list[str]] = defaultdict(list)
    for term in marked:
        stem = term.rstrip("*")
        longer[(stem[:-1] if term.endswith("*") else stem) + "*"].append(term)
    chosen = {}
    for term in sorted(marked, key=len):
        stem = term.rstrip("*")
        if any(stem[:n] + "*" in marked for n in range(SHORTEST, len(stem))):
            continue  # an earlier beginning stands for it
        while term.endswith("*"):
            following = [t for t in longer[term] if counts[t][0] >= SHARED_NEXT * counts[term][0]]
            if not following:
                break
            term = min(following, key=lambda t: (t.endswith("*"), t))
        chosen[term] = weight(term)
    return chosen


def _lexicon(counts: dict[str, tuple[int, int]], toxic: int, clean: int) -> dict[str, float]:
    """The listed insults that clean rows do not use more than toxic ones, and the learned ones."""
    refuted = {t for t, (a, b) in counts.items() if b * (toxic + 1) > a * (clean + 1)}
    listed = {t: LISTED_WEIGHT for t in INSULTS if t not in refuted}
    return listed | choose_terms({t: c for t, c in counts.items() if c[0] >= LEAST_ROWS}, toxic, clean)


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> Grammar:
    """Learn ``toxic`` from at most ``sample_rows`` labelled documents whose crc32 modulo 4 is not 2."""
    rows = labelled_sample(docs, labels, "toxic", 4, 2, sample_rows, id_col, text_col).dropDuplicates(["text", "label"])
    rows = staged(rows.withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int")), "toxicity-sample")
    seen = {(r["label"], r["half"]): r["n"] for r in rows.groupBy("label", "half").agg(F.count("*").alias("n")).collect()}
    toxic, clean = ([seen.get((label, half), 0) for half in (0, 1)] for label in (1, 0))
    if not sum(toxic) or not sum(clean):
        return Grammar(dict.fromkeys(INSULTS, LISTED_WEIGHT))
    # Every listed term is counted too, so that one which clean rows use is dropped.
    often = (F.col("toxic0") + F.col("toxic1") >= 3) | F.col("term").isin(*INSULTS)
    counted = count_terms(rows).filter(often).collect()
    halves = [
        _lexicon({r["term"]: (r[f"toxic{h}"], r[f"clean{h}"]) for r in counted}, toxic[h], clean[h]) for h in (0, 1)
    ]
    both = {r["term"]: (r["toxic0"] + r["toxic1"], r["clean0"] + r["clean1"]) for r in counted}
    # Either half is scored with the terms of the other, so that calibration meets terms as new texts do.
    return calibrate(rows, halves[::-1], Grammar(_lexicon(both, sum(toxic), sum(clean))))


def calibrate(rows: DataFrame, lexicons: list[dict[str, float]], grammar: Grammar) -> Grammar:
    """``grammar`` with a calibration learned on rows (text, label, half), scored with ``lexicons[half]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matchers = [Matcher(Grammar(lexicon)) for lexicon in lexicons]
        for batch in batches:
            scores = [matchers[half.as_py()].clauses(text.as_py()) for text, half in zip(batch.column(0), batch.column(2))]
            yield pa.RecordBatch.from_pydict(
                {
                    "best": pa.array([b for b, _ in scores], pa.float64()),
                    "total": pa.array([math.log1p(t) for _, t in scores], pa.float64()),
                    "label": batch.column(1),
                }
            )

    points = rows.select("text", "label", "half").mapInArrow(run, "best double, total double, label int")
    points = staged(points.coalesce(1), "toxicity-points")
    vectors = VectorAssembler(inputCols=["best", "total"], outputCol="features").transform(points)
    model = LogisticRegression(labelCol="label", regParam=0.001, maxIter=50).fit(vectors)
    by_best, by_sum = map(float, model.coefficients)
    return Grammar(grammar.insults, float(model.intercept), by_best, by_sum)


def score_column(text: Column, grammar: Grammar) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(grammar)

        def one(text: str) -> float:
            best, total = matcher.clauses(text)
            z = grammar.intercept + grammar.by_best * best + grammar.by_sum * math.log1p(total)
            return 1 / (1 + math.exp(-min(max(z, -500), 500)))

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="float64")

    return scored(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, grammar: Grammar, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every document."""
    scored = id_and_text(docs, id_col, text_col).select("doc_id", score_column(F.col("text"), grammar).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_clean(docs: DataFrame, grammar: Grammar, text_col: str = "text") -> DataFrame:
    """The rows that are not toxic, with the columns they came with."""
    name = free_name(docs, "_toxicity")
    return docs.withColumn(name, score_column(F.col(text_col), grammar)).filter(F.col(name) < THRESHOLD).drop(name)

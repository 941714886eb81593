"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of order 0 to ``order`` counts which byte followed which
context in that language's words. A byte's code length is taken from the longest known context; where
the byte never followed it, an escape is paid (distinct followers against all occurrences and
followers) and the next shorter context is asked, down to a uniform code over 256 bytes.
The counts are frozen after training, so code lengths are exact and the same for every text. Words are
runs of letters in lower case, with a space before and behind; contexts do not reach beyond the
word, so that a word's code lengths can be kept for its next occurrence. The language with the
shortest code for the whole text wins; the score is its share when code lengths are turned back
into probabilities.

Training reads a bounded sample of the labelled rows: per language ``docs_per_language`` documents, those with
the smallest hash of their id, and of a text longer than ``longest`` characters so many from a place that the id's
hash picks. Of several texts with one id the last in order is learned from. Every document is scored, over its
whole text.

Defined cases: a null, empty or letterless text is ``und`` with score 0, and so is every text where
nothing was learned; equal code lengths go to the first language by name; null ids and repeated rows
are scored like others and null ids never learned from; an empty table gives no rows. Other columns
are not read.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text

ORDER = 4
DOCS_PER_LANGUAGE = 250
COUNTING_TASKS = 4  # for the bounded sample; each sends on its different grams once
LONGEST = 1 << 16  # characters of one text that are learned from
CACHED_WORDS = 300_000
CACHED_GRAMS = 500_000
LONGEST_WORD = 64
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def words(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _bytes(word: str) -> bytes:
    return b" " + word.encode("utf-8", "surrogatepass") + b" "


def sample(
    labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, longest: int = LONGEST
) -> DataFrame:
    """At most ``docs_per_language`` rows (lang, text) of each language. Different ids are ranked without their texts."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = usable.select("doc_id", "lang").distinct().withColumn("_rank", F.row_number().over(order))
    # The chosen ids are at most ``docs_per_language`` per language, which bounds the broadcast.
    chosen = F.broadcast(ranked.filter(F.col("_rank") <= docs_per_language).select("doc_id", "lang"))
    places = F.greatest(F.lit(1), F.length("text") - longest + 1)
    window = F.substring("text", (1 + F.pmod(F.xxhash64("doc_id"), places)).cast("int"), F.lit(longest))
    found = usable.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"]).withColumn("text", window)
    found = found.groupBy("doc_id", "lang").agg(F.max("text").alias("text"))
    return found.select("lang", "text").coalesce(COUNTING_TASKS)


def count_contexts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): a context and the byte behind it, and how often that was seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[lang].update(words(text))
        for lang, counts in seen.items():
            grams: Counter = Counter()
            for word, n in counts.items():
                data = _bytes(word)
                for at in range(1, len(data)):
                    for k in range(min(order, at) + 1):
                        grams[data[at - k : at + 1]] += n
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * len(grams),
                    "gram": pa.array(list(grams), pa.binary()),
                    "n": pa.array(list(grams.values()), pa.int64()),
                }
            )

    return rows.mapInArrow(run, "lang string, gram binary, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def code_lengths(counts: list[tuple[str, bytes, int]]) -> dict[str, tuple[dict[bytes, float], dict[bytes, float]]]:
    """Per language, in order of names: bits of a byte in its context, and bits of escaping a context."""
    total: dict[str, Counter] = defaultdict(Counter)
    followers: dict[str, Counter] = defaultdict(Counter)
    for lang, gram, n in counts:
        total[lang][gram[:-1]] += n
        followers[lang][gram[:-1]] += 1
    model: dict = {lang: ({}, {}) for lang in sorted(total)}
    for lang, gram, n in counts:
        context = gram[:-1]
        model[lang][0][gram] = math.log2((total[lang][context] + followers[lang][context]) / n)
    for lang, (_, escapes) in model.items():
        for context, n in total[lang].items():
            escapes[context] = math.log2((n + followers[lang][context]) / followers[lang][context])
    return model


def gram_bits(gram: bytes, grams: dict[bytes, float], escapes: dict[bytes, float]) -> float:
    """Code length of the last byte of ``gram`` behind the ones before it."""
    bits = 0.0
    for first in range(len(gram)):
        found = grams.get(gram[first:])
        if found is not None:
            return bits + found
        bits += escapes.get(gram[first:-1], 0.0)
    return bits + 8.0


def word_bits(word: str, grams: dict[bytes, float], escapes: dict[bytes, float], order: int = ORDER) -> float:
    data = _bytes(word)
    return sum(gram_bits(data[max(0, at - order) : at + 1], grams, escapes) for at in range(1, len(data)))


class Rows:
    """Vectors by key in one array of at most ``size`` rows, computed on a miss; when it is full it starts anew."""

    def __init__(self, size: int, width: int, compute):
        self.size, self.compute, self.rows = size, compute, {}
        self.values = np.zeros((1 << 12, width))

    def full(self) -> bool:
        return len(self.rows) >= self.size

    def row(self, key) -> int:
        row = self.rows.get(key)
        if row is None:
            value = self.compute(key)
            row = len(self.rows)
            if row == len(self.values):
                self.values = np.concatenate([self.values, np.zeros_like(self.values)])
            self.values[row] = value
            self.rows[key] = row
        return row


_SCORERS: dict = {}


class Scorer:
    """Scores texts with a model; keeps the code lengths of words, and of bytes in their contexts."""

    def __init__(self, model: dict, order: int):
        self.langs, self.order = list(model), order
        self.trees = list(model.values())
        self.grams = Rows(CACHED_GRAMS, len(self.langs), lambda gram: [gram_bits(gram, *tree) for tree in self.trees])
        self.words = Rows(CACHED_WORDS, len(self.langs), self._bits)

    def _bits(self, word: str) -> np.ndarray:
        data, order = _bytes(word), self.order
        if self.grams.full():
            self.grams.rows.clear()
        rows = [self.grams.row(data[max(0, at - order) : at + 1]) for at in range(1, len(data))]
        return self.grams.values[rows].sum(0)

    def score(self, text: str) -> tuple[str, float]:
        if not self.langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        total = np.zeros(len(self.langs))
        found = words(text)
        for first in range(0, len(found), CACHED_WORDS):
            part = found[first : first + CACHED_WORDS]
            if len(self.words.rows) + len(part) > 2 * CACHED_WORDS:
                self.words.rows.clear()
            rows = [self.words.row(word) for word in part if len(word) <= LONGEST_WORD]
            total += self.words.values[rows].sum(0)
            if len(rows) < len(part):
                total += sum(self._bits(word) for word in part if len(word) > LONGEST_WORD)
        best = int(total.argmin())
        return self.langs[best], float(1 / np.exp2(np.maximum(total[best] - total, -1000)).sum())


def train(labelled: DataFrame, order: int = ORDER, docs_per_language: int = DOCS_PER_LANGUAGE) -> dict:
    """The frozen model of rows (doc_id, lang, text); its size is bounded by that of the sample."""
    counts = count_contexts(sample(labelled, docs_per_language), order).collect()
    return code_lengths([(r["lang"], bytes(r["gram"]), r["n"]) for r in counts])


def predict(docs: DataFrame, model: dict, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, trees = shared.value
        if version not in _SCORERS:  # one scorer per worker process and model, so its words outlive a task
            _SCORERS.clear()
            _SCORERS[version] = Scorer(trees, order)
        scorer = _SCORERS[version]
        for batch in batches:
            scored = [scorer.score(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([lang for lang, _ in scored], pa.string()),
                    pa.array([score for _, score in scored], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, lang_pred string, score double")

"""Quality score from a sparse ensemble of rules over text statistics.

A random forest of shallow trees is grown on a bounded sample of labelled rows. Every path from a root
to a node is a rule, a conjunction of thresholds on statistics. A lasso logistic regression over the
rules keeps few of them, and those are compiled into one Spark column expression, which scores all
documents without Python.

Defined cases: a null text counts as empty and is scored by its statistics (zeros); with no labelled
row the score is 0.5, with one class of them only 0 or 1 accordingly; labels other than 0 and 1 and null
ids are not learned from; a label row that is repeated or whose document is repeated counts
as often as it occurs in their join; null ids and repeated rows are scored like others; an empty table
gives no rows. Other columns are neither read nor changed. Texts are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import free_name, id_and_text, labelled_sample, staged

SAMPLE_ROWS = 8000
TREES = 16
DEPTH = 3
LASSO = 0.002
SEED = 17
ITERATIONS = 100
TRAINING_TASKS = 4
THRESHOLD = 0.3


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1)).cast("double")


def _kept(text: Column, pattern: str) -> Column:
    """Number of characters outside of ``pattern``."""
    return F.length(F.regexp_replace(text, pattern, ""))


def statistics(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)
    again = F.zip_with(words, F.slice(words, 2, F.greatest(n_words, F.lit(1))), lambda a, b: a == b)
    ended = F.filter(lines, lambda x: F.substring(F.rtrim(x), -1, 1).isin(".", "!", "?"))
    return {
        "n_words": n_words.cast("double"),
        "word_length": _share(chars, n_words),
        "distinct_words": _share(F.size(F.array_distinct(words)), n_words),
        "repeated_words": _share(F.size(F.filter(again, lambda x: x)), n_words),
        "letters": _share(_kept(text, r"\P{L}+"), chars),
        "capitals": _share(_kept(text, r"\P{Lu}+"), chars),
        "digits": _share(_kept(text, r"\P{N}+"), chars),
        "marks": _share(_kept(text, r"[^\p{P}\p{S}]+"), chars),
        "distinct_lines": _share(F.size(F.array_distinct(lines)), n_lines),
        "ended_lines": _share(F.size(ended), n_lines),
        "line_length": _share(chars, n_lines),
    }


STATISTICS = (
    "n_words", "word_length", "distinct_words", "repeated_words", "letters", "capitals", "digits", "marks",
    "distinct_lines", "ended_lines", "line_length",
)


def with_statistics(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """``df`` with a struct of the statistics of ``text_col``, each computed once per row. It comes out
    of a generator because filters are not pushed below one; in a plain projection the optimizer
    would copy every statistic into each rule that a filter uses."""
    words, lines, text = free_name(df, "_words"), free_name(df, "_lines"), free_name(df, "_text")
    cut = df.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    cut = cut.withColumns({words: F.split(F.trim(F.col(text)), r"\s+"), lines: F.split(F.col(text), "\n")})
    values = statistics(F.col(text), F.col(words), F.col(lines))
    struct = F.struct(*(c.alias(n) for n, c in values.items()))
    return cut.withColumn(name, F.explode(F.array(struct))).drop(words, lines, text)


@dataclass(frozen=True)
class Rule:
    """Conditions (statistic, above, threshold) that all hold, and the rule's weight."""

    conditions: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self, stats: Column) -> Column:
        held = F.lit(True)
        for name, above, threshold in self.conditions:
            value = stats[name]
            held = held & ((value > threshold) if above else (value <= threshold))
        return held


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for rule in self.rules:
            total = total + F.when(rule.column(stats), rule.weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def _paths(node, names: tuple[str, ...], above: tuple = ()) -> set[tuple]:
    """Conditions on the way to each node below ``node``, which lives in the JVM."""
    found = {above} if above else set()
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        name, threshold = names[split.featureIndex()], float(split.threshold())
        found |= _paths(node.leftChild(), names, (*above, (name, False, threshold)))
        found |= _paths(node.rightChild(), names, (*above, (name, True, threshold)))
    return found


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> Ensemble:
    """The ensemble for rows (text, label); ``rows`` is expected to be a bounded sample."""
    stats = with_statistics(rows, "text", "_stats").select("label", "_stats")
    data = staged(stats.repartition(TRAINING_TASKS), "quality-sample")  # each of many short training jobs reads it
    seen = {r["label"]: r["n"] for r in data.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        return Ensemble((), 40.0 * (seen.get(1, 0) > 0) - 40.0 * (seen.get(0, 0) > 0))
    flat = data.select("label", "_stats.*")
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(flat)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="onethird"
    ).fit(vectors)
    paths: set[tuple] = set()
    for tree in forest.trees:
        paths |= _paths(tree._call_java("rootNode"), STATISTICS)
    rules = [Rule(path) for path in sorted(paths, key=lambda p: (len(p), p))]
    held = F.array(*(F.when(rule.column(F.col("_stats")), 1.0).otherwise(0.0) for rule in rules))
    model = LogisticRegression(
        labelCol="label", regParam=lasso, elasticNetParam=1.0, standardization=False, maxIter=ITERATIONS
    ).fit(data.select("label", array_to_vector(held).alias("features")))
    weights = model.coefficients.toArray()
    kept = tuple(Rule(r.conditions, float(w)) for r, w in zip(rules, weights) if w)
    return Ensemble(kept, float(model.intercept))


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> Ensemble:
    """Learn ``quality`` from at most ``sample_rows`` labelled documents whose crc32 modulo 5 is not 0."""
    return fit(labelled_sample(docs, labels, "quality", 5, 0, sample_rows, id_col, text_col))


def score(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score and predicted of every document."""
    scored = with_statistics(id_and_text(docs, id_col, text_col), "text", "_stats")
    scored = scored.select("doc_id", model.score(F.col("_stats")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Ensemble, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with the columns they came with."""
    name = free_name(docs, "_stats")
    scored = with_statistics(docs, text_col, name)
    return scored.filter(model.score(F.col(name)) >= THRESHOLD).drop(name)

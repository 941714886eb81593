"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import staged


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node, staged: over an aggregate on the join's key Spark cannot split the
    edges of a node that has many, over a stored table it can, or broadcasts it where it is small."""
    return staged(edges.groupBy("a").agg(F.min("b").alias("least")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both)
    linked = both.filter("b > a").join(least, "a")
    return linked.select(F.col("b").alias("a"), F.least("a", "least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    linked = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return linked.unionAll(least.select("a", F.col("least").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for edges (a, b) over any ordered type: root is the least node of the component. Nodes without
    an edge to another do not occur. Each round is written to the shared folder; the driver sees
    a count and a check sum of it."""

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    current = staged(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = state(current)
    while before[0]:
        current = staged(_small_star(_large_star(current)).distinct(), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)

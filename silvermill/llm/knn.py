"""Exact top-k search by integer inner product: a Voronoi join of queries and data.

Pivots are drawn from the vectors, one for a block's worth of rows within fixed bounds, and every vector belongs to
the cell of its nearest pivot. A small summary of each cell (rows, radius, the smallest distances to the pivot) bounds the scores
of a query q in it, for x = p + f gives q.x = q.p + q.f and |q.f| <= |q| |f|: the k-th best of the lower
bounds is a score the query surely reaches, and a cell whose upper bound lies below that cannot
hold a result. Queries are few against the rows they search, so it is they that are replicated, to the cells
that may hold results and to no others. Queries of neighbouring cells are grouped to parts of bounded size; a block
of a cell's rows is sent once to every part that has a query which needs the cell, and to no other. A block and a part are
solved locally, and the best of all blocks are merged.

Vectors that are equal share their scores, so a query vector is solved once, and of equal data vectors only
the k + 1 with the smallest ids can be in a result. This holds for any group of copies, however large.

Defined cases: vectors that are null or have null or non-finite components, and rows with a null id, take
no part; shorter vectors count as padded with zeros, an empty one as all zeros; a row with a query's
own id is not its candidate; a row that is repeated with the same id and vector counts once; equal scores
go to the smaller id; with fewer candidates than k all are returned; an empty table gives no rows. Other
columns are not read. Components times ``scale`` must stay below 2**31 in size, so that scores fit a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silvermill.llm.common import staged

PIVOTS, MOST_PIVOTS = 64, 4096
SCALE = 256
BLOCK_ROWS = 1 << 14
BLOCK_QUERIES = 1 << 13
_TILE = 256
_TILE_BOUNDS = 1 << 22  # lower bounds that are compared at a time


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, vec): floor(scale * x) of each component, of one length."""
    vector = F.col(vector_col)
    usable = F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False)
    )
    valid = rows.filter(vector.isNotNull() & F.col(id_col).isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vec"),
    )
    sizes = valid.agg(F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if sizes[0] == sizes[1] and sizes[0] != 0:
        return valid
    longest = max(1, sizes[1] or 1)
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(longest) - F.size("vec"))
    return valid.withColumn("vec", F.concat("vec", zeros))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Adds cell (the nearest pivot, the first among equals) and dist (to it)."""
    half = (pivots.astype("f8") ** 2).sum(1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1)).astype("f8")
            cell = (half - v @ pivots.T.astype("f8")).argmin(1)
            dist = np.sqrt(((v - pivots[cell]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype("i4")), pa.array(dist)], ["vec_id", "vec", "cell", "dist"]
            )

    return vectors.mapInArrow(run, "vec_id long, vec array<long>, cell int, dist double")


@dataclass(frozen=True)
class Cells:
    """Summary of the data: all arrays by cell; ``nearest`` has the smallest distances, infinite where
    the cell has fewer rows."""

    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    nearest: np.ndarray

    @property
    def blocks(self) -> np.ndarray:
        return -(-self.rows // BLOCK_ROWS)

    def needed(self, queries: np.ndarray, k: int) -> np.ndarray:
        """By query and cell, whether the cell may hold one of the query's k best."""
        q = queries.astype("f8")
        to_pivot = q @ self.pivots.T.astype("f8")
        size = np.sqrt((q**2).sum(1))[:, None]
        slack = 1e-9 * (1 + np.abs(to_pivot).max(1, keepdims=True) + size * self.radius.max())
        surely = (to_pivot[:, :, None] - size[:, :, None] * self.nearest[None]).reshape(len(q), -1)
        surely[np.isnan(surely)] = -np.inf
        place = surely.shape[1] - k
        reached = np.partition(surely, place, axis=1)[:, place, None] if place >= 0 else -np.inf
        return (to_pivot + size * self.radius + slack >= reached) & (self.rows > 0)


def _summarize(data: DataFrame, pivots: np.ndarray, k: int) -> Cells:
    """At most ``k`` rows and one per cell come to the driver."""
    cells = len(pivots)
    rows, radius, nearest = np.zeros(cells, "i8"), np.zeros(cells), np.full((cells, k), np.inf)
    for cell, n, r in data.groupBy("cell").agg(F.count("*"), F.max("dist")).collect():
        rows[cell], radius[cell] = n, r
    by_distance = Window.partitionBy("cell").orderBy("dist", "vec_id")
    close = data.select("cell", "dist", F.row_number().over(by_distance).alias("n")).filter(F.col("n") <= k)
    for cell, dist, n in close.collect():
        nearest[cell, n - 1] = dist
    return Cells(pivots, rows, radius, nearest)


def _near_order(pivots: np.ndarray) -> list[int]:
    """The pivots along a chain that goes on to the nearest one not yet visited."""
    left = np.ones(len(pivots), bool)
    order = [0]
    left[0] = False
    places = pivots.astype("f8")
    while len(order) < len(pivots):
        distance = ((places - places[order[-1]]) ** 2).sum(1)
        distance[~left] = np.inf
        order.append(int(distance.argmin()))
        left[order[-1]] = False
    return order


def query_parts(asked: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part and number of parts of the queries of each cell, given how many there are: cells that are
    neighbours share a part of at most BLOCK_QUERIES, a cell with more has parts of its own."""
    first, parts = np.zeros(len(asked), "i8"), np.ones(len(asked), "i8")
    part, held = 0, 0
    for cell in _near_order(pivots):
        if held and held + asked[cell] > BLOCK_QUERIES:
            part, held = part + 1, 0
        first[cell] = part
        parts[cell] = max(1, -(-asked[cell] // BLOCK_QUERIES))
        held += int(asked[cell])
        if parts[cell] > 1:
            part, held = part + int(parts[cell]), 0
    return first, parts


def _at(values: np.ndarray, place: Column) -> Column:
    """The entry of a bounded array at ``place``, from 0."""
    return F.element_at(F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast("array<int>"), place + 1)


def _needed(queries: DataFrame, cells: Cells, k: int) -> Callable[[bool], DataFrame]:
    """For every cell that a query needs (cell, query_part, query_key, vec), or only the pairs of a cell and a part."""

    def replicated(pairs: bool) -> DataFrame:
        tile = max(1, min(_TILE, _TILE_BOUNDS // (len(cells.pivots) * k)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for first in range(0, whole.num_rows, tile):
                    batch = whole.slice(first, tile)
                    query, cell = np.nonzero(cells.needed(_matrix(batch.column(2)), k))
                    if pairs:
                        parts = batch.column(0).to_numpy()[query]
                        both = np.unique(np.stack([cell, parts]), axis=1).astype("i4")
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["cell", "query_part"])
                    else:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell.astype("i4")), *batch.take(pa.array(query)).columns],
                            ["cell", "query_part", "query_key", "vec"],
                        )

        schema = "cell int, query_part int" + ("" if pairs else ", query_key long, vec array<long>")
        return queries.select("query_part", "query_key", "vec").mapInArrow(run, schema)

    return replicated


def _best(queries: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the queries, ids and scores of each query's k best rows; ``ids`` ascend."""
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(data).max(initial=0)) * data.shape[1]
    kind = "f8" if largest < 1 << 53 else "i8"  # exact in either, and the first is much faster
    columns = np.ascontiguousarray(data.T, kind)
    places, found, scores = [], [], []
    for first in range(0, len(queries), _TILE):
        tile = queries[first : first + _TILE].astype(kind) @ columns
        for place, row in enumerate(tile, first):
            if len(row) > k:
                near = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
            else:
                near = np.arange(len(row))
            near = near[np.argsort(-row[near], kind="stable")[:k]]
            places.append(np.full(len(near), place))
            found.append(ids[near])
            scores.append(row[near].astype("i8"))
    return np.concatenate(places), np.concatenate(found), np.concatenate(scores)


def top_k(
    rows: DataFrame,
    k: int = 5,
    every: int = 50,
    scale: int = SCALE,
    pivots: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for each row whose id ``every`` divides."""
    pivots = pivots or min(MOST_PIVOTS, max(PIVOTS, rows.count() // BLOCK_ROWS))
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    drawn = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("vec").collect()
    centres = np.array(sorted({tuple(r["vec"]) for r in drawn}) or [(0,)], "i8")
    placed = staged(_assign(vectors, centres), "knn-cells")

    kept = k + 1  # one of them may be the query itself
    copies = Window.partitionBy("vec").orderBy("vec_id")
    data = placed.withColumn("copy", F.dense_rank().over(copies)).filter(F.col("copy") <= kept)
    data = staged(data.dropDuplicates(["vec", "vec_id"]).select("vec_id", "vec", "cell", "dist"), "knn-data")
    cells = _summarize(data, centres, kept)

    asked = placed.filter(F.col("vec_id") % every == 0).select("vec_id", "vec", "cell").distinct()
    distinct = staged(asked.groupBy("vec", "cell").agg(F.min("vec_id").alias("query_key")), "knn-queries")
    by_cell = np.zeros(len(centres), "i8")
    for cell, n in distinct.groupBy("cell").agg(F.count("*")).collect():  # a row per cell
        by_cell[cell] = n
    first, parts = query_parts(by_cell, centres)
    part = _at(first, F.col("cell")) + F.pmod(F.xxhash64("query_key"), _at(parts, F.col("cell"))).cast("int")
    needed = _needed(distinct.withColumn("query_part", part), cells, kept)
    blocks = _at(cells.blocks, F.col("cell"))
    every_block = F.explode(F.sequence(F.lit(0), blocks - 1))
    sent = needed(False).withColumn("block", every_block)
    # A block has a bounded number of rows, so no key of this join is hot, whatever the cell.
    pairs = staged(needed(True).distinct().withColumn("block", every_block), "knn-pairs")
    held = data.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks).cast("int")).join(pairs, ["cell", "block"])

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_key": pa.array([], "i8"), "vec_id": pa.array([], "i8"), "score": pa.array([], "i8")})
        right = right.sort_by("vec_id")
        places, ids, scores = _best(_matrix(left["vec"]), _matrix(right["vec"]), right["vec_id"].to_numpy(), kept)
        return pa.table({"query_key": left["query_key"].to_numpy()[places], "vec_id": ids, "score": scores})

    key = ("cell", "block", "query_part")
    found = (
        sent.groupBy(*key)
        .cogroup(held.select(*key, "vec_id", "vec").groupBy(*key))
        .applyInArrow(solve, "query_key long, vec_id long, score long")
    )
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= kept).drop("n")

    # From distinct query vectors back to the queries, each without itself.
    keyed = asked.join(distinct.drop("cell"), "vec").select(F.col("vec_id").alias("query_id"), "query_key")
    results = keyed.join(staged(found, "knn-found"), "query_key").filter(F.col("vec_id") != F.col("query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return results.select("query_id", rank.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)

"""Exact top-k search against SQL and brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from silvermill.llm import bindings, knn
from silvermill.llm.knn import Cells, _best, top_k
from tests.llm.conftest import SF
from tests.oracle import compare, connect


def test_op4_query(spark):
    name = "op4_top_k"
    problem, _ = compare(spark, connect(SF), SF, name, bindings.QUERIES[name], bindings.ORACLES[name])
    assert not problem


def brute(rows, k, every):
    valid = sorted({
        (i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    })
    width = max((len(v) for _, v in valid), default=0)
    valid = [(i, v + (0,) * (width - len(v))) for i, v in valid]
    out = []
    for q, a in valid:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q)
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("seed", [0, 1])
def test_clusters_copies_and_ties(spark, monkeypatch, seed):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 8)
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, (5, 6))
    vectors = centres[rng.integers(5, size=300)] + rng.normal(0, 0.05, (300, 6))
    vectors[:100] = vectors[0]  # a third are copies
    vectors[100:130] = np.round(vectors[100:130])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    assert found(top_k(df, k=5, every=10, pivots=8)) == brute(rows, 5, 10)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (10, None), (20, [1.0, None]), (30, [nan, 0.0]), (40, [inf, 0.0]), (None, [1.0, 1.0]),
            (50, [0.5]), (60, []), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select("*", F.lit(1).alias("cell"), F.lit("v").alias("vec"), F.lit(2).alias("score"))
    assert found(top_k(df, k=5, every=10)) == brute(rows, 5, 10)
    assert top_k(df.limit(0)).count() == 0
    assert found(top_k(df.filter("vec_id = 60"))) == []  # nothing but the query itself


def test_bounds_leave_out_only_what_cannot_win():
    rng = np.random.default_rng(4)
    pivots = rng.integers(-200, 200, (12, 8))
    cell = rng.integers(12, size=400)
    data = pivots[cell] + rng.integers(-5, 6, (400, 8))
    dist = np.sqrt(((data - pivots[cell]) ** 2).sum(1))
    nearest = np.full((12, 6), np.inf)
    for c in range(12):
        own = np.sort(dist[cell == c])[:6]
        nearest[c, : len(own)] = own
    cells = Cells(pivots, np.bincount(cell, minlength=12), np.array([dist[cell == c].max() for c in range(12)]), nearest)
    queries = rng.integers(-200, 200, (30, 8))
    needed = cells.needed(queries, 6)
    best = np.argsort(-(queries @ data.T), axis=1)[:, :6]
    for q in range(30):
        assert needed[q, cell[best[q]]].all()
    assert needed.mean() < 0.5


def test_large_components_are_scored_exactly():
    big = (1 << 31) - 1
    queries, data = np.array([[big, big]]), np.array([[big, 1], [big, 2], [1, big]])
    places, ids, scores = _best(queries, data, np.array([5, 6, 7]), 2)
    assert ids.tolist() == [6, 5] and scores.tolist() == [big * big + 2 * big, big * big + big]


def test_parts_hold_queries_of_near_cells(monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 10)
    pivots = np.array([[0, 0], [100, 0], [1, 0], [101, 0], [2, 0], [300, 0]])
    first, parts = knn.query_parts(np.array([4, 3, 4, 4, 35, 0]), pivots)
    assert parts.tolist() == [1, 1, 1, 1, 4, 1]
    assert first[0] == first[2] != first[4] and first[1] == first[3] != first[0]
    ranges = {int(f): int(p) for f, p in zip(first, parts)}
    assert all(f + p <= g for (f, p), g in zip(sorted(ranges.items()), sorted(ranges)[1:]))


def test_rows_are_sent_to_the_parts_that_need_them(spark, monkeypatch):
    """Clusters far apart, a pivot in each: queries of a part need their own clusters, so a row goes to few parts."""
    monkeypatch.setattr(knn, "BLOCK_ROWS", 50)
    monkeypatch.setattr(knn, "BLOCK_QUERIES", 10)
    rng = np.random.default_rng(8)
    centres = np.eye(12) * 40
    vectors = centres[rng.integers(12, size=1200)] + rng.normal(0, 0.05, (1200, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    tables = {}
    keep = knn.staged
    monkeypatch.setattr(knn, "staged", lambda table, label: tables.setdefault(label, keep(table, label)))
    assert found(top_k(df, k=5, every=10, pivots=120)) == brute(rows, 5, 10)
    pairs = tables["knn-pairs"].select("cell", "query_part").distinct()
    parts = pairs.select("query_part").distinct().count()
    sent = pairs.join(tables["knn-data"], "cell").count()
    assert parts >= 10 and sent <= 2.5 * 1200 < parts * 1200


def test_pivots_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 2)
    drawn = []
    monkeypatch.setattr(knn, "_assign", lambda vectors, pivots, own=knn._assign: drawn.append(len(pivots)) or own(vectors, pivots))
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(0, 3, (400, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(df, k=3, every=20)) == brute(rows, 3, 20) and drawn == [200]
    monkeypatch.setattr(knn, "MOST_PIVOTS", 90)
    assert found(top_k(df, k=3, every=20)) == brute(rows, 3, 20) and drawn == [200, 90]

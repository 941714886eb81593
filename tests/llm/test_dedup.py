"""Exact deduplication, the n-gram join and components against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from silvermill.llm import bindings, ngram_join
from silvermill.llm.common import split_by_keys
from silvermill.llm.components import components
from silvermill.llm.exact import duplicates, keep_one, keep_state
from silvermill.llm.ngram_join import near_duplicates, runs_needed, shingles
from tests.llm.conftest import SF
from tests.oracle import compare, connect


def by_text(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    return sorted(
        (doc_id, max(group), len(group), hashlib.sha256(text.encode()).hexdigest())
        for text, group in groups.items()
        for doc_id in group
    )


def test_op2_query(spark):
    name = "op2_exact_dedup"
    problem, _ = compare(spark, connect(SF), SF, name, bindings.QUERIES[name], bindings.ORACLES[name])
    assert not problem


def weak(text):
    """A digest that clashes all the time."""
    return F.unhex(F.lpad(F.hex(F.pmod(F.length(text), F.lit(3))), 2, "0"))


@pytest.mark.parametrize("options", [{}, {"digest": weak}, {"batch_bytes": 1}])
def test_texts_are_compared_on_their_bytes(spark, folder, options):
    rng = random.Random(1)
    rows = [(i, rng.choice(["", "a", "bb", "ccc", "a ", "dddd", None, "e" * 50_000])) for i in range(300)]
    rows += [(1000 + i, f"alone {i}") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    df.write.parquet(folder + "/docs")
    got = duplicates(spark.read.parquet(folder + "/docs"), **options).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == by_text(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_state_goes_on_from_its_checkpoint(spark, folder):
    def record(*rows):
        df = spark.createDataFrame([(bytes([d]), i, "f", i) for d, i in rows], "digest binary, doc_id long, file string, row long")
        df.write.mode("append").parquet(folder + "/records")
        state = keep_state(spark, folder + "/records", folder + "/stream")
        return {r.digest[0]: (r.n, r.keeper.doc_id) for r in state.collect()}

    assert record((1, 5), (1, 7), (2, 1)) == {1: (2, 7), 2: (1, 1)}
    assert record((1, 6), (3, 9)) == {1: (3, 7), 2: (1, 1), 3: (1, 9)}


def test_exact_keeps_columns_and_one_of_repeated_rows(spark, odd, empty):
    kept = keep_one(odd)
    assert kept.dtypes == odd.dtypes
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 4), (False, 5), (False, 7), (False, 8), (False, 9), (False, 10), (True, 0)]
    assert keep_one(odd.filter("doc_id = 7")).count() == 1
    assert keep_one(empty).count() == 0 and duplicates(empty).count() == 0
    sizes = {r.doc_id: r.group_size for r in duplicates(odd).collect()}
    assert sizes[1] == 3 and sizes[2] == sizes[3] == sizes[10] == 3 and sizes[None] == 1


def test_callers_settings_stay(spark, odd):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    duplicates(odd).count()
    assert spark.conf.get(key, None) == before


def test_split_by_keys(spark):
    rows = spark.range(3000).withColumn("x", F.col("id") % 7)
    sure, doubtful = split_by_keys(rows, spark.range(0, 3000, 3).select("id"), "id")
    ids = {r.id for r in doubtful.collect()}
    assert ids >= set(range(0, 3000, 3)) and len(ids) < 1100
    assert ids.isdisjoint(r.id for r in sure.collect()) and sure.count() + doubtful.count() == 3000
    assert sure.columns == rows.columns


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len(want) and {r.node: r.root for r in got} == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows, threshold=0.8):
    """Class and links of every row, all pairs compared."""
    sets = [set(shingles(t or "").tolist()) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return sorted((str(d), str(min(ids[find(i)], default=None)), links[i]) for i, (d, _) in enumerate(rows))


def found(df):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in df.collect())


def test_op1_query(spark, documents):
    assert found(bindings.QUERIES["op1_ngram_join"](spark, SF)) == brute(documents)


def edited(rng, words, share):
    return " ".join(w if rng.random() > share else f"w{rng.randrange(10**6)}" for w in words)


def corpus(seed=3, near=350, others=150):
    """A group of near copies larger than a leaf, copies, a passage that all share, and other texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=150)
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows = [edited(rng, base, rng.choice([0.0, 0.005, 0.01, 0.02])) for _ in range(near)]
    rows += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(5, 200))) for _ in range(others)]
    rows += ["", None, "one", "one two three", "one two three", "a b c d e", "A, b. c d e!"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_large_groups_and_a_shared_passage(spark, monkeypatch):
    rows = corpus()
    # Small blocks and leaves, so that sampled members, deeper paths and pairs of blocks are all used.
    monkeypatch.setattr(ngram_join, "LEAF", 32)
    monkeypatch.setattr(ngram_join, "TILE", 48)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 64)
    got = found(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute(rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert got == want


def test_recall_of_pairs_at_the_threshold(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(300):
        words = [f"w{rng.randrange(10**6)}" for _ in range(104)]
        other = [*words]
        for at in (20, 60):  # two words apart: 10 of 100 shingles differ, similarity 0.82
            other[at] = "x" + other[at]
        rows += [" ".join(words), " ".join(other)]
    got = near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    linked = got.filter("n_links = 1").count() / 600
    assert linked >= 0.97
    assert runs_needed(0.8, 0.99) == 4


def test_pairs_at_the_threshold_below_a_passage_of_all(spark, monkeypatch):
    # Buckets of the passage's tokens are large down to the last depth; a pair has 80 of 100 shingles in common.
    monkeypatch.setattr(ngram_join, "LEAF", 32)
    rng = random.Random(12)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = []
    for _ in range(1500):
        words = [f"w{rng.randrange(10**9)}" for _ in range(64)]
        other = [*words]
        for at in (20, 45):
            other[at] = "x" + other[at]
        rows += [f"{passage} {' '.join(words)}", f"{passage} {' '.join(other)}"]
    assert len(set(shingles(rows[0]).tolist()) & set(shingles(rows[1]).tolist())) == 80
    got = near_duplicates(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    assert got.filter("n_links = 0").count() <= 2


def test_near_join_of_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(near_duplicates(odd)) == brute(rows)
    assert near_duplicates(empty).count() == 0
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    # 1, 7, 7 are one class; texts without words stay.
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 1), (False, 2), (False, 3), (False, 4), (False, 5), (False, 8), (False, 9), (False, 10), (True, 0)]
    assert ngram_join.keep_one(empty).count() == 0


def test_shingles():
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a b")) == 1 and len(shingles(" .,")) == 0
    assert shingles("A b, c D e").tolist() == shingles("a B c. d e").tolist()
    assert not np.array_equal(shingles("a b c d e"), shingles("b a c d e"))
    assert shingles("a b").tolist() != shingles("a b b").tolist()

"""Buckets that split: directories, bounded rewriting, partitions with buckets, tables of earlier versions."""

import json
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from silvermill.operators.keyfilter import may_match
from silvermill.sinks.buckets import Directory, bits_to_split, key_hash, low_bits_of
from silvermill.sinks.upsert import BUCKETS, CROWD, SilverTable, _near, _touched, merge, read_table, upsert, write_draft
from silvermill.storage import size

ROW = "k1 string, k2 int, v string, part string"
TARGET = 24_000


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def grown(path, spark):
    """The table's folders, their codes and bytes."""
    state = SilverTable(spark, path).state()
    return {f: (code, size(spark, f"{path}/{f}")) for f, code in zip(state["folders"], state["codes"])}


def test_directories_cover_all_hashes():
    rng = random.Random(1)
    for _ in range(200):
        directory = Directory.of_depth(rng.randint(0, 3))
        for _ in range(rng.randint(0, 5)):
            directory = directory.split(rng.choice(directory.codes), rng.randint(1, 2))
        places = directory.places()
        assert set(places) == set(directory.codes) and len(places) == 1 << directory.depth
        for place, code in enumerate(places):
            n = code.bit_length() - 1
            assert code == (1 << n | place & (1 << n) - 1)
        some = rng.sample(range(len(places)), rng.randint(0, min(5, len(places))))
        assert directory.holding(some, directory.depth) == {places[s] for s in some}


def test_split_by_size():
    assert [bits_to_split(n, 100, 1) for n in (0, 100, 101, 200, 201, 900)] == [0, 0, 1, 1, 2, 4]
    assert bits_to_split(10**9, 100, 1 << 19) == 1  # no deeper than a directory goes


def test_codes_are_those_of_the_places(spark):
    directory = Directory.of_depth(1).split(2, 2).split(3, 1)
    hashed = spark.range(-50, 50).select(F.xxhash64("id").alias("h"))
    places = directory.places()
    for row in hashed.select("h", directory.code(F.col("h")).alias("code")).collect():
        assert row.code == places[row.h % len(places)]
    assert set(low_bits_of(hashed, F.col("h"), 12)) == {r.h % 4096 for r in hashed.collect()}
    assert low_bits_of(hashed, F.col("h"), 0) == [0] and low_bits_of(hashed.limit(0), F.col("h"), 3) == []


@pytest.mark.parametrize("n, passed", [(1, 10), (3_000, 1_000)])
def test_key_filter_keeps_all_matches(spark, n, passed):
    keys = spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("l"))
    rows = spark.range(50_000).select(F.col("id").alias("k"), F.lit("x").alias("l"), F.col("id").alias("a.b"))
    left = may_match(rows, keys, ["k", "l"], n)
    assert left.columns == rows.columns
    assert left.join(keys, ["k", "l"]).count() == n and left.count() <= n + 50_000 // 16 + passed
    assert may_match(rows, keys, ["k"], 10**9) is rows


def batch(spark, lo, hi, mark, parts=None):
    part = F.lit("p") if parts is None else F.concat(F.lit("p"), F.col("id") % parts)
    return spark.range(lo, hi).select(
        F.lit("a").alias("k1"), F.col("id").cast("int").alias("k2"),
        F.concat(F.lit(f"{mark}-"), F.sha2(F.col("id").cast("string"), 512)).alias("v"), part.alias("part"),
    )


def test_what_a_small_batch_rewrites_does_not_grow(spark, folder):
    path = folder + "/t"
    written = []
    for lo, hi in ((0, 2400), (2400, 24_000)):
        upsert(batch(spark, lo, hi, "x"), path, ["k1", "k2"], bucket_bytes=TARGET)
        before = grown(path, spark)
        assert all(n <= 1.5 * TARGET for _, n in before.values())
        upsert(batch(spark, 7, 17, "y"), path, ["k1", "k2"], bucket_bytes=TARGET)
        after = grown(path, spark)
        new = {f: n for f, (_, n) in after.items() if f not in before}
        assert len(before.keys() - after.keys()) <= 10
        written.append(sum(new.values()))
    assert len(before) > 60 and max(code.bit_length() for code, _ in after.values()) > 6
    assert written[1] <= 1.5 * written[0]
    assert read_table(spark, path).count() == 24_000 and read_table(spark, path).filter("v like 'y%'").count() == 10


def test_a_batch_lists_only_its_buckets_of_each_partition(spark, folder):
    path = folder + "/t"
    upsert(batch(spark, 0, 3000, "x", parts=3), path, ["k1", "k2"], ["part"], bucket_bytes=TARGET // 3)
    folders = SilverTable(spark, path).state()["folders"]
    assert len(folders) > 20 and {f.rsplit("=", 1)[1] for f in folders} == {"p0", "p1", "p2"}
    draft = write_draft(spark, batch(spark, 7, 8, "y", parts=2), path, ["k1", "k2"], bucket_bytes=TARGET // 3)
    keys = draft.rows.select("k1", "k2")
    near = _near(draft, keys, ["k1", "k2"])
    assert {f.rsplit("=", 1)[1] for f in near} == {"p0", "p1", "p2"} and len(near) <= len(folders) / 6
    scan = draft.read(near).select("k1", "k2")
    assert {f.split("/t/")[1].rsplit("/", 1)[0] for f in scan.inputFiles()} == set(near)
    plan = may_match(scan, keys, ["k1", "k2"], 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert len(_touched(draft, keys, ["k1", "k2"])) == 1
    merge(draft, ["k1", "k2"])
    assert read_table(spark, path).count() == 3000
    assert [r.part for r in read_table(spark, path).filter("v like 'y%'").collect()] == ["p1"]


def test_many_folders_of_a_bucket_become_one(spark, folder):
    path = folder + "/t"
    for i in range(CROWD + 3):
        upsert(batch(spark, i, i + 1, "x"), path, ["k1", "k2"], ["part"])
        assert len(SilverTable(spark, path).state()["folders"]) <= CROWD
    assert read_table(spark, path).count() == CROWD + 3


@pytest.mark.parametrize("partitioned", [False, True])
@pytest.mark.parametrize("newer_by", [None, "at"])
def test_model_with_small_buckets(spark, folder, partitioned, newer_by):
    rng = random.Random(partitioned + 2 * bool(newer_by))
    schema = "k int, at int, part string, text string"
    path, model, loose = folder + "/t", {}, []
    for step in range(6):
        keys = rng.sample(range(150), rng.choice([0, 1, 10, 120]))
        rows = [(k, rng.randint(0, 5), rng.choice(["p", "q/1", "", None]), os.urandom(60).hex()) for k in keys]
        # An empty partition value is read back as null.
        rows = [(k, at, part or None, text) if partitioned else (k, at, part, text) for k, at, part, text in rows]
        nulls = [(None, step, "p", str(i)) for i in range(rng.choice([0, 30]))]
        gone = rng.sample(range(150), 5) if step else []
        retract = spark.createDataFrame([(k,) for k in gone], "k int") if step % 2 else None
        upsert(
            spark.createDataFrame(rows + nulls, schema), path, ["k"], ["part"] if partitioned else [], newer_by,
            bucket_bytes=2500, retract=retract,
        )
        for k in gone if retract is not None else []:
            model.pop(k, None)
        for row in rows:
            if not newer_by or row[0] not in model or row[1] >= model[row[0]][1]:
                model[row[0]] = row
        loose += nulls
        assert content(read_table(spark, path)) == sorted([*model.values(), *loose], key=str), step
    places = SilverTable(spark, path).state()["buckets"]
    assert max(len(codes) for codes in places.values()) > (4 if partitioned else 16)


@pytest.fixture
def folders_written(monkeypatch):
    plans, write = [], SilverTable.write_folder

    def seen(self, rows, partition_by):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, partition_by)

    monkeypatch.setattr(SilverTable, "write_folder", seen)
    return plans


@pytest.mark.parametrize("partition_by, buckets", [(["part"], 8), (["part"], 32), ([], 32)])
def test_a_first_load_of_known_size_is_written_once(spark, folder, folders_written, partition_by, buckets):
    path, rows = folder + "/t", batch(spark, 0, 3000, "x")
    known = buckets * TARGET - 1
    draft = write_draft(
        spark, rows, path, ["k1", "k2"], partition_by, rebalance=False, buckets=1, bucket_bytes=TARGET * 32 // buckets,
        partition_bytes=known * 32 // buckets,
    )
    merge(draft, ["k1", "k2"], unique=True)
    assert len(folders_written) == 1 and ("Exchange" in folders_written[0]) == (buckets > BUCKETS)
    assert len({code for code, _ in grown(path, spark).values()}) == buckets
    assert content(read_table(spark, path)) == content(rows)


def test_a_partition_of_an_earlier_table_keeps_its_one_bucket(spark, folder):
    path = folder + "/t"
    write_old(spark, path, batch(spark, 0, 600, "old"), 16, ["part"])
    new = batch(spark, 590, 700, "new")
    draft = write_draft(spark, new, path, ["k1", "k2"], bucket_bytes=1 << 30, partition_bytes=1 << 33)
    merge(draft, ["k1", "k2"])
    assert {code for code, _ in grown(path, spark).values()} == {1}
    assert content(read_table(spark, path)) == content(batch(spark, 0, 590, "old").unionByName(new))


def test_a_first_load_of_unknown_size_is_split_without_a_join(spark, folder, folders_written):
    path, rows = folder + "/t", batch(spark, 0, 3000, "x")
    upsert(rows, path, ["k1", "k2"], ["part"], bucket_bytes=TARGET)
    assert len(folders_written) == 2 and "LeftAnti" not in folders_written[1]
    assert content(read_table(spark, path)) == content(rows)


def test_a_job_gives_a_new_date_the_buckets_it_needs(spark, monkeypatch, folders_written):
    from bindings import publishing

    monkeypatch.setattr(publishing, "LINE_TABLE", replace(publishing.LINE_TABLE, bucket_bytes=TARGET))
    row = publishing.run_audit_counts(spark, "/root/testdata/sf0.001").first()
    assert row.status == "SUCCESS" and row.rows_written > 0 and len(folders_written) == 1


def write_old(spark, path, rows, buckets, partition_by):
    """A table as earlier versions wrote it: fixed buckets, or partitions without buckets."""
    if not partition_by:
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("k1", "k2"), F.lit(buckets)).cast("int"))
    columns = partition_by or ["_bucket"]
    rows.write.partitionBy(*columns).parquet(f"{path}/_v=7")
    folders = [f"_v=7/{d}" for d in os.listdir(f"{path}/_v=7") if "=" in d]
    schema = rows.drop("_bucket").schema
    state = {
        "version": 3, "schema": json.loads(schema.json()), "partition_by": partition_by,
        "bucket_by": [] if partition_by else ["k1", "k2"], "buckets": buckets, "folders": folders, "retired": [],
    }
    os.makedirs(f"{path}/_state")
    with open(f"{path}/_state/00000003.json", "w") as out:
        json.dump(state, out)


@pytest.mark.parametrize("buckets, partition_by", [(16, []), (12, []), (16, ["part"])])
def test_earlier_tables_go_on(spark, folder, buckets, partition_by):
    path = folder + "/t"
    write_old(spark, path, batch(spark, 0, 600, "old", parts=2), buckets, partition_by)
    assert read_table(spark, path).count() == 600
    before = set(SilverTable(spark, path).state()["folders"])
    # Moves key 3 from p1 to p0.
    upsert(batch(spark, 3, 4, "one", parts=1), path, ["k1", "k2"])
    left = before & set(SilverTable(spark, path).state()["folders"])
    assert len(left) == {(16, True): 15, (12, True): 0, (16, False): 1}[buckets, not partition_by]
    upsert(batch(spark, 590, 1200, "new", parts=2), path, ["k1", "k2"], bucket_bytes=TARGET)
    got = {r.k2: r.v.split("-")[0] for r in read_table(spark, path).collect()}
    assert got == {i: "one" if i == 3 else "old" if i < 590 else "new" for i in range(1200)}
    assert read_table(spark, path).count() == 1200


def test_rows_without_a_key_are_spread(spark, folder):
    path = folder + "/t"
    rows = spark.range(2000).select(F.lit(None).cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    upsert(rows, path, ["k"], bucket_bytes=TARGET)
    sizes = [n for _, n in grown(path, spark).values()]
    assert len(sizes) == 16 and max(sizes) <= 2 * min(sizes)
    assert rows.select(key_hash(rows, ["k"]).alias("h")).distinct().count() == 2000


def test_marks_stay_in_the_state(spark, folder):
    path = folder + "/t"
    upsert(batch(spark, 0, 3, "x"), path, ["k1", "k2"], marks={"a": 1})
    upsert(batch(spark, 0, 0, "x"), path, ["k1", "k2"], marks={"b": [2, "c"]})
    assert SilverTable(spark, path).state()["marks"] == {"a": 1, "b": [2, "c"]}
    assert read_table(spark, path).count() == 3


def test_rows_of_one_date_are_written_without_a_shuffle(spark, folder, monkeypatch):
    path, plans = folder + "/t", []
    write = SilverTable.write_folder

    def seen(self, rows, partition_by):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, partition_by)

    monkeypatch.setattr(SilverTable, "write_folder", seen)
    for lo in (0, 5):
        draft = write_draft(spark, batch(spark, lo, lo + 5, "x"), path, ["k1", "k2"], ["part"], rebalance=False)
        assert "Exchange" not in plans[-1]
        merge(draft, ["k1", "k2"])
    write_draft(spark, batch(spark, 0, 5, "x"), path, ["k1", "k2"], ["part"]).discard()
    assert "Exchange" in plans[-1] and read_table(spark, path).count() == 10

"""Current versions beside a history: any order of runs, reruns, scoped runs and removals; switches of dates that are cut off."""

import json
import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from silvermill.operators.latest import latest_lookup
from silvermill.plans import current, forge, jobs
from silvermill.plans.current import Follower, current_path, read_current
from silvermill.plans.specs import Store
from silvermill.session import Scratch
from silvermill.sinks import replace
from silvermill.sinks.replace import Dates, read_dates, replace_where
from silvermill.sinks.upsert import read_table

SCHEMA = "repo_id long, repo_full_name string, bronze_ingested_at timestamp, snapshot_date date"
DAYS = [date(2026, 4, 6) + timedelta(days=7 * i) for i in range(3)]
VERSION = ("snapshot_date", "bronze_ingested_at", "repo_id")


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


class History:
    """Replaces dates as the snapshot job does, and compares the current versions with the whole history."""

    def __init__(self, spark, folder):
        self.spark, self.store, self.n = spark, Store(folder + "/bronze", folder + "/silver"), 0
        self.path = self.store.table(forge.REPOS.name)

    def rows(self, day, names):
        self.n += 1
        stamp = f"{day} 02:00:{self.n % 60:02d}"
        rows = [(100 * self.n + i, name, stamp, day) for i, name in enumerate(names)]
        text = SCHEMA.replace("timestamp", "string")
        return self.spark.createDataFrame(rows, text).withColumn("bronze_ingested_at", F.to_timestamp("bronze_ingested_at"))

    def publish(self, day, names, entity=None):
        rows = self.rows(day, names)
        scope = None if entity is None else F.col("repo_full_name") == F.lit(entity)
        with Follower(self.spark, self.store, forge.REPOS) as follower:
            replace_where(rows, self.path, day, scope)
            follower.follow(rows, day, scope)

    def check(self):
        history = read_dates(self.spark, self.path)
        expected = latest_lookup(history, ["repo_full_name"], ["repo_id"], VERSION).filter("repo_full_name is not null")
        with Scratch(self.spark) as scratch:
            got = jobs.newest(self.spark, self.store, forge.REPO_IDS, scratch)
            assert content(got) == content(expected)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_runs(spark, folder, seed):
    rng, history = random.Random(seed), History(spark, folder)
    for _ in range(7):
        day = rng.choice(DAYS)
        if rng.random() < 0.4 and os.path.exists(history.path):
            name = rng.choice("abcde")
            history.publish(day, [name] * rng.randint(1, 2), name)
        else:
            names = rng.sample("abcde", rng.randint(1, 4))
            history.publish(day, [*names, *rng.choices([names[0], None], k=2)])
        assert read_current(spark, history.store, "repo_metadata") is not None
        history.check()


def test_removed_keys_fall_back_or_go(spark, folder):
    history = History(spark, folder)
    history.publish(DAYS[0], ["x", "y"])
    history.publish(DAYS[1], ["x", "y", "z"])
    history.publish(DAYS[1], ["x"])  # y goes back to its older version, z has none
    ids = {r.repo_full_name: r.repo_id for r in read_current(spark, history.store, "repo_metadata").collect()}
    assert ids == {"x": 300, "y": 101}
    history.check()


def test_a_history_without_current_versions_is_read_whole_once(spark, folder):
    history = History(spark, folder)
    replace_where(history.rows(DAYS[0], ["x", "y"]), history.path, DAYS[0])
    history.check()  # no table yet: the history itself
    history.publish(DAYS[1], ["x"], "x")
    history.check()
    assert read_current(spark, history.store, "repo_metadata").count() == 2


def test_a_run_that_dies_between_history_and_current_versions(spark, folder, monkeypatch):
    history = History(spark, folder)
    history.publish(DAYS[0], ["x", "y"])
    monkeypatch.setattr(current, "upsert", lambda *a, **b: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        history.publish(DAYS[1], ["x"])
    assert read_current(spark, history.store, "repo_metadata") is None
    history.check()  # from the history
    monkeypatch.undo()
    history.publish(DAYS[0], ["y"])
    assert read_current(spark, history.store, "repo_metadata") is not None
    assert not os.listdir(current_path(history.store, "repo_metadata") + "/_behind")
    history.check()


SNAP = "name string, n int, snapshot_date date"


def snap(spark, *rows):
    return spark.createDataFrame(rows, SNAP)


@pytest.mark.parametrize("step", ["create_text", "rename_old", "rename_new", "delete"])
def test_a_switch_that_is_cut_off(spark, folder, step, monkeypatch):
    path, day = folder + "/t", DAYS[0]
    replace_where(snap(spark, ("a", 1, day), ("b", 1, day)), path, day)
    replace_where(snap(spark, ("a", 1, DAYS[1])), path, DAYS[1])
    calls = []

    def dying(name, real, at):
        def call(*args):
            calls.append(name)
            if calls.count(name) == at:
                raise KeyboardInterrupt
            return real(*args)

        return call

    name, at = {"rename_old": ("rename", 1), "rename_new": ("rename", 2)}.get(step, (step, 1))
    monkeypatch.setattr(replace, name, dying(name, getattr(replace, name), at))
    with pytest.raises(KeyboardInterrupt):
        replace_where(snap(spark, ("a", 2, day)), path, day)
    monkeypatch.undo()
    old, new = [("a", 1, day), ("b", 1, day)], [("a", 2, day)]
    expected = (old if step == "create_text" else new) + [("a", 1, DAYS[1])]
    assert content(read_table(spark, path).select("name", "n", "snapshot_date")) == sorted(expected, key=str)
    if step in ("create_text", "rename_old"):  # plain readers see the old date until it is moved
        assert content(spark.read.schema(SNAP).parquet(path)) == sorted(old + [("a", 1, DAYS[1])], key=str)
    replace_where(snap(spark, ("c", 3, DAYS[1])), path, DAYS[1])  # the next writer finishes it
    expected[-1:] = [("c", 3, DAYS[1])]
    assert content(spark.read.schema(SNAP).parquet(path)) == sorted(expected, key=str)
    assert not Dates(spark, path).under_way()


@pytest.mark.parametrize("step", ["create_text", "rename", "delete_file", "delete"])
def test_a_scoped_switch_that_is_cut_off(spark, folder, step, monkeypatch):
    path, day = folder + "/t", DAYS[0]
    rows = spark.range(40).select(F.concat(F.lit("n"), F.col("id") % 8).alias("name"), F.lit(1).alias("n"), F.lit(day).alias("snapshot_date"))
    replace_where(rows.repartition(4, "name"), path, day)
    files = set(os.listdir(f"{path}/snapshot_date={day}"))
    calls, real = [], {name: getattr(replace, name) for name in ("create_text", "rename", "delete")}

    end = {"create_text": ("create_text", 1), "rename": ("rename", 1), "delete_file": ("delete", 1), "delete": ("delete", 2)}[step]

    def dying(name):
        def call(*args):
            calls.append(name)
            if (name, calls.count(name)) == end:
                raise KeyboardInterrupt
            return real[name](*args)

        return call

    for name in real:
        monkeypatch.setattr(replace, name, dying(name))
    with pytest.raises(KeyboardInterrupt):
        replace_where(snap(spark, ("n3", 9, day)), path, day, F.col("name") == "n3")
    monkeypatch.undo()
    old = content(rows)
    new = sorted([r for r in old if r[0] != "n3"] + [("n3", 9, day)], key=str)
    assert content(read_table(spark, path).select("name", "n", "snapshot_date")) == (old if step == "create_text" else new)
    replace_where(snap(spark, ("n3", 9, day)), path, day, F.col("name") == "n3")
    assert content(spark.read.schema(SNAP).parquet(path)) == new and not Dates(spark, path).under_way()
    left = {f for f in files if f.endswith(".parquet")} & set(os.listdir(f"{path}/snapshot_date={day}"))
    assert len(left) == len([f for f in files if f.endswith(".parquet") and not f.startswith(".")]) - 1  # one file held the entity


def test_the_second_of_two_writers_of_a_date_fails(spark, folder, monkeypatch):
    path, day = folder + "/t", DAYS[0]
    replace_where(snap(spark, ("a", 1, day)), path, day)
    real = Dates.switch

    def late(self, name, new, seen):
        monkeypatch.undo()
        replace_where(snap(spark, ("b", 2, day)), path, day)  # another writer comes first
        real(self, name, new, seen)

    monkeypatch.setattr(Dates, "switch", late)
    with pytest.raises(FileExistsError):
        replace_where(snap(spark, ("a", 3, day)), path, day, F.col("name") == "a")
    assert content(spark.read.schema(SNAP).parquet(path)) == [("b", 2, day)]
    assert [json.loads(open(f"{path}/_switch/snapshot_date={day}/{f}").read())["had"] for f in os.listdir(f"{path}/_switch/snapshot_date={day}") if f.endswith("json") and not f.startswith(".")] == [True]

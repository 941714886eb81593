"""Streams over several landed dates, batches that are given again, damaged values, and gates without another read."""

import json
import os

import pytest
from pyspark.sql import functions as F

from silvermill.operators.quality import Observed, QualityError, evaluate, rules_for
from silvermill.plans import forge, jobs
from silvermill.plans.audit import Run, read_runs
from silvermill.plans.specs import Store
from silvermill.sinks.upsert import SilverTable, read_table
from silvermill.sources.damage import count_misfits, misfit_counts
from silvermill.sources.envelopes import Scope
from tests.test_jobs import RUN, commit, fill, issue, make_world, repo


@pytest.fixture
def world(folder):
    return make_world(folder, "keyed")


def content(df):
    return sorted(df.collect(), key=str)


LATER = {"batch": "2026-04-13T02:00:00+00:00", "fetched": "2026-04-13T02:00:01+00:00"}


def fill_later(bronze):
    bronze.put("issues", "o", "r", [issue(1, state="again"), issue(8), issue(4, pull_request={}, state="closed")], **LATER)
    bronze.put("commits", "o", "r", [commit("a", "again"), commit("z")], **LATER)


def test_a_stream_over_two_dates_equals_two_runs(spark, world):
    bronze, store, layout = world
    fill(bronze)
    fill_later(bronze)
    other = Store(store.bronze, store.silver + "-other")
    for each in (store, other):
        forge.repos_job(spark, each, Scope("2026-04-06"), RUN, layout)
    checkpoints = os.path.dirname(store.silver)
    assert forge.stream_issues(spark, store, checkpoints + "/i", layout, run_ts=RUN) == 1
    assert forge.stream_commits(spark, store, checkpoints + "/c", layout, run_ts=RUN) == 1
    for day in ("2026-04-06", "2026-04-13"):
        forge.issues_job(spark, other, Scope(day), RUN, layout)
        forge.commits_job(spark, other, Scope(day), RUN, layout)
    for name in ("issues", "pulls", "commits"):
        streamed, expected = read_table(spark, store.table(name)), read_table(spark, other.table(name))
        assert streamed.schema == expected.schema and content(streamed) == content(expected), name
    runs = read_runs(spark, store.table("_runs")).filter("stream is not null").collect()
    assert [(r.job, r.batch, r.rows_written) for r in sorted(runs, key=lambda r: r.job)] == [
        ("commits", 0, {"commits": 5}), ("issues", 0, {"issues": 4, "pulls": 3})]


@pytest.mark.parametrize("where", ["first publish", "second date", "audit row written"])
def test_a_batch_given_again_is_applied_once(spark, world, monkeypatch, where):
    bronze, store, layout = world
    fill(bronze)
    fill_later(bronze)
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    checkpoint = os.path.dirname(store.silver) + "/i"
    merge, leave, calls = jobs.merge, Run.__exit__, []

    def failing_merge(draft, *args, **kwargs):
        calls.append(draft.table.path.rsplit("/", 1)[1])
        if where == "second date" and len(calls) == 3:
            raise OSError("gone")
        merge(draft, *args, **kwargs)
        if where == "first publish" and len(calls) == 1:
            raise OSError("gone")

    def failing_exit(self, kind, error, trace):
        leave(self, kind, error, trace)
        if where == "audit row written" and self.stream:
            raise OSError("gone")

    monkeypatch.setattr(jobs, "merge", failing_merge)
    monkeypatch.setattr(Run, "__exit__", failing_exit)
    with pytest.raises(Exception, match="gone"):
        forge.stream_issues(spark, store, checkpoint, layout, run_ts=RUN)
    before = list(calls)
    monkeypatch.undo()
    again = []
    monkeypatch.setattr(jobs, "merge", lambda draft, *a, **k: (again.append(draft.table.path.rsplit("/", 1)[1]), merge(draft, *a, **k)))
    assert forge.stream_issues(spark, store, checkpoint, layout, run_ts=RUN) == 1
    monkeypatch.undo()
    done = before if where != "second date" else before[:-1]
    assert len(done) + len(again) == 4  # two tables, two dates, each once
    runs = read_runs(spark, store.table("_runs")).filter("stream is not null and status = 'SUCCESS'").collect()
    assert [(r.batch, r.rows_written) for r in runs] == [(0, {"issues": 4, "pulls": 3})]
    assert {r.issue_id: r.issue_state for r in read_table(spark, store.table("issues")).collect()} == {1: "again", 3: "open", 8: "open"}
    assert {r.pull_id: r.pull_state for r in read_table(spark, store.table("pulls")).collect()} == {2: "open", 4: "closed"}
    marks = SilverTable(spark, store.table("issues")).state()["marks"]
    assert list(marks.values()) == [{"batch": 0, "days": {"2026-04-06": 2, "2026-04-13": 2}}]


def test_error_bodies_and_values_that_do_not_fit_fail_the_job(spark, world):
    bronze, store, layout = world
    fill(bronze)
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    body = json.dumps({"owner": "o", "repo": "r", "endpoint": "commits", "count": "many", "data": {"message": "no"}})
    bronze.put("commits", "o", "r", None, text=body)
    with pytest.raises(QualityError, match="corrupt_pages=1; miscounted_pages=0"):
        forge.commits_job(spark, store, Scope("2026-04-06"), RUN, layout)
    bronze.put("issues", "o", "r", [issue(30, user={"login": "u", "id": "nine"}), issue(31, comments=[1])])
    with pytest.raises(QualityError, match=r"misfit_pages=1; data\[\].comments=1, data\[\].user.id=1"):
        forge.issues_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert not os.path.exists(store.table("commits")) and not os.path.exists(store.table("issues"))
    runs = {r.job: r for r in read_runs(spark, store.table("_runs")).filter("status = 'FAILED'").collect()}
    assert (runs["commits"].corrupt_pages, runs["commits"].misfits) == (1, {"count": 1, "data": 1})
    assert (runs["issues"].misfit_pages, runs["issues"].misfits) == (1, {"data[].comments": 1, "data[].user.id": 1})
    kept = spark.read.schema("endpoint string, text string, misfits map<string,bigint>").json(store.table("_quarantine")).collect()
    assert {(r.endpoint, *sorted(r.misfits)) for r in kept} == {("commits", "count", "data"), ("issues", "data[].comments", "data[].user.id")}


def test_misfits_by_field(spark):
    schema = "a bigint, s string, d double, b boolean, m map<string,string>, l array<string>, r array<struct<x bigint, y array<int>>>, `o.d` int"
    lines = [
        {"a": 1, "s": {"any": 1}, "d": 2, "b": True, "m": {"k": 1}, "l": ["a"], "r": [{"x": 1, "y": [1]}], "o.d": 1},
        {"a": None, "s": None, "d": None, "b": None, "m": None, "l": None, "r": None, "o.d": None}, {},
        {"a": "1", "d": "x", "b": 0, "m": [1], "l": "a", "r": {"x": 1}, "o.d": "z"},
        {"a": 1.5, "r": [{"x": "t", "y": [1, "u", 2, []]}, 7, None, {"y": {"z": 1}}]},
    ]
    df = spark.createDataFrame([(i, json.dumps(line)) for i, line in enumerate(lines)] + [(9, "{cut"), (10, None)], "i int, text string")
    found = df.select("i", misfit_counts("text", schema).alias("misfits"))
    got = {r.i: r.misfits for r in found.collect()}
    assert got[3] == {"a": 1, "d": 1, "b": 1, "m": 1, "l": 1, "r": 1, "o.d": 1}
    assert got[4]["r[].x"] == 1 and got[4]["r[].y[]"] == 2 and got[4]["r[].y"] == 1 and got[4]["r[]"] == 1
    assert not any(got[i] for i in (0, 1, 2, 9, 10))
    assert count_misfits(found)["a"] == got[4].get("a", 0) + 1


def test_the_gate_reads_no_draft_of_one_date(spark, world, monkeypatch):
    bronze, store, layout = world
    fill(bronze)
    seen = []
    monkeypatch.setattr("silvermill.operators.quality.duplicate_groups", lambda *a: seen.append(a))
    monkeypatch.setattr(jobs, "evaluate", lambda *a: seen.append(a))
    forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout)
    assert not seen and read_table(spark, store.table("issues")).count() == 2


def test_observed_rules_equal_the_report(spark, folder):
    rows = [("a", 1, -1, "x"), ("a", 1, None, ""), ("b", None, 3, None), (None, 2, 0, " ")]
    df = spark.createDataFrame(rows, "k string, id int, n int, name string")
    rules = rules_for(["k", "id"], ["name"], ["n"], ["k", "id"], ["name"])
    for proven, frame in (((), df), (("k", "id", "n"), df), (("k", "id", "n"), df.filter("n is null")), (("k", "id"), df.filter("id = 2")), ((), df.limit(0))):
        observed = Observed(rules, proven)
        path = f"{folder}/{len(proven)}{frame.count()}{len(proven)}"
        frame.observe(observed.observation, *observed.metrics).write.mode("overwrite").parquet(path)
        lines = observed.lines(spark.read.schema(df.schema).parquet(path))
        expected = evaluate(frame, rules).collect()
        assert sorted((x.rule, x.columns, x.severity, x.value, x.passed) for x in lines) == sorted(map(tuple, expected))
        assert observed.rows == frame.count()


def test_a_repository_with_an_odd_value_is_kept(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", size="large"))
    run = forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert (run.status, run.misfit_pages, run.misfits) == ("SUCCESS", 1, {"data.size": 1})
    assert read_table(spark, store.table("repo_metadata")).filter(F.col("size_kb").isNull()).count() == 1

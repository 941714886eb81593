"""Columns, latest rows, lookups, quality rules, incremental selection."""

import time
from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silvermill.functions.columns import (
    entity_name,
    iso_text,
    json_map,
    parse_ts,
    run_stamp,
    snapshot_date,
    time_parts,
    url_param,
)
from silvermill.operators.enrich import enrich_left
from silvermill.operators.incremental import after_marks, in_states, in_window, marks_of
from silvermill.operators.latest import latest_by, latest_lookup
from silvermill.operators.quality import QualityError, enforce, evaluate, rules_for

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def as_utc(spark, column):
    return one(spark, iso_text(column))


def test_timestamps(spark):
    assert as_utc(spark, parse_ts(F.lit("2026-04-06T02:00:00Z"))) == "2026-04-06T02:00:00.000000Z"
    assert as_utc(spark, parse_ts(F.lit("2026-04-06T02:00:00.123456+00:00"))) == "2026-04-06T02:00:00.123456Z"
    late = parse_ts(F.lit("2026-04-06T23:30:00-02:00"))
    assert one(spark, snapshot_date(late)) == date(2026, 4, 7)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, parse_ts(F.lit("nope")))
    assert one(spark, parse_ts(F.lit("nope"), strict=False)) is None
    parts = time_parts(parse_ts(F.lit("2026-04-06T02:00:00Z")))
    assert [one(spark, c) for c in parts.values()] == ["2026", "04", "06", "02"]
    assert as_utc(spark, run_stamp(datetime(2026, 4, 6, 2, tzinfo=timezone.utc))) == "2026-04-06T02:00:00.000000Z"


def test_literals_ignore_the_zone_of_the_driver(spark, monkeypatch):
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        at = datetime(2026, 4, 6, 2, 0, 0, 500)
        df = spark.createDataFrame([("2026-04-06 02:00:00.0005",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
        assert in_window(df, "ts", since=at).count() == 1 and in_window(df, "ts", until=at).count() == 0
        assert as_utc(spark, run_stamp(at)) == "2026-04-06T02:00:00.000500Z"
        assert as_utc(spark, run_stamp(at.replace(tzinfo=timezone.utc))) == "2026-04-06T02:00:00.000500Z"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_names_and_urls(spark):
    null = F.lit(None).cast("string")
    assert one(spark, entity_name(F.lit("o"), F.lit("r"))) == "o/r"
    assert one(spark, entity_name(F.lit("o"), null)) == "o"
    assert one(spark, entity_name(null, null)) == ""
    url = F.lit("https://x.org/a?per_page=100&page=7#page=9")
    assert one(spark, url_param(url, "page", "1")) == "7"
    assert one(spark, url_param(F.lit("https://x.org/a?page="), "page", "1")) == "1"
    assert one(spark, url_param(F.lit("https://x.org/a?per_page=5"), "page", "1")) == "1"
    assert one(spark, url_param(null, "page")) is None
    assert one(spark, json_map(F.lit('{"a": 1, "b": "x"}'))) == {"a": "1", "b": "x"}


ROWS = st.lists(st.tuples(st.integers(0, 3) | st.none(), st.integers(0, 5) | st.none(), st.integers(0, 3)), max_size=12)


@few
@given(rows=ROWS)
def test_latest_is_the_highest_and_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, at int, v int")
    once = latest_by(df, ["k"], ["at"])
    got = {r.k: (r.at, r.v) for r in once.collect()}
    assert set(got) == {k for k, _, _ in rows}
    for k, (at, v) in got.items():
        best = max((-1 if a is None else a) for kk, a, _ in rows if kk == k)
        assert (-1 if at is None else at) == best and (k, at, v) in rows
    assert sorted(map(str, latest_by(once, ["k"], ["at"]).collect())) == sorted(map(str, once.collect()))
    # Ties are decided by content, whatever the order the rows come in.
    other = latest_by(df.repartition(5).orderBy(F.rand(3)), ["k"], ["at"])
    assert sorted(map(str, other.collect())) == sorted(map(str, once.collect()))


def test_tie_breaker(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "c"), (1, 5, "b")], "k int, at int, v string")
    assert latest_by(df, ["k"], ["at"], ["v"]).first().v == "c"


def test_ties_of_rows_with_maps(spark):
    df = spark.sql("select 1 k, 1 at, map('a', id) m, parse_json('{\"x\": 1}') v from range(5)")
    first = latest_by(df, ["k"], ["at"]).first().m
    assert all(latest_by(df.repartition(n), ["k"], ["at"]).first().m == first for n in (2, 3))


def test_enrich(spark):
    table = spark.createDataFrame(
        [("a/x", 1, "2026-01-01"), ("a/x", 2, "2026-02-01"), ("B/y", 3, "2026-01-01")],
        "repo_full_name string, repo_id int, snapshot_date string",
    )
    newest = latest_lookup(table, ["repo_full_name"], ["repo_id"], ["snapshot_date"])
    df = spark.createDataFrame([("a/x", 1), ("a/x", 2), ("b/y", 3), (None, 4)], "repo_full_name string, n int")
    joined = enrich_left(df, newest, ["repo_full_name"], ["repo_id"])
    assert joined.columns == ["repo_full_name", "n", "repo_id"]
    assert sorted((r.n, r.repo_id) for r in joined.collect()) == [(1, 2), (2, 2), (3, None), (4, None)]
    folded = enrich_left(df, newest, ["repo_full_name"], ["repo_id"], normalize=F.lower)
    assert {r.n: r.repo_id for r in folded.collect()}[3] == 3


def test_gate(spark):
    df = spark.createDataFrame(
        [(1, "a", -1, None, 5), (1, "a", None, -2, None), (2, " ", 3, 4, 6), (None, "b", 0, 0, None)],
        "id int, name string, m int, n int, ref int",
    )
    report = evaluate(df, rules_for(["id", "name"], ["name"], ["m", "n"], ["id"], ["ref"]))
    got = {(r.rule, r["columns"]): (r.value, r.passed) for r in report.collect()}
    assert got == {
        ("not_empty", ""): (4, True),
        ("not_null", "id"): (1, False),
        ("not_null", "name"): (0, True),
        ("not_blank", "name"): (1, False),
        ("not_negative", "m,n"): (2, False),
        ("unique", "id"): (1, False),
        ("known", "ref"): (2, False),
    }
    with pytest.raises(QualityError) as failure:
        enforce(report, "t")
    for part in ("not_null(id)=1", "not_blank(name)=1", "not_negative(m,n)=2", "unique(id)=1"):
        assert part in str(failure.value)
    assert "known" not in str(failure.value)


def test_gate_on_empty_frame(spark):
    empty = spark.createDataFrame([], "id int, m int")
    with pytest.raises(QualityError, match="not_empty"):
        enforce(evaluate(empty, rules_for(["id"], not_negative=["m"])))
    assert enforce(evaluate(empty, rules_for(["id"], not_negative=["m"], unique=["id"], empty="warn"))) == 0


def test_incremental(spark):
    at = datetime
    df = spark.createDataFrame([("a", at(2026, 1, d)) for d in (1, 2, 3)] + [("b", at(2026, 1, 1))], "e string, ts timestamp_ntz")
    assert in_window(df, "ts", at(2026, 1, 1), at(2026, 1, 3)).count() == 3
    parts = [in_window(df, "ts", until=at(2026, 1, 2)), in_window(df, "ts", since=at(2026, 1, 2))]
    assert sum(p.count() for p in parts) == 4
    marks = marks_of(df.filter("e = 'a' and ts < timestamp_ntz '2026-01-03'"), ["e"], "ts")
    assert sorted((r.e, r.ts.day) for r in after_marks(df, marks, ["e"], "ts").collect()) == [("a", 3), ("b", 1)]
    assert after_marks(df, marks, ["e"], "ts", inclusive=True).count() == 3
    assert in_states(df, "e").count() == 4 and in_states(df, "e", ["b"]).count() == 1

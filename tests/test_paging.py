"""Page numbering, page plans and the paged remote source."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silvermill.operators.paging import count_pages, paginate, plan_pages
from silvermill.plans.landing import land_records, land_remote, land_remote_snapshots, read_marks
from silvermill.plans.specs import Store
from silvermill.session import Scratch
from silvermill.sinks import landing
from silvermill.sources.envelopes import Scope, scan_envelopes
from silvermill.sources.paged import Response, page_count, request_params
from silvermill.storage import glob
from tests.replay import ReplayTransport

RUN = datetime(2026, 4, 6, 2, tzinfo=timezone.utc)
few = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@few
@given(sizes=st.lists(st.integers(1, 40), min_size=1, max_size=4), parts=st.integers(1, 6), page_size=st.integers(1, 9))
def test_pages_are_full_and_complete(spark, sizes, parts, page_size):
    rows = [(f"e{e}" if e else None, e * 1000 + i, "copy") for e, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "entity string, id int, text string").repartition(parts)
    pages = paginate(df, ["entity"], Scratch(spark), page_size, block=2).collect()
    assert sorted(r.id for p in pages for r in p.data) == sorted(i for _, i, _ in rows)
    for e, n in enumerate(sizes):
        mine = sorted((p.page, p["count"], len(p.data)) for p in pages if p.entity == (f"e{e}" if e else None))
        full, rest = divmod(n, page_size)
        sizes_wanted = [page_size] * full + [rest] * (rest > 0)
        assert mine == [(i + 1, s, s) for i, s in enumerate(sizes_wanted)]


def test_copies_of_one_row_are_all_paged(spark):
    df = spark.range(5000).select(F.lit("hot").alias("entity"), F.lit(1).alias("id"))
    pages = paginate(df, ["entity"], Scratch(spark), 100, block=5)
    assert pages.count() == 50 and pages.agg(F.sum("count")).first()[0] == 5000


def test_plan(spark):
    totals = spark.createDataFrame([("a", 0), ("b", 1), ("c", 7), ("d", None)], "e string, pages long")
    got = sorted((r.e, r.page) for r in plan_pages(totals, ["e"], block=3).collect())
    assert got == [("b", 1)] + [("c", i) for i in range(1, 8)]
    items = spark.createDataFrame([("a",)] * 100 + [("b",)] * 101, "e string")
    assert {r.e: r.pages for r in count_pages(items, ["e"]).collect()} == {"a": 1, "b": 2}


def test_a_large_plan_is_spread(spark):
    totals = spark.createDataFrame([("hot", 1_000_000)], "e string, pages long")
    plan = plan_pages(totals, ["e"], block=1000, tasks=8)
    per_task = [r["count"] for r in plan.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1_000_000 and len(per_task) == 8 and max(per_task) < 300_000


def test_page_count_from_links(spark):
    last = "https://x.org/r/commits?per_page=100&page=12"
    rows = [(0, last, "n", 1), (1, None, "n", 1), (2, None, None, 1), (3, None, None, 0), (4, "https://x.org/r", None, 0)]
    df = spark.createDataFrame(rows, "id int, last_url string, next_url string, items int")
    got = df.select("id", page_count("last_url", "next_url", "items").alias("pages")).collect()
    assert {r.id: r.pages for r in got} == {0: 12, 1: None, 2: 1, 3: 0, 4: 1}


def test_request_params():
    assert request_params("commits", "s", "u") == {"per_page": 100, "since": "s", "until": "u"}
    assert request_params("issues") == {"per_page": 100, "state": "all"}
    assert request_params("issues", given={"state": "open", "per_page": 5}) == {"per_page": 5, "state": "open"}


def record(spark, folder, with_last=True):
    """a/x: 12 pages, b/y: 1 page, c/z: nothing recorded."""
    rows = []
    for owner, repo, pages in (("a", "x", 12), ("b", "y", 1)):
        for p in range(1, pages + 1):
            link = f"https://x.org/{owner}/{repo}?page="
            rows.append((owner, repo, p, link + str(p), json.dumps([{"id": p * 10, "more": {"+1": p}}, {"id": p * 10 + 1}]),
                         link + str(p + 1) if p < pages else None, link + str(pages) if with_last and p < pages else None))
    schema = "owner string, repo string, page long, url string, body string, next_url string, last_url string"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    df.write.partitionBy("owner", "repo").parquet(folder + "/recorded/things")
    return ReplayTransport(folder + "/recorded", block=5)


@pytest.mark.parametrize("with_last", [True, False])
def test_fetch_and_land(spark, folder, with_last):
    transport = record(spark, folder, with_last)
    entities = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("a", "x")], "owner string, repo string")
    store = Store(folder + "/bronze", folder + "/silver")
    land_remote(spark, store, "things", entities, transport, RUN, given={"per_page": 2}, mark=True)
    schema = """owner string, repo string, url string, count bigint, batch_timestamp string,
    params struct<per_page bigint, page bigint, since string>, data array<struct<id bigint, more struct<`+1` int>>>"""
    pages = scan_envelopes(spark, store.landed("things"), schema, Scope("2026-04-06")).collect()
    assert sorted((p.owner, p.params.page, p["count"]) for p in pages) == [("a", i, 2) for i in range(1, 13)] + [("b", 1, 2)]
    assert {r.id for p in pages for r in p.data} == {p * 10 + i for p in range(1, 13) for i in (0, 1)}
    assert {r.id: r.more["+1"] for p in pages for r in p.data if p.owner == "a" and r.more}[70] == 7
    assert all(p.params.per_page == 2 and p.url.endswith(f"page={p.params.page}") for p in pages)
    marks = read_marks(spark, store.table("_marks"), "things")
    assert {(r.owner, r.repo) for r in marks.collect()} == {("a", "x"), ("b", "y"), ("c", "z")}


def test_landing_windows_touch(spark, folder):
    store = Store(folder + "/bronze", folder + "/silver")
    at = [RUN - timedelta(hours=1), RUN, RUN + timedelta(hours=1), RUN + timedelta(hours=2)]
    rows = spark.createDataFrame([("a", "x", i, t) for i, t in enumerate(at)], "owner string, repo string, id int, at timestamp")
    entities = rows.select("owner", "repo")
    for run in (RUN, RUN + timedelta(hours=2), RUN + timedelta(hours=3)):
        land_records(spark, store, "things", rows, entities, run, "at", until=run, mark=True)
    df = scan_envelopes(spark, store.landed("things"), "owner string, params struct<page bigint>, data array<struct<id int>>")
    assert sorted(tuple(r.id for r in row.data) for row in df.collect()) == [(0,), (1, 2), (3,)]
    land_records(spark, store, "things", rows.filter("id < 0"), entities, RUN + timedelta(days=1), "at", mark=True)
    assert not glob(spark, store.landed("things") + "/yyyy=2026/mm=04/dd=07")  # nothing to land, nothing landed


@pytest.mark.parametrize("layout", ["keyed", "bare"])
def test_landed_files_are_compressed_and_bounded(spark, folder, monkeypatch, layout):
    monkeypatch.setattr(landing, "PAGE_LINES", 3)
    monkeypatch.setattr(landing, "SNAPSHOT_LINES", 4)
    entity = {"owner": F.lit("o"), "repo": F.lit("r"), "batch_timestamp": F.lit("2026-04-06T02:00:00Z")}
    rows = spark.range(10).withColumns(entity).coalesce(1)
    schema = "owner string, repo string, data array<bigint>, id bigint"
    for name, by_entity, files in (("pages", True, 4), ("snapshots", False, 3 if layout == "keyed" else 4)):
        root = f"{folder}/{name}"
        pages = rows.withColumn("data", F.array("id"))
        landing.land(pages, root, by_entity=by_entity and layout == "keyed" or layout == "bare", layout=layout)
        landed = scan_envelopes(spark, root, schema, Scope("2026-04-06"), layout)
        assert len(landed.inputFiles()) == files and all(f.endswith(".json.gz") for f in landed.inputFiles())
        assert sorted(r.data[0] for r in landed.collect()) == list(range(10))


class Bounded:
    """Answers with the bounds it was asked for."""

    def get(self, owner, repo, endpoint, params, page=None, url=None):
        if page is None and url is None:
            return Response(f"u/{owner}", json.dumps({"id": 5, "full_name": f"{owner}/{repo}"}))
        return Response("u", json.dumps([{"since": params.get("since"), "until": params.get("until")}]))


def test_marks_bound_the_next_run(spark, folder):
    store = Store(folder + "/bronze", folder + "/silver")
    one = spark.createDataFrame([("a", "x")], "owner string, repo string")
    two = spark.createDataFrame([("a", "x"), ("b", "y")], "owner string, repo string")
    later = RUN + timedelta(days=7)
    land_remote(spark, store, "commits", one, Bounded(), RUN, mark=True)
    land_remote(spark, store, "commits", two, Bounded(), later, until=later)
    schema = "owner string, params struct<since string, until string>, data array<struct<since string, until string>>"

    def asked(day):
        rows = scan_envelopes(spark, store.landed("commits"), schema, Scope(day)).collect()
        assert all(tuple(r.params) == tuple(r.data[0]) for r in rows)
        return {r.owner: tuple(r.params) for r in rows}

    assert asked("2026-04-06") == {"a": (None, None)}
    until = "2026-04-13T02:00:00+00:00"
    assert asked("2026-04-13") == {"a": ("2026-04-06T02:00:00.000000Z", until), "b": (None, until)}


def test_remote_snapshots(spark, folder):
    store = Store(folder + "/bronze", folder + "/silver")
    two = spark.createDataFrame([("a", "x"), ("b", "y")], "owner string, repo string")
    land_remote_snapshots(store, "repo_metadata", two, Bounded(), RUN)
    df = scan_envelopes(spark, store.landed("repo_metadata"), "owner string, data struct<id bigint, full_name string>")
    assert sorted((r.owner, r.data.id, r.data.full_name) for r in df.collect()) == [("a", 5, "a/x"), ("b", 5, "b/y")]


class Failing:
    def get(self, owner, repo, endpoint, params, page=None, url=None):
        if page == 3:
            raise OSError("page 3 is gone")
        return Response("u", "[1]", "n", "https://x.org/?page=4")


def test_a_failed_page_fails_the_run_and_sets_no_mark(spark, folder):
    store = Store(folder + "/bronze", folder + "/silver")
    entities = spark.createDataFrame([("a", "x")], "owner string, repo string")
    with pytest.raises(Exception, match="page 3 is gone"):
        land_remote(spark, store, "commits", entities, Failing(), RUN, mark=True)
    assert read_marks(spark, store.table("_marks"), "commits") is None

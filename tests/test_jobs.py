"""The three jobs on hand-made envelopes of every edge case."""

import json
import os
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from silvermill.operators.quality import QualityError
from silvermill.plans import cli, forge, jobs
from silvermill.plans.audit import Run, read_runs
from silvermill.plans.jobs import backfill
from silvermill.plans.specs import Store
from silvermill.session import Scratch
from silvermill.sinks.upsert import read_table
from silvermill.sources.envelopes import Scope
from silvermill.sources.paged import Response

RUN = datetime(2026, 4, 6, 3, tzinfo=timezone.utc)


class Bronze:
    """Writes envelopes, one file each, in either layout."""

    def __init__(self, root, layout):
        self.root, self.layout, self.n = root, layout, 0

    def put(self, endpoint, owner, repo, data, batch="2026-04-06T02:00:00+00:00", fetched="2026-04-06T02:00:01.5+00:00",
            text=None, count=None):
        day = batch[:10].split("-")
        time = f"yyyy={day[0]}/mm={day[1]}/dd={day[2]}/hh={batch[11:13]}"
        entity = f"{owner}/{repo}" if self.layout == "bare" else f"owner={owner}/repo={repo}"
        if self.layout == "bare":
            path = f"{self.root}/{endpoint}/{entity}/{time}"
        else:
            path = f"{self.root}/{endpoint}/{time}" + (f"/{entity}" if endpoint != "repo_metadata" else "")
        os.makedirs(path, exist_ok=True)
        self.n += 1
        envelope = {"owner": owner, "repo": repo, "fetched_at": fetched, "batch_timestamp": batch, "endpoint": endpoint, "data": data}
        if isinstance(data, list):
            envelope["count"] = len(data) if count is None else count
        with open(f"{path}/{endpoint}_{self.n}.json", "w") as out:
            out.write(text or json.dumps(envelope))


def repo(id, name, **more):
    return {"id": id, "full_name": name, "html_url": f"https://x.org/{name}", "owner": {"id": 1, "login": "o"},
            "created_at": "2020-01-01T00:00:00Z", "size": 3, "stargazers_count": 5, "topics": ["a"], **more}


def commit(sha, message="m", **more):
    return {"sha": sha, "html_url": f"https://x.org/{sha}", "author": {"id": 4, "login": "dev"},
            "commit": {"author": {"name": "Dev", "email": "d@x.org", "date": "2026-04-01T10:00:00Z"}, "message": message}, **more}


def issue(id, **more):
    return {"id": id, "number": id, "title": f"t{id}", "html_url": f"https://x.org/{id}", "state": "open", "comments": 0,
            "user": {"login": "u", "id": 9, "type": "User"}, "created_at": "2026-04-01T00:00:00Z",
            "updated_at": "2026-04-02T00:00:00Z", "reactions": {"total_count": 1, "+1": 1}, **more}


def make_world(folder, layout):
    return Bronze(folder + "/bronze", layout), Store(folder + "/bronze", folder + "/silver"), layout


@pytest.fixture(params=["keyed", "bare"])
def any_world(request, folder):
    return make_world(folder, request.param)


@pytest.fixture
def world(folder):
    return make_world(folder, "keyed")


def fill(bronze):
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r"))
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", description="later"), fetched="2026-04-06T05:00:00Z")
    bronze.put("repo_metadata", "o", "s", repo(2, "o/s", organization={"id": 77}))
    bronze.put("commits", "o", "r", [commit("a"), commit("b")])
    bronze.put("commits", "o", "r", [commit("b", "later", author=None)], fetched="2026-04-06T05:00:00Z")
    bronze.put("commits", "o", "q", [commit("a")])
    bronze.put("commits", "o", "s", [])
    bronze.put("issues", "o", "r", [
        issue(1), issue(2, pull_request={"url": "u", "merged_at": "2026-04-03T00:00:00Z"}),
        issue(3, user=None, pull_request=None), issue(4, pull_request={}, user={"login": "x[bot]", "id": 5, "type": "Bot"}),
    ])
    bronze.put("issues", "o", "r", [issue(1, state="closed", closed_by={"login": "c", "id": 3})], fetched="2026-04-06T05:00:00Z")


REPO_COLUMNS = """repo_id repo_full_name repo_url description owner_id owner_login created_at updated_at pushed_at
homepage_url size_kb main_language org_id network_count open_issues_count stargazers_count subscribers_count
bronze_ingested_at bronze_batch_timestamp silver_ingested_at snapshot_date""".split()
COMMIT_COLUMNS = """commit_id message url user_id bronze_ingested_at bronze_batch_timestamp committed_at repo_full_name
git_author_name git_author_email author_login silver_ingested_at snapshot_date repo_id""".split()


def test_all_jobs(spark, any_world):
    bronze, store, layout = any_world
    fill(bronze)
    for _ in range(2):  # a rerun gives the same tables
        repos, commits, issues = forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout)
        table = read_table(spark, store.table("repo_metadata"))
        assert table.columns == REPO_COLUMNS
        assert {r.repo_id: (r.description, r.org_id) for r in table.collect()} == {1: ("later", None), 2: (None, 77)}

        table = read_table(spark, store.table("commits"))
        assert table.columns == COMMIT_COLUMNS
        got = {(r.repo_full_name, r.commit_id): (r.message, r.user_id, r.repo_id) for r in table.collect()}
        assert got == {("o/r", "a"): ("m", 4, 1), ("o/r", "b"): ("later", None, 1), ("o/q", "a"): ("m", 4, None)}
        row = table.withColumn("at", F.date_format("bronze_ingested_at", "HH:mm:ss.SSSSSS")).filter("commit_id = 'a'").first()
        assert row.at == "02:00:01.500000" and str(row.snapshot_date) == "2026-04-06"

        table = read_table(spark, store.table("issues"))
        assert len(table.columns) == 31 and table.columns[-1] == "repo_id"
        assert {r.issue_id: (r.issue_state, r.is_bot, r.closed_by_login) for r in table.collect()} == {
            1: ("closed", False, "c"), 3: ("open", None, None)}
        table = read_table(spark, store.table("pulls"))
        assert {"pull_id", "pull_number", "pull_title", "pull_state"} < set(table.columns) and len(table.columns) == 31
        assert {r.pull_id: (r.is_bot, r.pull_request_merged_at is None) for r in table.collect()} == {2: (False, False), 4: (True, True)}
        assert (repos.pages, repos.records, commits.pages, commits.records) == (3, 3, 4, 4)
        assert issues.rows_written == {"issues": 2, "pulls": 2}
    runs = read_runs(spark, store.table("_runs"))
    assert runs.groupBy("job", "status").count().count() == 3 and runs.count() == 6


def test_scoped_rerun_touches_one_entity(spark, any_world):
    bronze, store, layout = any_world
    fill(bronze)
    forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout)
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", description="newest"), fetched="2026-04-06T09:00:00Z")
    bronze.put("repo_metadata", "o", "s", repo(2, "o/s", description="newest"), fetched="2026-04-06T09:00:00Z")
    forge.repos_job(spark, store, Scope("2026-04-06", "o", "r"), RUN, layout)
    got = {r.repo_id: r.description for r in read_table(spark, store.table("repo_metadata")).collect()}
    assert got == {1: "newest", 2: None}
    forge.commits_job(spark, store, Scope("2026-04-06", "o", "r"), RUN, layout)
    assert read_table(spark, store.table("commits")).count() == 3


def test_failed_gate_publishes_nothing_and_is_recorded(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", size=-1, network_count=None))
    bronze.put("repo_metadata", "o", "s", repo(None, "o/s"))
    with pytest.raises(QualityError, match=r"not_null\(repo_id\)=1; not_negative.*=1"):
        forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert not os.path.exists(store.table("repo_metadata"))
    run = read_runs(spark, store.table("_runs")).first()
    assert run.status == "FAILED" and "not_null(repo_id)" in run.error


def test_one_bad_part_of_a_split_keeps_both_tables_back(spark, world):
    bronze, store, layout = world
    fill(bronze)
    forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout)
    before = read_table(spark, store.table("issues")).collect()
    bronze.put("issues", "o", "r", [issue(50), issue(None, pull_request={})], batch="2026-04-13T02:00:00Z")
    with pytest.raises(QualityError, match="pulls"):
        forge.issues_job(spark, store, Scope("2026-04-13"), RUN, layout)
    assert sorted(read_table(spark, store.table("issues")).collect()) == sorted(before)


def test_a_late_failure_keeps_what_is_published(spark, world, monkeypatch):
    bronze, store, layout = world
    fill(bronze)
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    merge = jobs.merge

    def failing(draft, *args, **kwargs):
        if draft.table.path.endswith("pulls"):
            raise OSError("storage went away")
        merge(draft, *args, **kwargs)

    monkeypatch.setattr(jobs, "merge", failing)
    with pytest.raises(OSError):
        forge.issues_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert read_table(spark, store.table("issues")).count() == 2
    assert not os.path.exists(store.table("pulls") + "/_state") and not [
        f for f in os.listdir(store.table("pulls")) if f.startswith("_v=")]
    monkeypatch.undo()
    forge.issues_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert read_table(spark, store.table("issues")).count() == read_table(spark, store.table("pulls")).count() == 2


def test_corrupt_file_and_wrong_count(spark, world):
    bronze, store, layout = world
    fill(bronze)
    cut = json.dumps({"owner": "o", "repo": "r", "data": [commit("d"), commit("e")]})[:-40]
    bronze.put("commits", "o", "r", None, text=cut)
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    with pytest.raises(QualityError, match="corrupt_pages=1; miscounted_pages=0"):
        forge.commits_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert not os.path.exists(store.table("commits"))
    bronze.put("commits", "o", "r", [commit("c")], count=2)
    feed = replace(forge.COMMIT_FEED, damaged="warn")
    run = jobs.run_entity(spark, store, feed, forge.COMMITS, forge.REPO_IDS, Scope("2026-04-06"), RUN)
    assert (run.pages, run.records, run.miscounted_pages, run.corrupt_pages) == (6, 5, 1, 1)
    failed, passed = (read_runs(spark, store.table("_runs")).filter("job = 'commits'").orderBy("status").collect())
    assert (failed.status, failed.corrupt_pages, passed.status, passed.corrupt_pages) == ("FAILED", 1, "SUCCESS", 1)
    kept = spark.read.json(store.table("_quarantine")).collect()
    assert {(r.endpoint, r.text) for r in kept} == {("commits", cut)} and len(kept) == 2
    bronze.put("repo_metadata", "o", "r", None, text="{broken")
    with pytest.raises(QualityError, match="corrupt_pages=1"):
        forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)


def test_wrongly_typed_field_is_null(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", size="large"))
    run = forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    assert run.corrupt_pages == 0 and read_table(spark, store.table("repo_metadata")).first().size_kb is None


def test_long_errors_are_kept_whole(spark, folder):
    with pytest.raises(ValueError):
        with Run(spark, folder + "/_runs", "job"):
            raise ValueError("x" * 10_000)
    assert len(read_runs(spark, folder + "/_runs").first().error) == 10_000


def test_lookup_reads_the_current_versions(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r"))
    bronze.put("repo_metadata", "o", "r", repo(11, "o/r"), batch="2026-04-13T02:00:00Z")
    for day in ("2026-04-13", "2026-04-06"):  # the older date does not replace the newer version
        forge.repos_job(spark, store, Scope(day), RUN, layout)
    with Scratch(spark) as scratch:
        values = jobs.newest(spark, store, forge.REPO_IDS, scratch)
        assert [tuple(r) for r in values.collect()] == [("o/r", 11)]
        plan = values._jdf.queryExecution().executedPlan().toString()
        assert all("repo_metadata_current" in f for f in values.inputFiles())
    assert "Window " not in plan


def test_two_dates_in_one_upsert_batch_are_refused(spark, world):
    bronze, store, layout = world
    fill(bronze)
    bronze.put("issues", "o", "r", [issue(1)], batch="2026-04-13T02:00:00Z")
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    with pytest.raises(QualityError, match=r"unique\(repo_full_name,issue_id\)=1"):
        forge.issues_job(spark, store, Scope(), RUN, layout)


def test_later_dates_and_partition_moves(spark, world):
    bronze, store, layout = world
    fill(bronze)
    bronze.put("repo_metadata", "o", "r", repo(11, "o/r"), batch="2026-04-13T02:00:00Z")
    bronze.put("commits", "o", "r", [commit("a", "again"), commit("z")], batch="2026-04-13T02:00:00Z")
    bronze.put("issues", "o", "r", [issue(3, state="closed")], batch="2026-04-13T02:00:00Z")
    backfill(lambda day: forge.run_date(spark, store, Scope(day), RUN, layout), ["2026-04-13", "2026-04-06"])
    assert read_table(spark, store.table("repo_metadata")).count() == 3  # history stays
    got = {(r.repo_full_name, r.commit_id): (r.message, str(r.snapshot_date), r.repo_id)
           for r in read_table(spark, store.table("commits")).collect()}
    assert got[("o/r", "a")] == ("again", "2026-04-13", 11) and got[("o/r", "b")][1:] == ("2026-04-06", 1)
    assert len(got) == 4 and read_table(spark, store.table("commits")).count() == 4
    issues = {r.issue_id: r.issue_state for r in read_table(spark, store.table("issues")).collect()}
    assert issues == {1: "closed", 3: "closed"}


def test_nothing_landed(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout)
    _, commits, issues = forge.run_date(spark, store, Scope("2026-04-06"), RUN, layout, allow_missing=True)
    assert commits.rows_written == {"commits": 0} and issues.rows_written == {"issues": 0, "pulls": 0}
    assert read_table(spark, store.table("commits")).columns == COMMIT_COLUMNS


def test_malformed_timestamp_fails_the_job(spark, world):
    bronze, store, layout = world
    bronze.put("repo_metadata", "o", "r", repo(1, "o/r", created_at="nope"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)


def test_streams_equal_the_batch(spark, any_world):
    bronze, store, layout = any_world
    fill(bronze)
    forge.repos_job(spark, store, Scope("2026-04-06"), RUN, layout)
    checkpoints = os.path.dirname(store.silver)

    def run():
        commits = forge.stream_commits(spark, store, checkpoints + "/c1", layout, run_ts=RUN)
        return commits, forge.stream_issues(spark, store, checkpoints + "/c2", layout, run_ts=RUN)

    assert run() == (1, 1) and run() == (0, 0)  # nothing new, no batch
    bronze.put("commits", "o", "r", [commit("z"), commit("a", "newest")], fetched="2026-04-06T09:00:00Z")
    bronze.put("issues", "o", "r", [issue(2, pull_request={}), issue(9)], fetched="2026-04-06T09:00:00Z")
    assert run() == (1, 1)
    batch = Store(store.bronze, store.silver + "-other")
    forge.run_date(spark, batch, Scope("2026-04-06"), RUN, layout)
    for name in ("commits", "issues", "pulls"):
        streamed, expected = read_table(spark, store.table(name)), read_table(spark, batch.table(name))
        assert streamed.schema == expected.schema
        assert sorted(streamed.collect(), key=str) == sorted(expected.collect(), key=str)
    runs = read_runs(spark, store.table("_runs")).filter("job <> 'repo_metadata'")
    assert runs.filter("status = 'SUCCESS' and pages > 0").count() == 4


def test_cli(spark, folder):
    bronze = Bronze(folder + "/bronze", "bare")
    fill(bronze)
    base = ["--bronze", folder + "/bronze/", "--silver", folder + "/silver", "--layout", "bare", "--process-date"]
    cli.main(["all", *base, "2026-04-06"])
    cli.main(["commits", *base, "2026-04-06", "--owner", "o", "--repo", "r"])
    assert read_table(spark, folder + "/silver/commits").count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        cli.main(["commits", *base, "2026-04-13"])
    bronze.put("commits", "o", "r", [commit("late")], batch="2026-04-20T02:00:00Z")
    cli.main(["commits", *base, "2026-04-20", "2026-04-13", "2026-04-06", "--allow-missing"])
    assert read_table(spark, folder + "/silver/commits").count() == 4
    with pytest.raises(Exception, match="delta"):
        cli.main(["repos", *base, "2026-04-06", "--format", "delta"])
    with pytest.raises(SystemExit):
        cli.main(["repos", *base, "2026-04-06", "--owner", "o"])
    with pytest.raises(SystemExit):
        cli.main(["repos", *base, "not-a-date"])


class Forge:
    """A remote with two repositories; issues come without a last link."""

    def get(self, owner, repo_name, endpoint, params, page=None, url=None):
        if endpoint == "repo_metadata":
            return Response("u", json.dumps(repo({"r": 1, "s": 2}[repo_name], f"{owner}/{repo_name}")))
        if endpoint == "commits":
            assert params["until"] and params["since"]
            body = [commit(f"{repo_name}{page}{i}") for i in range(2)]
            return Response("u", json.dumps(body), "n", "https://x.org/?page=3")
        assert params["state"] == "all" and "until" not in params
        page = page or int(url)
        body = [issue(page, pull_request={} if page == 2 else None)]
        return Response("u", json.dumps(body), str(page + 1) if page < 3 else None)


@pytest.mark.parametrize("layout", ["keyed", "bare"])
def test_landing_run_to_tables(spark, folder, layout):
    store = Store(folder + "/bronze", folder + "/silver")
    entities = spark.createDataFrame([("o", "r"), ("o", "s")], "owner string, repo string")
    since, until = datetime(2026, 3, 30, tzinfo=timezone.utc), datetime(2026, 4, 6, tzinfo=timezone.utc)
    forge.land_run(spark, store, entities, Forge(), until, since, until, layout=layout)
    if layout == "bare":
        assert os.listdir(folder + "/bronze/commits/o/r/yyyy=2026/mm=04/dd=06") == ["hh=00"]
        assert sorted(f for f in os.listdir(folder + "/bronze/repo_metadata/o") if not f.startswith("_")) == ["r", "s"]
    repos, commits, issues = forge.run_date(spark, store, Scope("2026-04-06"), layout=layout)
    assert (repos.pages, commits.pages, commits.records, issues.pages) == (2, 6, 12, 6)
    assert issues.rows_written == {"issues": 4, "pulls": 2}
    table = read_table(spark, store.table("commits"))
    assert table.groupBy("repo_full_name", "repo_id").count().count() == 2 and table.count() == 12
    with pytest.raises(ValueError, match="not in the entity list"):
        forge.land_run(spark, store, entities, Forge(), until, since, until, owner="o", repo="none")

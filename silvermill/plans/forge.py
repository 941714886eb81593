"""Code-hosting tables: repository snapshots, commits, issues and pull requests."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from silvermill.plans.audit import Run
from silvermill.plans.jobs import run_entity, run_snapshot, run_split_entity
from silvermill.plans.landing import land_remote, land_remote_snapshots
from silvermill.plans.specs import Feed, Lookup, Store, Table
from silvermill.sources.entities import scope_entities
from silvermill.sources.envelopes import Scope
from silvermill.sources.paged import Transport
from silvermill.streaming.ingest import stream_entity, stream_split

# Envelope fields read, and the output columns they become, in order.

ENVELOPE = "owner string, repo string, fetched_at string, batch_timestamp string, endpoint string"

REPO_SCHEMA = f"""{ENVELOPE},
data struct<id bigint, full_name string, html_url string, description string,
  owner struct<id bigint, login string>,
  created_at string, updated_at string, pushed_at string,
  homepage string, size bigint, language string, organization struct<id bigint>,
  network_count bigint, open_issues_count bigint, stargazers_count bigint, subscribers_count bigint>"""

REPO_FIELDS = (
    "data.id as repo_id",
    "data.full_name as repo_full_name",
    "data.html_url as repo_url",
    "data.description as description",
    "data.owner.id as owner_id",
    "data.owner.login as owner_login",
    "to_timestamp(data.created_at) as created_at",
    "to_timestamp(data.updated_at) as updated_at",
    "to_timestamp(data.pushed_at) as pushed_at",
    "data.homepage as homepage_url",
    "data.size as size_kb",
    "data.language as main_language",
    "data.organization.id as org_id",
    "data.network_count as network_count",
    "data.open_issues_count as open_issues_count",
    "data.stargazers_count as stargazers_count",
    "data.subscribers_count as subscribers_count",
    "to_timestamp(fetched_at) as bronze_ingested_at",
    "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
)

COMMIT_SCHEMA = f"""{ENVELOPE},
count bigint,
data array<struct<sha string, html_url string,
  commit struct<author struct<name string, email string, date string>, message string>,
  author struct<id bigint, login string>>>"""

COMMIT_FIELDS = (
    "record.sha as commit_id",
    "record.commit.message as message",
    "record.html_url as url",
    "record.author.id as user_id",
    "to_timestamp(fetched_at) as bronze_ingested_at",
    "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    "to_timestamp(record.commit.author.date) as committed_at",
    "concat_ws('/', owner, repo) as repo_full_name",
    "record.commit.author.name as git_author_name",
    "record.commit.author.email as git_author_email",
    "record.author.login as author_login",
)

ISSUE_SCHEMA = f"""{ENVELOPE},
count bigint,
data array<struct<url string, html_url string, id bigint, number bigint, title string,
  user struct<login string, id bigint, type string>, state string, comments bigint,
  created_at string, updated_at string, closed_at string,
  author_association string, body string, state_reason string,
  closed_by struct<login string, id bigint>,
  pull_request struct<url string, html_url string, merged_at string>,
  reactions struct<total_count bigint>>>"""

ISSUE_FIELDS = (
    "to_timestamp(fetched_at) as bronze_ingested_at",
    "to_timestamp(batch_timestamp) as bronze_batch_timestamp",
    "fetched_at as fetched_at",
    "concat_ws('/', owner, repo) as repo_full_name",
    "record.url as api_url",
    "record.html_url as html_url",
    "record.id as issue_id",
    "record.number as issue_number",
    "record.title as issue_title",
    "record.user.id as user_id",
    "record.user.login as user_login",
    "record.user.type as user_type",
    "record.user.type = 'Bot' as is_bot",
    "record.state as issue_state",
    "to_timestamp(record.created_at) as created_at",
    "to_timestamp(record.updated_at) as updated_at",
    "to_timestamp(record.closed_at) as closed_at",
    "record.author_association as author_type",
    "record.closed_by.id as closed_by_user_id",
    "record.closed_by.login as closed_by_login",
    "record.comments as comments_count",
    "record.body as body",
    "record.state_reason as state_reason",
    "record.pull_request.url as pull_request_api_url",
    "record.pull_request.html_url as pull_request_html_url",
    "to_timestamp(record.pull_request.merged_at) as pull_request_merged_at",
    "record.pull_request is not null as is_pull_request",
    "record.reactions.total_count as reactions_total_count",
)

PULL_RENAMES = {
    "issue_id": "pull_id",
    "issue_number": "pull_number",
    "issue_title": "pull_title",
    "issue_state": "pull_state",
}

# A value of an odd type in one repository's snapshot is null; it does not hold the others back.
REPO_FEED = Feed("repo_metadata", REPO_SCHEMA, REPO_FIELDS, misfits="warn")
COMMIT_FEED = Feed("commits", COMMIT_SCHEMA, COMMIT_FIELDS)
ISSUE_FEED = Feed("issues", ISSUE_SCHEMA, ISSUE_FIELDS)

REPOS = Table(
    "repo_metadata",
    dedupe_keys=("repo_id", "snapshot_date"),
    required=("repo_id", "repo_full_name", "repo_url", "snapshot_date"),
    not_negative=("size_kb", "network_count", "open_issues_count", "stargazers_count", "subscribers_count"),
    current_by=("repo_full_name",),
    current_order=("bronze_ingested_at", "repo_id"),
)
COMMITS = Table(
    "commits",
    dedupe_keys=("repo_full_name", "commit_id"),
    publish_keys=("repo_full_name", "commit_id"),
    required=("commit_id", "repo_full_name", "url", "snapshot_date"),
    not_blank=("repo_full_name",),
    partition_by=("snapshot_date",),
)
ISSUES = Table(
    "issues",
    dedupe_keys=("repo_full_name", "issue_id", "snapshot_date"),
    publish_keys=("repo_full_name", "issue_id"),
    required=("issue_id", "repo_full_name", "html_url", "snapshot_date"),
    not_blank=("repo_full_name",),
)
PULLS = Table(
    "pulls",
    dedupe_keys=("repo_full_name", "pull_id", "snapshot_date"),
    publish_keys=("repo_full_name", "pull_id"),
    required=("pull_id", "repo_full_name", "html_url", "snapshot_date"),
    not_blank=("repo_full_name",),
    renames=PULL_RENAMES,
)
REPO_IDS = Lookup("repo_metadata", key=("repo_full_name",), values=("repo_id",), version=("snapshot_date", *REPOS.current_order))

# End of the fixed values.


def land_run(
    spark: SparkSession, store: Store, entities: DataFrame, transport: Transport, run_ts: datetime,
    since: datetime, until: datetime, scheduled: bool = True, owner: str | None = None, repo: str | None = None,
    layout: str = "keyed",
) -> None:
    """Land an interval of all endpoints for all listed entities, or for one. Issues have no upper
    bound, as a later change must not hide them. Only scheduled runs move the high-water marks."""
    entities = scope_entities(entities, owner, repo)
    land_remote_snapshots(store, REPO_FEED.endpoint, entities, transport, run_ts, layout)
    land_remote(spark, store, ISSUE_FEED.endpoint, entities, transport, run_ts, since, mark=scheduled, layout=layout)
    land_remote(spark, store, COMMIT_FEED.endpoint, entities, transport, run_ts, since, until, mark=scheduled, layout=layout)


def with_layout(feed: Feed, layout: str) -> Feed:
    return replace(feed, layout=layout)


def repos_job(spark: SparkSession, store: Store, scope: Scope, run_ts: datetime | None = None, layout: str = "keyed") -> Run:
    return run_snapshot(spark, store, with_layout(REPO_FEED, layout), REPOS, scope, run_ts=run_ts)


def commits_job(
    spark: SparkSession, store: Store, scope: Scope, run_ts: datetime | None = None, layout: str = "keyed",
    allow_missing: bool = False,
) -> Run:
    return run_entity(spark, store, with_layout(COMMIT_FEED, layout), COMMITS, REPO_IDS, scope, run_ts, allow_missing)


def issues_job(
    spark: SparkSession, store: Store, scope: Scope, run_ts: datetime | None = None, layout: str = "keyed",
    allow_missing: bool = False,
) -> Run:
    return run_split_entity(
        spark, store, with_layout(ISSUE_FEED, layout), "is_pull_request", ISSUES, PULLS, REPO_IDS, scope, run_ts,
        allow_missing,
    )


def stream_commits(spark: SparkSession, store: Store, checkpoint: str, layout: str = "keyed", **options) -> int:
    """Commits of newly landed files, once each."""
    return stream_entity(spark, store, with_layout(COMMIT_FEED, layout), COMMITS, checkpoint, REPO_IDS, **options)


def stream_issues(spark: SparkSession, store: Store, checkpoint: str, layout: str = "keyed", **options) -> int:
    """Issues and pull requests of newly landed files, once each."""
    feed = with_layout(ISSUE_FEED, layout)
    return stream_split(spark, store, feed, "is_pull_request", ISSUES, PULLS, checkpoint, REPO_IDS, **options)


def run_date(
    spark: SparkSession, store: Store, scope: Scope, run_ts: datetime | None = None, layout: str = "keyed",
    allow_missing: bool = False,
) -> list[Run]:
    """All tables of one date. Repositories come first, because the others look their ids up."""
    return [
        repos_job(spark, store, scope, run_ts, layout),
        commits_job(spark, store, scope, run_ts, layout, allow_missing),
        issues_job(spark, store, scope, run_ts, layout, allow_missing),
    ]

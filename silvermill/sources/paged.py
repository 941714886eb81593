"""Paged remote source: requests planned, spread and sent by Spark tasks.

A transport answers single requests. Each entity's first page tells how many pages there are;
those are planned as rows, shuffled by block and fetched by ``mapInArrow``. The tasks pass the
response text on untouched; Spark parses it afterwards. A request that fails fails its task, and
after Spark's retries the job.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvermill.functions.columns import url_param
from silvermill.operators.paging import PAGE_SIZE, plan_pages
from silvermill.session import Scratch

# Executors need not have this package installed: what they run is sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Response:
    url: str
    body: str
    next_url: str | None = None
    last_url: str | None = None


class Transport(Protocol):
    """Sends one request: the entity itself (no page), a page by number, or a page by the URL an
    earlier response named."""

    def get(
        self, owner: str, repo: str, endpoint: str, params: dict, page: int | None = None, url: str | None = None
    ) -> Response: ...


def request_params(
    endpoint: str, since: str | None = None, until: str | None = None, given: dict | None = None
) -> dict:
    """Parameters of a page request: defaults and bounds, under what the caller gives."""
    params = {"per_page": PAGE_SIZE}
    if endpoint in STATEFUL_ENDPOINTS:
        params["state"] = "all"
    if since:
        params["since"] = since
    if until:
        params["until"] = until
    return {**params, **(given or {})}


# Fixed value: the endpoint whose records have a state; without the parameter only open ones come.
STATEFUL_ENDPOINTS = ("issues",)


def page_count(last_url: Column | str, next_url: Column | str, items: Column | str) -> Column:
    """How many pages an entity has, as told by its first page: the number in the link to the last one;
    unknown (null) when only the next one is linked; without links one, or none if the page is empty."""
    col = lambda c: F.col(c) if isinstance(c, str) else c
    last, following = col(last_url), col(next_url)
    alone = F.when(following.isNull(), (col(items) > 0).cast("long"))
    return F.coalesce(F.when(last.isNotNull(), url_param(last, "page", "1").cast("long")), alone)


def _per_row(send: Callable[[dict], Iterator[dict]], columns: dict[str, pa.DataType]):
    """Arrow batches of requests to Arrow batches of up to 64 answers."""
    schema = pa.schema(list(columns.items()))

    def run(batches):
        for batch in batches:
            waiting = []
            for row in batch.to_pylist():
                for answer in send(row):
                    waiting.append(answer)
                    if len(waiting) == 64:
                        yield pa.RecordBatch.from_pylist(waiting, schema)
                        waiting = []
            if waiting:
                yield pa.RecordBatch.from_pylist(waiting, schema)

    return run


_KEYS = {"owner": pa.string(), "repo": pa.string(), "since": pa.string()}
_KEYS_DDL = "owner string, repo string, since string"
_ANSWER = {**_KEYS, "page": pa.int64(), "url": pa.string(), "fetched_at": pa.string(), "body": pa.string()}
_ANSWER_DDL = f"{_KEYS_DDL}, page bigint, url string, fetched_at string, body string"


def _answer(row: dict, page: int | None, response: Response) -> dict:
    now = datetime.now(timezone.utc).isoformat()
    return {**{k: row[k] for k in _KEYS}, "page": page, "url": response.url, "fetched_at": now, "body": response.body}


def _requests(entities: DataFrame, tasks: int) -> DataFrame:
    """One row per entity (owner, repo, and since where it has one), spread over ``tasks``. A
    fixed number: AQE would see a few bytes of names and send all requests from one task."""
    since = F.col("since") if "since" in entities.columns else F.lit(None).cast("string").alias("since")
    return entities.select("owner", "repo", since).dropDuplicates(["owner", "repo"]).repartition(tasks, "owner", "repo")


def fetch_entities(entities: DataFrame, transport: Transport, endpoint: str, tasks: int | None = None) -> DataFrame:
    """One response per entity, about the entity itself."""
    tasks = tasks or entities.sparkSession.sparkContext.defaultParallelism

    def send(row):
        yield _answer(row, None, transport.get(row["owner"], row["repo"], endpoint, {}))

    return _requests(entities, tasks).mapInArrow(_per_row(send, _ANSWER), _ANSWER_DDL)


def fetch_pages(
    entities: DataFrame,
    transport: Transport,
    endpoint: str,
    scratch: Scratch,
    until: str | None = None,
    given: dict | None = None,
    block: int = 10,
    tasks: int | None = None,
) -> DataFrame:
    """All pages of the entities: owner, repo, since, page, url, fetched_at, body.

    ``entities`` has owner, repo and optionally since, the lower bound sent for that entity.
    Known page counts are fetched in parallel, ``block`` pages to a shuffle key. An entity whose
    count is unknown is followed link by link in one task, the only order it can be read in.
    """
    tasks = tasks or scratch.spark.sparkContext.defaultParallelism

    def get(row, page=None, url=None):
        params = request_params(endpoint, row["since"], until, given)
        return transport.get(row["owner"], row["repo"], endpoint, params, page=page, url=url)

    def probe(row):
        first = get(row, page=1)
        keys = {k: row[k] for k in _KEYS}
        yield {**keys, "last_url": first.last_url, "next_url": first.next_url, "body": first.body}

    def one_page(row):
        yield _answer(row, row["page"], get(row, page=row["page"]))

    def follow(row):
        page, response = 1, get(row, page=1)
        yield _answer(row, page, response)
        while response.next_url:
            page, response = page + 1, get(row, url=response.next_url)
            yield _answer(row, page, response)

    links = {"last_url": pa.string(), "next_url": pa.string(), "body": pa.string()}
    probed = _requests(entities, tasks).mapInArrow(
        _per_row(probe, {**_KEYS, **links}), f"{_KEYS_DDL}, last_url string, next_url string, body string"
    )
    pages = page_count("last_url", "next_url", F.json_array_length("body"))
    # Staged, so that both branches below see the same answer and no entity is asked twice.
    totals = scratch.stage(probed.select(*_KEYS, pages.alias("pages")), "totals")
    known = plan_pages(totals, list(_KEYS), block, tasks)
    unknown = totals.filter("pages is null").repartition(tasks, "owner", "repo")
    return known.mapInArrow(_per_row(one_page, _ANSWER), _ANSWER_DDL).unionByName(
        unknown.mapInArrow(_per_row(follow, _ANSWER), _ANSWER_DDL)
    )


def raw_envelopes(
    responses: DataFrame, endpoint: str, run_ts: datetime, until: str | None = None, given: dict | None = None
) -> DataFrame:
    """Responses to envelopes whose data keeps every field that was received, as a variant. Text
    that is not JSON fails the job."""
    sent = request_params(endpoint, None, until, given)
    params = {"page": F.col("page"), "since": F.col("since"), **{k: F.lit(v) for k, v in sent.items()}}
    return responses.select(
        "owner",
        "repo",
        "fetched_at",
        F.lit(endpoint).alias("endpoint"),
        F.struct(*[value.alias(name) for name, value in params.items()]).alias("params"),
        "url",
        F.json_array_length("body").cast("long").alias("count"),
        F.parse_json("body").alias("data"),
        F.lit(run_ts.isoformat()).alias("batch_timestamp"),
    )

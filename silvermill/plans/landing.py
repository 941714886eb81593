"""Landing runs: incremental selection, envelopes, append, and only then the high-water mark."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.functions.columns import instant, iso_text, run_stamp
from silvermill.operators.incremental import after_marks, in_states, in_window
from silvermill.plans.specs import Store
from silvermill.session import Scratch
from silvermill.sinks.landing import ENTITY, land, page_envelopes, snapshot_envelopes
from silvermill.sinks.upsert import SilverTable, read_table, upsert
from silvermill.sources.paged import Transport, fetch_entities, fetch_pages, raw_envelopes

MARK_KEYS = ("owner", "repo", "endpoint")


def read_marks(spark: SparkSession, path: str, endpoint: str) -> DataFrame | None:
    """The endpoint's marks, or None before the first; any other failure to read them raises."""
    if not SilverTable(spark, path).state():
        return None
    return read_table(spark, path).filter(F.col("endpoint") == F.lit(endpoint)).drop("endpoint")


def write_marks(marks: DataFrame, path: str) -> None:
    """Upsert (owner, repo, endpoint, last_run)."""
    upsert(marks.select(*MARK_KEYS, "last_run"), path, MARK_KEYS)


def land_records(
    spark: SparkSession, store: Store, endpoint: str, records: DataFrame, entities: DataFrame,
    run_ts: datetime, ts: str, since: datetime | None = None, until: datetime | None = None,
    states: tuple[str, list[str]] | None = None, mark: bool = False, fetched_at: datetime | None = None,
    layout: str = "keyed",
) -> None:
    """Land one endpoint's records (owner, repo, ``ts``, …) of the listed entities.

    Lower bound: ``since`` if given, else each entity's high-water mark, else everything. With
    ``mark`` the marks move to ``run_ts`` once the pages are landed; rows at a mark belong to the
    next run, so a run up to ``until=run_ts`` and the next one neither lose nor repeat a row.
    """
    marks_path = store.table("_marks")
    run = run_stamp(run_ts)
    with Scratch(spark) as scratch:
        entities = scratch.stage(entities.select(*ENTITY).distinct(), "entities")
        chosen = in_window(records.join(entities, list(ENTITY), "left_semi"), ts, since, until)
        if states is not None:
            chosen = in_states(chosen, *states)
        marks = read_marks(spark, marks_path, endpoint) if since is None else None
        if marks is not None:
            chosen = after_marks(chosen, marks, ENTITY, ts, inclusive=True)
        envelopes = page_envelopes(
            chosen.withColumn("batch_ts", run),
            endpoint,
            scratch,
            run_stamp(fetched_at) if fetched_at else F.current_timestamp(),
            since=None if since is None else instant(since),
            until=None if until is None else instant(until),
        )
        land(envelopes, store.landed(endpoint), layout=layout)
        if mark:
            done = entities.select(*ENTITY, F.lit(endpoint).alias("endpoint"), run.alias("last_run"))
            write_marks(done, marks_path)


def land_remote(
    spark: SparkSession, store: Store, endpoint: str, entities: DataFrame, transport: Transport,
    run_ts: datetime, since: datetime | None = None, until: datetime | None = None,
    incremental: bool = True, mark: bool = False, given: dict | None = None, layout: str = "keyed",
) -> None:
    """Land all pages a paged remote source has for the listed entities; the remote applies the
    bounds. Lower bound: ``since``, else when incremental each entity's high-water mark, else none."""
    upper = until.isoformat() if until else None
    with Scratch(spark) as scratch:
        asked = entities.select(*ENTITY).distinct()
        marks = read_marks(spark, store.table("_marks"), endpoint) if incremental and since is None else None
        if marks is not None:
            bound = marks.select(*ENTITY, iso_text("last_run").alias("since"))
            asked = asked.join(bound, list(ENTITY), "left")
        else:
            asked = asked.withColumn("since", F.lit(since.isoformat() if since else None).cast("string"))
        asked = scratch.stage(asked, "entities")
        responses = fetch_pages(asked, transport, endpoint, scratch, upper, given)
        land(raw_envelopes(responses, endpoint, run_ts, upper, given), store.landed(endpoint), layout=layout)
        if mark:
            run = run_stamp(run_ts).alias("last_run")
            write_marks(asked.select(*ENTITY, F.lit(endpoint).alias("endpoint"), run), store.table("_marks"))


def land_remote_snapshots(
    store: Store, endpoint: str, entities: DataFrame, transport: Transport, run_ts: datetime, layout: str = "keyed"
) -> None:
    """Ask for each listed entity itself and land one envelope per entity."""
    envelopes = raw_envelopes(fetch_entities(entities, transport, endpoint), endpoint, run_ts)
    land(envelopes.drop("params", "url", "count"), store.landed(endpoint), by_entity=False, layout=layout)


def land_snapshots(
    store: Store, endpoint: str, records: DataFrame, run_ts: datetime, fetched_at: datetime | None = None,
    layout: str = "keyed",
) -> None:
    """Land one envelope per entity; the columns beside owner and repo form its data."""
    fetched = run_stamp(fetched_at) if fetched_at else F.current_timestamp()
    rows = records.withColumn("batch_ts", run_stamp(run_ts))
    land(snapshot_envelopes(rows, endpoint, fetched), store.landed(endpoint), by_entity=False, layout=layout)

"""The composed jobs: snapshot tables, entity tables, and feeds split into two entity tables.

Each job parses its JSON once into a staged flat table, computes the rows to publish once from
that, and publishes only after every gate of the job has passed.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.operators.enrich import enrich_left
from silvermill.operators.flatten import flatten_pages, flatten_snapshots, split_by, stamp
from silvermill.operators.latest import latest_by, latest_lookup, row_hash
from silvermill.operators.quality import Observed, QualityError, Rule, enforce, evaluate, judge, rules_for
from silvermill.plans.audit import Run
from silvermill.plans.current import Follower, read_current
from silvermill.plans.specs import Feed, Lookup, Store, Table
from silvermill.session import Scratch
from silvermill.sinks import delta
from silvermill.sinks.landing import ENTITY
from silvermill.sinks.replace import replace_where
from silvermill.sinks.upsert import SilverTable, merge, read_table, write_draft
from silvermill.sources.damage import count_misfits, misfit_counts
from silvermill.sources.envelopes import Scope, scan_envelopes

log = logging.getLogger(__name__)

CORRUPT = "_corrupt"


def _run(spark: SparkSession, store: Store, job: str, scope: Scope, run_ts: datetime | None) -> Run:
    run = Run(spark, store.table("_runs"), job, scope.process_date, scope.owner, scope.repo)
    if run_ts is not None:
        run.started_at = run_ts
    return run


def _flat(
    run: Run, store: Store, feed: Feed, envelopes: DataFrame, scratch: Scratch, paged: bool,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Flatten, stamp and stage scanned envelopes. Envelopes and records are counted on the way: the
    staging job has no shuffle, so a lost executor cannot make them count twice.

    A page is damaged when it cannot be read as JSON, when what should be its records or their count is something
    else, or when the count is not the number of its records; the feed's ``damaged`` decides whether the job then
    fails or warns. A page in which values do not fit their fields, which are null, is subject to the feed's
    ``misfits``. The text of both goes to the table ``_quarantine``, with the fields that do not fit; only for
    those pages a line is parsed once more.
    """
    pages, records = Observation(), Observation()
    fields = [f for f in envelopes.columns if f != CORRUPT]
    stated = paged and "count" in fields
    # Owner and repo may come from the folder.
    nothing = functools.reduce(Column.__and__, [F.col(f"`{f}`").isNull() for f in fields if f not in ENTITY])
    hollow = [F.col(f).isNull() for f in ("data", *(["count"] if stated else [])) if f in fields]
    damaged = functools.reduce(Column.__or__, [nothing, *hollow])
    unread = F.col(CORRUPT).isNotNull() & damaged
    odd = F.col(CORRUPT).isNotNull() & ~damaged
    wrong = F.count_if(F.coalesce(F.size("data"), F.lit(0)) != F.col("count")) if stated else F.count_if(F.lit(False))
    counted = envelopes.observe(
        pages, F.count("*").alias("n"), wrong.alias("wrong"), F.count_if(unread).alias("unread"), F.count_if(odd).alias("odd")
    )
    flatten = flatten_pages if paged else flatten_snapshots
    flat = stamp(flatten(counted, feed.fields), run.started_at).observe(records, F.count("*").alias("n"))
    staged = scratch.stage(flat, feed.endpoint, partition_by)
    run.pages, run.records = pages.get["n"], records.get["n"]
    run.miscounted_pages, run.corrupt_pages, run.misfit_pages = (pages.get[n] for n in ("wrong", "unread", "odd"))
    if run.corrupt_pages or run.misfit_pages:
        kept = envelopes.filter(unread | odd).select(
            F.lit(run.job_run_id).alias("job_run_id"), F.lit(feed.endpoint).alias("endpoint"),
            F.col(CORRUPT).alias("text"), misfit_counts(CORRUPT, feed.schema).alias("misfits"),
        )
        kept = scratch.stage(kept, "quarantine")
        kept.write.mode("append").json(store.table("_quarantine"))
        run.misfits = count_misfits(kept)
    if run.corrupt_pages or run.miscounted_pages:
        _report(f"{run.job}: corrupt_pages={run.corrupt_pages}; miscounted_pages={run.miscounted_pages}", feed.damaged)
    if run.misfit_pages:
        fields = ", ".join(f"{name}={n}" for name, n in run.misfits.items())
        _report(f"{run.job}: misfit_pages={run.misfit_pages}; {fields}", feed.misfits)
    return staged


def _report(problem: str, severity: str) -> None:
    if severity == "error":
        raise QualityError(problem)
    log.warning(problem)


def _scan(run: Run, store: Store, feed: Feed, scope: Scope, allow_missing: bool = False) -> DataFrame:
    return scan_envelopes(
        run.spark, store.landed(feed.endpoint), feed.schema, scope, feed.layout,
        endpoint=feed.endpoint if "endpoint" in T.StructType.fromDDL(feed.schema).fieldNames() else None,
        allow_missing=allow_missing, corrupt_column=CORRUPT,
    )


def read_silver(spark: SparkSession, store: Store, name: str) -> DataFrame:
    path = store.table(name)
    return delta.read_table(spark, path) if store.format == "delta" else read_table(spark, path)


def newest(spark: SparkSession, store: Store, lookup: Lookup | None, scratch: Scratch) -> DataFrame | None:
    """The lookup's newest version per key, staged: read once however many tables it enriches."""
    if lookup is None:
        return None
    current = read_current(spark, store, lookup.table) if store.format != "delta" else None
    if current is not None:
        return current.select(*lookup.key, *lookup.values)
    silver = read_silver(spark, store, lookup.table)
    return scratch.stage(latest_lookup(silver, lookup.key, lookup.values, lookup.version), "lookup")


def shape(flat: DataFrame, table: Table, lookup: Lookup | None = None, values: DataFrame | None = None) -> DataFrame:
    """Flat rows to the rows a table would get: renamed, latest per key, enriched.

    Where the lookup's key is part of the dedupe key, rows are enriched first: a join that shuffles them leaves them as
    the latest row per key needs them, so they are shuffled once instead of twice. The same rows stay, as a lookup has
    one row per key and ties are decided by the flat row alone."""
    df = flat.withColumnsRenamed(dict(table.renames))
    if lookup is None:
        return latest_by(df, table.dedupe_keys, table.order)
    if lookup.normalize is None and {*lookup.key} <= {*table.dedupe_keys} and not {*lookup.values} & {*df.columns}:
        return latest_by(enrich_left(df, values, lookup.key, lookup.values), table.dedupe_keys, table.order, [row_hash(df)])
    return enrich_left(latest_by(df, table.dedupe_keys, table.order), values, lookup.key, lookup.values, lookup.normalize)


@dataclass
class Candidate:
    """Rows computed and written once, ready to be checked and then published."""

    rows: DataFrame
    publish: Callable[[], None]
    discard: Callable[[], None]
    observed: Observed | None = None


def gate_rules(table: Table, empty: str, lookup: Lookup | None = None) -> list[Rule]:
    """The gate of a table. Rows that were made unique on some of the publish keys are unique on all of them, so that
    rule is left out."""
    proven = bool(table.publish_keys) and set(table.dedupe_keys) <= set(table.publish_keys)
    return rules_for(
        required=table.required,
        not_blank=table.not_blank,
        not_negative=table.not_negative,
        unique=() if proven else table.publish_keys,
        known=lookup.values if lookup else (),
        empty=empty,
    )


def upsert_candidate(
    spark: SparkSession, store: Store, table: Table, df: DataFrame, scratch: Scratch, one_day: bool,
    lookup: Lookup | None = None, marks: Mapping[str, object] | None = None, staged_bytes: int = 0,
) -> Candidate:
    """Write a draft, and measure the gate's row rules as it is written. ``staged_bytes`` is what the flat rows that
    ``df`` is made of take, which says how many buckets a table or date that starts now will need."""
    path, keys = store.table(table.name), table.publish_keys
    if store.format == "delta":
        rows = scratch.stage(df, table.name)
        return Candidate(rows, lambda: delta.upsert(rows, path, keys, table.partition_by, table.newer_by), lambda: None)
    one_partition = one_day and table.partition_by == ("snapshot_date",)
    observed = Observed(gate_rules(table, "warn", lookup), table.dedupe_keys)
    draft = write_draft(
        spark, df, path, keys, table.partition_by, not one_partition, table.buckets, table.bucket_bytes,
        (observed.observation, observed.metrics), staged_bytes if one_partition or not table.partition_by else 0,
    )

    def publish() -> None:
        merge(draft, keys, table.newer_by, unique=True, marks=marks)

    return Candidate(draft.rows, publish, draft.discard, observed)


def check_and_publish(work: Sequence[tuple[Table, Candidate]], lookup: Lookup | None = None) -> dict[str, int]:
    """Publish all candidates once the gates of all have passed; drop those that were not
    published. Returns row counts."""
    waiting = [candidate for _, candidate in work]
    try:
        rows = {table.name: check(candidate, table, "warn", lookup) for table, candidate in work}
        while waiting:
            waiting[0].publish()
            waiting.pop(0)
    except Exception:
        for candidate in waiting:
            candidate.discard()
        raise
    return rows


def check(candidate: Candidate, table: Table, empty: str, lookup: Lookup | None = None) -> int:
    """The gate, from what was measured while the rows were written, else from the rows."""
    if candidate.observed is not None:
        return judge(candidate.observed.lines(candidate.rows), table.name)
    return enforce(evaluate(candidate.rows, gate_rules(table, empty, lookup)), table.name)


def run_snapshot(
    spark: SparkSession, store: Store, feed: Feed, table: Table, scope: Scope,
    entity_column: str = "repo_full_name", run_ts: datetime | None = None,
) -> Run:
    """One row per entity and day: replaces the process date, or one entity inside it. An empty
    result is an error."""
    with _run(spark, store, table.name, scope, run_ts) as run, Scratch(spark) as scratch:
        flat = _flat(run, store, feed, _scan(run, store, feed, scope), scratch, paged=False)
        observed = Observed(gate_rules(table, "error"), table.dedupe_keys)
        rows = scratch.stage(shape(flat, table).observe(observed.observation, *observed.metrics), table.name)
        written = judge(observed.lines(rows), table.name)
        entity = F.col(entity_column) == F.lit(f"{scope.owner}/{scope.repo}") if scope.owner else None
        path = store.table(table.name)
        if store.format == "delta":
            delta.replace_where(rows, path, scope.process_date, entity)
        elif table.current_by:
            with Follower(spark, store, table) as current:
                replace_where(rows, path, scope.process_date, entity)
                current.follow(rows, scope.process_date, entity)
        else:
            replace_where(rows, path, scope.process_date, entity)
        run.rows_written = {table.name: written}
    return run


@dataclass(frozen=True)
class Batch:
    """A micro-batch: its stream's id and its number there."""

    stream: str
    number: int

    def applied(self, spark: SparkSession, store: Store, table: Table) -> dict[str, int]:
        """Rows by snapshot date of this batch that the table already has."""
        if store.format == "delta":
            return {}
        state = SilverTable(spark, store.table(table.name)).state() or {}
        mark = state.get("marks", {}).get(self.stream, {})
        return mark["days"] if mark.get("batch") == self.number else {}

    def mark(self, days: dict[str, int]) -> dict[str, object]:
        return {self.stream: {"batch": self.number, "days": days}}


def _days(flat: DataFrame) -> list[date | None]:
    """The snapshot dates of a staged frame, oldest first; rows without a date come before all others."""
    days = [row[0] for row in flat.select("snapshot_date").distinct().collect()]
    return sorted(days, key=lambda day: (day is not None, day))


def publish_tables(
    run: Run, store: Store, parts: Sequence[tuple[Table, DataFrame]], lookup: Lookup | None, scratch: Scratch,
    one_day: bool, batch: Batch | None = None, staged_bytes: Sequence[int] = (),
) -> None:
    """Flat rows to upserted tables; the gates of all pass before the first is published. ``staged_bytes`` are those of
    each part, if known.

    A micro-batch may hold several dates. They are applied one after the other, oldest first, as ``backfill`` does,
    so that the later date wins. Each table's state says which dates of which batch it has: those are not
    applied again where a batch is given again."""
    values = newest(run.spark, store, lookup, scratch)
    if batch is None:
        work = [
            (table, upsert_candidate(run.spark, store, table, shape(flat, table, lookup, values), scratch, one_day, lookup, None, n))
            for (table, flat), n in zip(parts, staged_bytes or [0] * len(parts))
        ]
        run.rows_written = check_and_publish(work, lookup)
        return
    applied = {table.name: dict(batch.applied(run.spark, store, table)) for table, _ in parts}
    days = sorted({day for _, flat in parts for day in _days(flat)}, key=lambda day: (day is not None, day)) or [None]
    for day in days:
        work = []
        for table, flat in parts:
            done = applied[table.name]
            if str(day) in done:
                continue
            df = shape(flat.filter(F.col("snapshot_date").eqNullSafe(F.lit(day).cast("date"))), table, lookup, values)
            # The rows are counted before they are published; the marks are written with them.
            marks = batch.mark(done)
            work.append((table, upsert_candidate(run.spark, store, table, df, scratch, True, lookup, marks)))
            done[str(day)] = work[-1][1].observed.rows if work[-1][1].observed else 0
        check_and_publish(work, lookup)
    run.rows_written = {name: sum(done.values()) for name, done in applied.items()}


def publish_entity(
    run: Run, store: Store, feed: Feed, table: Table, lookup: Lookup | None, envelopes: DataFrame,
    scratch: Scratch, one_day: bool, batch: Batch | None = None,
) -> None:
    """Envelopes to one upserted table: the body of the entity job and of its stream."""
    flat = _flat(run, store, feed, envelopes, scratch, paged=True, partition_by=("snapshot_date",) if batch else ())
    publish_tables(run, store, [(table, flat)], lookup, scratch, one_day, batch, [scratch.size(feed.endpoint)])


def publish_split(
    run: Run, store: Store, feed: Feed, flag: str, without: Table, having: Table, lookup: Lookup | None,
    envelopes: DataFrame, scratch: Scratch, one_day: bool, batch: Batch | None = None,
) -> None:
    """Envelopes of a mixed feed to two upserted tables. Staged by the flag, so either table reads only its
    own rows; both gates pass before either table is published."""
    partition_by = ("snapshot_date", flag) if batch else (flag,)
    flat = _flat(run, store, feed, envelopes, scratch, paged=True, partition_by=partition_by)
    parts = [*zip((without, having), split_by(flat, flag))]
    staged_bytes = [] if batch else [scratch.size(feed.endpoint, f"{flag}={str(has).lower()}") for has in (False, True)]
    publish_tables(run, store, parts, lookup, scratch, one_day, batch, staged_bytes)


def run_entity(
    spark: SparkSession, store: Store, feed: Feed, table: Table, lookup: Lookup | None, scope: Scope,
    run_ts: datetime | None = None, allow_missing: bool = False,
) -> Run:
    """One current row per key: upserted. An empty result is only a warning."""
    with _run(spark, store, table.name, scope, run_ts) as run, Scratch(spark) as scratch:
        envelopes = _scan(run, store, feed, scope, allow_missing)
        publish_entity(run, store, feed, table, lookup, envelopes, scratch, scope.process_date is not None)
    return run


def run_split_entity(
    spark: SparkSession, store: Store, feed: Feed, flag: str, without: Table, having: Table,
    lookup: Lookup | None, scope: Scope, run_ts: datetime | None = None, allow_missing: bool = False,
) -> Run:
    """A mixed feed to two entity tables."""
    with _run(spark, store, feed.endpoint, scope, run_ts) as run, Scratch(spark) as scratch:
        envelopes = _scan(run, store, feed, scope, allow_missing)
        one_day = scope.process_date is not None
        publish_split(run, store, feed, flag, without, having, lookup, envelopes, scratch, one_day)
    return run


def backfill(run_date: Callable[[str], object], process_dates: Sequence[str]) -> list:
    """``run_date(date)`` for each date, oldest first: an upsert lets the later batch win."""
    return [run_date(day) for day in sorted(process_dates)]

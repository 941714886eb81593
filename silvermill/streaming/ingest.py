"""Incremental runs over newly landed files with Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.plans.audit import Run, read_runs
from silvermill.plans.jobs import CORRUPT, Batch, publish_entity, publish_split
from silvermill.plans.specs import Feed, Lookup, Store, Table
from silvermill.session import Scratch
from silvermill.sinks.landing import TIME_PARTITIONS
from silvermill.storage import exists, read_text


def ingest_available(
    spark: SparkSession,
    root: str,
    schema: str,
    checkpoint: str,
    apply: Callable[[DataFrame, int], None],
    files_per_batch: int | None = None,
    layout: str = "keyed",
) -> int:
    """Pass every envelope file not seen before to ``apply(batch, batch_id)``, then stop.

    A batch has the columns of ``schema`` and the text of unreadable lines. Returns the number of batches
    run. A batch that was cut off is given again, so ``apply`` must be idempotent.
    """
    fields = T.StructType.fromDDL(schema).add(CORRUPT, "string")
    columns = fields.fieldNames()
    reader = spark.readStream.option("columnNameOfCorruptRecord", CORRUPT)
    if layout == "bare":
        reader = reader.option("recursiveFileLookup", "true")
    else:
        for name in TIME_PARTITIONS:
            fields = fields.add(name, "string")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    ran = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        apply(batch.select(*columns), batch_id)
        ran.append(batch_id)

    query = (
        reader.schema(fields).json(root)
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(ran)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a stream keeps as long as its checkpoint."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def _recorded(spark: SparkSession, store: Store, batch: Batch) -> bool:
    """Whether the audit table has a successful run of this batch."""
    path = store.table("_runs")
    if not exists(spark, path):
        return False
    same = (F.col("stream") == batch.stream) & (F.col("batch") == batch.number) & (F.col("status") == "SUCCESS")
    return not read_runs(spark, path).filter(same).isEmpty()


def _stream(
    spark: SparkSession, store: Store, feed: Feed, job: str, checkpoint: str, run_ts: datetime | None,
    files_per_batch: int | None, publish: Callable[[Run, DataFrame, Scratch, Batch], None],
) -> int:
    """``publish`` per batch of new files, each batch a run of its own in the audit table.

    Only the first batch after a start may be one that was given before: if its run is recorded it is passed over,
    and if it failed behind a publish the tables know what they have of it."""
    started = False

    def apply(frame: DataFrame, number: int) -> None:
        nonlocal started
        batch = Batch(stream_id(spark, checkpoint), number)
        first, started = not started, True
        if first and _recorded(spark, store, batch):
            return
        with Run(spark, store.table("_runs"), job, stream=batch.stream, batch=number) as run, Scratch(spark) as scratch:
            run.started_at = run_ts or run.started_at
            publish(run, frame, scratch, batch)

    root = store.landed(feed.endpoint)
    return ingest_available(spark, root, feed.schema, checkpoint, apply, files_per_batch, feed.layout)


def stream_entity(
    spark: SparkSession, store: Store, feed: Feed, table: Table, checkpoint: str, lookup: Lookup | None = None,
    files_per_batch: int | None = None, run_ts: datetime | None = None,
) -> int:
    """The entity job per batch of new files: flatten, latest, enrich, gate, upsert, date by date."""

    def publish(run: Run, frame: DataFrame, scratch: Scratch, batch: Batch) -> None:
        publish_entity(run, store, feed, table, lookup, frame, scratch, False, batch)

    return _stream(spark, store, feed, table.name, checkpoint, run_ts, files_per_batch, publish)


def stream_split(
    spark: SparkSession, store: Store, feed: Feed, flag: str, without: Table, having: Table, checkpoint: str,
    lookup: Lookup | None = None, files_per_batch: int | None = None, run_ts: datetime | None = None,
) -> int:
    """The job of a mixed feed per batch of new files."""

    def publish(run: Run, frame: DataFrame, scratch: Scratch, batch: Batch) -> None:
        publish_split(run, store, feed, flag, without, having, lookup, frame, scratch, False, batch)

    return _stream(spark, store, feed, feed.endpoint, checkpoint, run_ts, files_per_batch, publish)

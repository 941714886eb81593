"""Landing raw envelopes as JSON lines, partitioned by run hour and, for pages, by entity.

The date comes first in the path, so that a run lists one date's folder and no other. The bare layout puts plain
entity folders first.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F

from silvermill.functions.columns import iso_text, time_parts
from silvermill.operators.paging import PAGE_SIZE, paginate
from silvermill.session import Scratch
from silvermill.storage import delete, glob, rename

TIME_PARTITIONS = ("yyyy", "mm", "dd", "hh")
# Lines of one file. A compressed file is read by one task, so files of a large landing stay small.
PAGE_LINES, SNAPSHOT_LINES = 10_000, 1_000_000
ENTITY = ("owner", "repo")


def page_envelopes(
    records: DataFrame,
    endpoint: str,
    scratch: Scratch,
    fetched_at: Column,
    page_size: int = PAGE_SIZE,
    state: str | None = None,
    since: Column | None = None,
    until: Column | None = None,
    base_url: str = "https://api.example.org/repos",
) -> DataFrame:
    """Envelopes of up to ``page_size`` records for rows with owner, repo and batch_ts."""
    pages = paginate(records, [*ENTITY, "batch_ts"], scratch, page_size)
    url = F.concat(
        F.concat_ws("/", F.lit(base_url), "owner", "repo", F.lit(endpoint)),
        F.lit(f"?per_page={page_size}&page="),
        F.col("page").cast("string"),
    )
    params = F.struct(
        F.lit(page_size).cast("long").alias("per_page"),
        F.col("page"),
        F.lit(state).cast("string").alias("state"),
        (F.lit(None).cast("string") if since is None else iso_text(since)).alias("since"),
        (F.lit(None).cast("string") if until is None else iso_text(until)).alias("until"),
    )
    return pages.select(
        *ENTITY,
        iso_text(fetched_at).alias("fetched_at"),
        F.lit(endpoint).alias("endpoint"),
        params.alias("params"),
        url.alias("url"),
        "count",
        "data",
        iso_text("batch_ts").alias("batch_timestamp"),
    )


def snapshot_envelopes(records: DataFrame, endpoint: str, fetched_at: Column) -> DataFrame:
    """One envelope per entity for rows with owner, repo, batch_ts; the other columns form data."""
    body = [c for c in records.columns if c not in (*ENTITY, "batch_ts")]
    return records.select(
        *ENTITY,
        iso_text(fetched_at).alias("fetched_at"),
        iso_text("batch_ts").alias("batch_timestamp"),
        F.lit(endpoint).alias("endpoint"),
        F.struct(*body).alias("data"),
    )


def land(
    envelopes: DataFrame, root: str, by_entity: bool = True, compression: str | None = "gzip", layout: str = "keyed"
) -> None:
    """Append envelopes under ``root``. Every run adds files, so bronze keeps repeated records.

    ``by_entity`` adds owner and repo folders; leave it off when entities are so many that a
    folder each would mean a file per row. ``layout="bare"`` lands ``owner/repo/yyyy=…`` with plain entity folders,
    snapshots too, as other readers of such a store expect. Files are compressed, as an envelope repeats the names of
    all its fields; Spark's readers go by the file's ending.
    """
    rows = envelopes.withColumns(time_parts(F.to_timestamp("batch_timestamp")))
    if layout == "bare":
        _land_bare(rows, root, compression, by_entity)
    elif layout == "keyed":
        partitions = (*TIME_PARTITIONS, *ENTITY) if by_entity else TIME_PARTITIONS
        _writer(rows, partitions, compression, by_entity).mode("append").json(root)
    else:
        raise ValueError(f"unknown layout {layout}")


def _writer(rows: DataFrame, partitions: Sequence[str], compression: str | None, pages: bool) -> DataFrameWriter:
    writer = rows.write.partitionBy(*partitions).option("maxRecordsPerFile", PAGE_LINES if pages else SNAPSHOT_LINES)
    return writer.option("compression", compression) if compression else writer


def _land_bare(rows: DataFrame, root: str, compression: str | None, pages: bool) -> None:
    """Tasks write below a folder of their own, with entity folders that Spark names by key; the driver then moves the
    files, one folder an entity and hour, to where the entity's name alone says. Envelopes keep owner and repo."""
    spark = rows.sparkSession
    work = f"{root}/_landing/{uuid.uuid4().hex}"
    keyed = rows.withColumns({f"_{name}": F.col(name) for name in ENTITY})
    partitions = (*(f"_{name}" for name in ENTITY), *TIME_PARTITIONS)
    # Rows of one entity and hour are gathered, or every task would write a file of its own for each.
    _writer(keyed.hint("rebalance", *partitions), partitions, compression, pages).json(work)
    for folder in glob(spark, "/".join([work, *["*=*"] * len(partitions)])):
        owner, repo, *time = folder.rsplit("/", len(partitions))[1:]
        target = "/".join([root, owner.split("=", 1)[1], repo.split("=", 1)[1], *time])
        for file in glob(spark, f"{folder}/part-*"):
            rename(spark, file, f"{target}/{file.rsplit('/', 1)[1]}")
    delete(spark, work)


def landed_totals(envelopes: DataFrame, entity: Sequence[str] = ENTITY) -> DataFrame:
    """Pages and items per entity, from the envelopes alone."""
    return envelopes.groupBy(*entity).agg(F.count("*").alias("pages"), F.sum("count").alias("items"))

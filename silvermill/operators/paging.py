"""Pages of records: how many an entity needs, and which record goes on which page."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silvermill.session import Scratch

PAGE_SIZE = 100
PAGES_PER_BLOCK = 250


def count_pages(df: DataFrame, entity: Sequence[str], page_size: int = PAGE_SIZE) -> DataFrame:
    """Items and full-page count per entity."""
    totals = df.groupBy(*entity).agg(F.count("*").alias("items"))
    return totals.withColumn("pages", F.expr(f"(items + {page_size - 1}) div {page_size}"))


def plan_pages(
    totals: DataFrame, entity: Sequence[str], block: int = PAGES_PER_BLOCK, tasks: int | None = None
) -> DataFrame:
    """One row per page number 1..pages; none where pages is 0 or null.

    Two steps, so that an entity with billions of pages is listed by many tasks: its blocks first,
    then, after a shuffle (to ``tasks`` partitions if given), the pages of each block.
    """
    blocks = totals.filter("pages > 0").select(
        *entity, "pages", F.explode(F.expr(f"sequence(0L, (pages - 1) div {block})")).alias("block")
    )
    spread = [tasks, *entity, "block"] if tasks else [*entity, "block"]
    return blocks.repartition(*spread).select(
        *entity,
        "block",
        F.explode(
            F.expr(f"sequence(block * {block} + 1, least((block + 1) * {block}, pages))")
        ).alias("page"),
    )


def paginate(
    df: DataFrame,
    entity: Sequence[str],
    scratch: Scratch,
    page_size: int = PAGE_SIZE,
    block: int = PAGES_PER_BLOCK,
) -> DataFrame:
    """Pack each entity's records into pages ``(entity…, page, count, data array<struct>)``.

    All pages of an entity are full but the last. Records are numbered without gathering an
    entity anywhere: every input task sorts its rows by entity and stages them with their
    position; the runs this gives (task x entity) are counted, and a running sum over the small
    table of runs turns positions into numbers. That table is staged, so that its exact size decides
    whether it is broadcast and the rows stay where they are. Then they are shuffled once, by block of
    pages, so a task holds whole blocks and a hot entity is spread over all tasks.
    """
    entity = list(entity)
    records = [c for c in df.columns if c not in entity]
    positioned = scratch.stage(
        df.sortWithinPartitions(*entity).withColumn("_position", F.monotonically_increasing_id()),
        "positions",
    ).withColumn("_run", F.expr("shiftright(_position, 33)"))

    runs = positioned.groupBy(*entity, "_run").agg(
        F.count("*").alias("_size"), F.min("_position").alias("_first")
    )
    earlier = Window.partitionBy(*entity).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        *[F.col(c).alias(f"_of_{c}") for c in entity],
        F.col("_run").alias("_of_run"),
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same_run = F.col("_run") == F.col("_of_run")
    for c in entity:
        same_run = same_run & F.col(c).eqNullSafe(F.col(f"_of_{c}"))

    numbered = positioned.join(scratch.stage(starts, "runs"), same_run).withColumn("_number", F.expr("_position + _shift"))
    return (
        numbered.select(*entity, *records, "_number", F.expr(f"_number div {page_size * block}").alias("_block"))
        .repartition(*entity, "_block")
        .withColumn("page", F.expr(f"_number div {page_size} + 1"))
        .groupBy(*entity, "_block", "page")
        .agg(F.sort_array(F.collect_list(F.struct("_number", F.struct(*records).alias("record")))).alias("_items"))
        .select(*entity, "page", F.size("_items").cast("long").alias("count"), F.col("_items.record").alias("data"))
    )

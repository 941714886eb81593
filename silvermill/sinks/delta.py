"""The same publishes on Delta tables, for sessions that have its classes and catalog settings.

These are not installed where this package is tested, so nothing here but the check for them has ever run.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    from delta.tables import DeltaTable
except ImportError:
    DeltaTable = None


def _available():
    if DeltaTable is None:
        raise RuntimeError("format delta needs the delta-spark package; use parquet without it")
    return DeltaTable


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("delta").load(path)


def replace_where(
    df: DataFrame, path: str, day: date | str, scope: Column | None = None, partition: str = "snapshot_date"
) -> None:
    """Replace a date, or inside it the rows ``scope`` selects, in one commit."""
    spark, table = df.sparkSession, _available()
    this_day = F.col(partition) == F.lit(str(day)).cast("date")
    if not table.isDeltaTable(spark, path):
        df.write.format("delta").partitionBy(partition).save(path)
    else:
        df.writeTo(f"delta.`{path}`").overwrite(this_day if scope is None else this_day & scope)


def upsert(
    df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), newer_by: str | None = None
) -> None:
    """Update matched rows, insert the others. With ``newer_by`` a matched row is updated only by one that is
    not lower in that column, nulls lowest."""
    if not keys:
        raise ValueError("an upsert needs at least one key")
    spark, table = df.sparkSession, _available()
    if not table.isDeltaTable(spark, path):
        df.write.format("delta").partitionBy(*partition_by).save(path)
        return
    same = functools.reduce(Column.__and__, [F.col(f"target.{key}") == F.col(f"source.{key}") for key in keys])
    newer = None
    if newer_by is not None:
        old, new = F.col(f"target.{newer_by}"), F.col(f"source.{newer_by}")
        newer = old.isNull() | F.coalesce(new >= old, F.lit(False))
    merging = table.forPath(spark, path).alias("target").merge(df.alias("source"), same)
    merging.whenMatchedUpdateAll(newer).whenNotMatchedInsertAll().execute()

"""From nested envelopes to flat, typed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.functions.columns import run_stamp, snapshot_date


# Whether an expression may use the record. Where it only looks so, in a text or as a field's name, it is computed
# for every record instead of once for the page.
_USES_RECORD = re.compile(r"(?i)\brecord\b")


def flatten_pages(envelopes: DataFrame, fields: Sequence[str], data: str = "data") -> DataFrame:
    """One row per record of the page's array; a null or empty array gives no row.

    ``fields`` are select expressions over the envelope's columns and ``record``. Those that the
    envelope alone answers are computed once per page, before the array is exploded, under private
    names: an output name that is also an envelope column does not hide it from the others.
    """
    if "record" in (c.lower() for c in envelopes.columns):
        raise ValueError("an envelope column named record would hide the page's records")
    names = envelopes.withColumn("record", F.element_at(data, 1)).selectExpr(*fields).columns
    of_page = {i: f"_page_{i}" for i, field in enumerate(fields) if not _USES_RECORD.search(field)}
    pages = envelopes.select(
        *[F.col(f"`{c}`") for c in envelopes.columns if c != data],
        F.col(data).alias("_data"),
        *[F.expr(fields[i]).alias(private) for i, private in of_page.items()],
    )
    return pages.withColumn("record", F.explode("_data")).select(
        *[F.col(of_page[i]).alias(names[i]) if i in of_page else F.expr(f) for i, f in enumerate(fields)]
    )


def flatten_snapshots(envelopes: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per envelope; the leaves of a null parent are null."""
    return envelopes.selectExpr(*fields)


def stamp(df: DataFrame, run_ts: datetime, batch_column: str = "bronze_batch_timestamp") -> DataFrame:
    """Add the run's instant and the snapshot day of the batch."""
    return df.withColumns(
        {"silver_ingested_at": run_stamp(run_ts), "snapshot_date": snapshot_date(batch_column)}
    )


def split_by(df: DataFrame, flag: str) -> tuple[DataFrame, DataFrame]:
    """(rows without the flag, rows with it). The flag must not be null, so no row is lost."""
    return df.filter(~F.col(flag)), df.filter(flag)

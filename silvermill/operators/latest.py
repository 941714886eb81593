"""Latest row per key, and the latest version of a lookup table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_by(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key: the one that is highest in ``order``, nulls lowest.

    Rows equal in ``order`` are decided by ``ties``, or without it by a hash of the whole row, so
    that a recomputed task picks the same row. Catalyst turns the filter into a group limit that
    runs before the shuffle as well: a hot key sends one row per input task.
    """
    if ties is None:
        ties = [row_hash(df)]
    newest_first = [F.col(c).desc_nulls_last() for c in order]
    newest_first += [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in ties]
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def row_hash(df: DataFrame) -> Column:
    """Hash of all columns; maps and variants, which have no hash, by their JSON text."""
    return F.xxhash64(
        *[
            F.to_json(F.struct(f.name)) if re.search("map<|variant", f.dataType.simpleString()) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def latest_lookup(
    table: DataFrame, key: Sequence[str], values: Sequence[str], version: Sequence[str]
) -> DataFrame:
    """The values of the newest version of each key, from only the columns that are needed."""
    narrow = table.select(*dict.fromkeys([*key, *values, *version]))
    return latest_by(narrow, key, version).select(*dict.fromkeys([*key, *values]))

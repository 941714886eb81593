"""Left-outer enrichment from a lookup with one row per key."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def enrich_left(
    df: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    values: Sequence[str],
    normalize: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """All columns and rows of ``df``, then the lookup's values, null where no key matches.

    No broadcast is forced, as the lookup may grow with the data; pass it as a stored table
    (``Scratch.stage``). Then its exact size decides: under ``spark.sql.autoBroadcastJoinThreshold``
    it is broadcast and ``df`` is not shuffled, beyond that both sides are shuffled plainly, which
    lets AQE split the rows of a hot key over several tasks (it cannot where a window or an
    aggregate sits between shuffle and join). ``normalize`` is applied to both sides' key, for
    names that differ only in form; the lookup must stay unique under it.
    """
    if not on:
        raise ValueError("an enrichment needs at least one key")
    shape = normalize or (lambda column: column)
    right = lookup.select(*[F.col(k).alias(f"_key_{k}") for k in on], *[F.col(v).alias(f"_value_{v}") for v in values])
    condition = functools.reduce(Column.__and__, [shape(F.col(k)) == shape(F.col(f"_key_{k}")) for k in on])
    return df.join(right, condition, "left").select(
        *df.columns, *[F.col(f"_value_{v}").alias(v) for v in values]
    )


def miss_count(column: str) -> Column:
    """Aggregate: rows for which the lookup had no value."""
    return F.count_if(F.col(column).isNull())

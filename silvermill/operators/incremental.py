"""Time windows, state filters and high-water marks of incremental loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.functions.columns import instant


def in_window(df: DataFrame, ts: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """Half-open ``[since, until)``, so that windows that touch neither lose nor repeat a row."""
    if since is not None:
        df = df.filter(F.col(ts) >= instant(since))
    if until is not None:
        df = df.filter(F.col(ts) < instant(until))
    return df


def in_states(df: DataFrame, column: str, states: Sequence[str] | None = None) -> DataFrame:
    """All rows by default; with ``states`` only those."""
    return df if states is None else df.filter(F.col(column).isin(list(states)))


def marks_of(df: DataFrame, entity: Sequence[str], ts: str, mark: str = "last_run") -> DataFrame:
    """The newest instant per entity."""
    return df.groupBy(*entity).agg(F.max(ts).alias(mark))


def after_marks(
    df: DataFrame, marks: DataFrame, entity: Sequence[str], ts: str, mark: str = "last_run", inclusive: bool = False
) -> DataFrame:
    """Rows newer than their entity's mark; an entity without a mark is loaded in full.

    ``inclusive`` also takes rows at the mark: for marks that are the open end of a window rather
    than the newest instant seen. As with any lookup, pass ``marks`` as a stored table if they
    may be many.
    """
    low = marks.select(*entity, F.col(mark).alias("_low"))
    joined = df.join(low, list(entity), "left")
    newer = F.col(ts) >= F.col("_low") if inclusive else F.col(ts) > F.col("_low")
    return joined.filter(F.col("_low").isNull() | newer).select(*df.columns)

"""Column expressions shared by the scans, projections and sinks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def parse_ts(text: Column | str, strict: bool = True) -> Column:
    """Text to timestamp. Malformed text raises when strict and becomes null otherwise."""
    return F.to_timestamp(text) if strict else F.try_to_timestamp(text)


def iso_text(ts: Column | str) -> Column:
    """Timestamp to ISO-8601 text, to the microsecond (the JSON writer alone keeps milliseconds)."""
    return F.date_format(ts, ISO_FORMAT)


def snapshot_date(ts: Column | str) -> Column:
    """The calendar day in the session time zone."""
    return F.to_date(ts)


def instant(at: datetime) -> Column:
    """A literal that does not depend on the driver's own time zone: a naive datetime is wall
    time in the session's zone."""
    if at.tzinfo is not None:
        return F.lit(at)
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def run_stamp(run_ts: datetime) -> Column:
    """One driver-side instant for all rows of a run."""
    return instant(run_ts).cast("timestamp")


def time_parts(ts: Column | str) -> dict[str, Column]:
    """The zero-padded landing partitions of a run timestamp."""
    return {
        "yyyy": F.date_format(ts, "yyyy"),
        "mm": F.date_format(ts, "MM"),
        "dd": F.date_format(ts, "dd"),
        "hh": F.date_format(ts, "HH"),
    }


def entity_name(*parts: Column | str) -> Column:
    """``owner/repo``. Null parts are skipped, so the result is never null but may be blank."""
    return F.concat_ws("/", *parts)


def url_param(url: Column | str, name: str, default: str | None = None) -> Column:
    """One query parameter of a URL; absent, blank and unreadable ones give the default."""
    value = F.nullif(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)), F.lit(""))
    return value if default is None else F.coalesce(value, F.lit(default))


def json_map(text: Column | str) -> Column:
    """JSON object text to a string map; values that are not strings keep their JSON text."""
    return F.from_json(text, "map<string,string>")


def all_present(columns: list[str] | tuple[str, ...]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition

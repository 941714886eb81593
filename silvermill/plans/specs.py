"""What a job works on: the feed it reads, the table it publishes, the lookup it joins."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from silvermill.sinks.upsert import BUCKET_BYTES, BUCKETS


@dataclass(frozen=True)
class Store:
    """Root folders of the two layers, and the format of the silver tables: parquet, or delta
    where its classes are installed."""

    bronze: str
    silver: str
    format: str = "parquet"

    def landed(self, endpoint: str) -> str:
        return f"{self.bronze}/{endpoint}"

    def table(self, name: str) -> str:
        return f"{self.silver}/{name}"


@dataclass(frozen=True)
class Feed:
    """Envelopes of one endpoint. ``fields`` are select expressions over the envelope's columns,
    with ``record`` for the exploded element of page feeds. ``damaged`` says what unreadable and
    miscounted pages do to a job, ``misfits`` what pages with values that their fields' types cannot hold do, which
    are null then: error or warn."""

    endpoint: str
    schema: str
    fields: tuple[str, ...]
    layout: str = "keyed"
    damaged: str = "error"
    misfits: str = "error"


@dataclass(frozen=True)
class Table:
    """A silver table: how its rows are made unique, checked and published. An upserted one needs
    ``publish_keys``; without ``partition_by`` it starts with ``buckets``, and buckets above ``bucket_bytes`` are split.
    A snapshot table with ``current_by`` keeps the newest version per that key in a table beside it; of two rows
    of one day the one higher in ``current_order``, or without that in ``order``, is newer."""

    name: str
    dedupe_keys: tuple[str, ...]
    publish_keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ("bronze_ingested_at",)
    required: tuple[str, ...] = ()
    not_blank: tuple[str, ...] = ()
    not_negative: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    newer_by: str | None = None
    buckets: int = BUCKETS
    bucket_bytes: int = BUCKET_BYTES
    current_by: tuple[str, ...] = ()
    current_order: tuple[str, ...] = ()


@dataclass(frozen=True)
class Lookup:
    """A published table whose newest version per key adds ``values``."""

    table: str
    key: tuple[str, ...]
    values: tuple[str, ...]
    version: tuple[str, ...] = ("snapshot_date",)
    normalize: Callable[[Column], Column] | None = None

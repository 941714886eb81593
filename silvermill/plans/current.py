"""The newest version per key of a snapshot table, in a table beside its history, so that lookups need not read all dates.

It follows every replaced date, also when versions disappear: a key whose current version lay in what was
replaced and is not there any more gets its newest one from the earlier dates, or goes if there is none. While history
and current table are not in step a marker lies beside the latter; a marker that a run left behind, and a
history without a current table, make the next run build it from all dates.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.functions.columns import all_present
from silvermill.operators.keyfilter import join_side
from silvermill.operators.latest import latest_by
from silvermill.plans.specs import Store, Table
from silvermill.session import Scratch
from silvermill.sinks.replace import read_dates
from silvermill.sinks.upsert import SilverTable, read_table, upsert
from silvermill.storage import create_text, delete, glob

VERSION = "snapshot_date"


def current_path(store: Store, name: str) -> str:
    return store.table(f"{name}_current")


def _markers(spark: SparkSession, path: str) -> list[str]:
    return glob(spark, f"{path}/_behind/*")


def read_current(spark: SparkSession, store: Store, name: str) -> DataFrame | None:
    """The current versions; None where there is no table of them or it may be behind its history."""
    path = current_path(store, name)
    if _markers(spark, path) or SilverTable(spark, path).state() is None:
        return None
    return read_table(spark, path)


def newest_versions(rows: DataFrame, table: Table) -> DataFrame:
    """The newest version of each key; rows with a null in their key are no versions of anything."""
    order = table.current_order or table.order
    return latest_by(rows.filter(all_present(table.current_by)), table.current_by, [VERSION, *order])


class Follower:
    """Keeps the current versions of ``table`` in step with one replaced date, or one entity in it.

    A context manager around the publish of the history: entered before it, and left after it with ``follow``
    called in between. A run that dies leaves its marker."""

    def __init__(self, spark: SparkSession, store: Store, table: Table):
        self.spark, self.table = spark, table
        self.history = store.table(table.name)
        self.path = current_path(store, table.name)
        self.found: list[str] = []

    def __enter__(self) -> Follower:
        self.found = _markers(self.spark, self.path)
        self.marker = f"{self.path}/_behind/{uuid.uuid4().hex}"
        create_text(self.spark, self.marker, "")
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            for marker in [*self.found, self.marker]:
                delete(self.spark, marker)

    def follow(self, rows: DataFrame, day: date | str, scope: Column | None) -> None:
        """``rows`` have become those of ``day``, or of the part of it that ``scope`` selects."""
        keys = list(self.table.current_by)
        history = read_dates(self.spark, self.history, rows.schema)
        known = SilverTable(self.spark, self.path).state() is not None
        if self.found or not known:
            before = read_table(self.spark, self.path).select(*keys) if known else None
            upsert(newest_versions(history, self.table), self.path, keys, retract=before)
            return
        with Scratch(self.spark) as scratch:
            self._follow(rows, day, scope, history, scratch)

    def _follow(self, rows: DataFrame, day: date | str, scope: Column | None, history: DataFrame, scratch: Scratch) -> None:
        keys = list(self.table.current_by)
        this_day = F.col(VERSION) == F.lit(str(day)).cast("date")
        replaced = this_day if scope is None else this_day & F.coalesce(scope, F.lit(False))
        current = read_table(self.spark, self.path)
        was_current = current.filter(replaced).select(*keys)
        if scope is None:
            of_day = newest_versions(rows, self.table)
        else:
            # Another entity may have a version of the same key on that day.
            touched = scratch.stage(rows.select(*keys).unionByName(was_current).distinct(), "touched")
            of_touched = history.filter(this_day).join(join_side(touched, touched.count()), keys, "left_semi")
            of_day = newest_versions(of_touched.select(*rows.columns), self.table)
        # The newest versions already lie by key, and may be as many as the day has rows: never broadcast. Staged, as
        # what is gone is read by several jobs.
        gone = was_current.join(of_day.select(*keys).hint("shuffle_merge"), keys, "left_anti")
        gone = scratch.stage(gone, "gone")
        n = gone.count()
        if n == 0:
            upsert(of_day, self.path, keys, newer_by=VERSION)
            return
        earlier = history.filter(F.col(VERSION) < F.lit(str(day)).cast("date")).join(join_side(gone, n), keys, "left_semi")
        versions = of_day.unionByName(newest_versions(earlier.select(*rows.columns), self.table))
        upsert(versions, self.path, keys, newer_by=VERSION, retract=gone)

"""Idempotent publish by replacing a date of a partitioned table, or one entity inside that date.

The new rows of a date are written beside the old ones, into a folder that plain readers of the table pass
over. One small file, the date's pointer, then names that folder: creating it is the switch. After that the
folder takes the place of the old one, so that the table stays plain partitioned Parquet. A driver that dies
before the switch leaves the old date as it was. One that dies after it leaves a switch that every later
reader through ``read_dates`` sees as done, and that the next writer finishes. Pointers are numbered: of two
writers that replace the same date at the same time the second one fails.

Replacing one entity of a date writes only the files again that hold rows of it: the pointer then names those
that go, and the new files move in between the others.
"""

from __future__ import annotations

import json
import uuid
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.storage import create_text, delete, exists, glob, read_text, rename

NEXT, POINTERS = "_next", "_switch"


class Dates:
    """The dates of a table at ``path``, and the switches that are under way."""

    def __init__(self, spark: SparkSession, path: str, partition: str = "snapshot_date"):
        self.spark = spark
        self.path = path
        self.partition = partition

    def _pointers(self, name: str) -> list[str]:
        return glob(self.spark, f"{self.path}/{POINTERS}/{name}/*.json")

    def pointer(self, name: str) -> tuple[int, dict | None]:
        """Number and content of a date's newest pointer; a file that is still being written does not count."""
        for path in reversed(self._pointers(name)):
            try:
                return int(path.rsplit("/", 1)[1].split(".")[0]), json.loads(read_text(self.spark, path))
            except ValueError:
                continue
        return 0, None

    def under_way(self) -> dict[str, dict]:
        """Folder name of each date that is switched but not yet in its place, and its pointer. What is being written
        but not switched to has no pointer and does not count."""
        names = {path.rsplit("/", 1)[1] for path in glob(self.spark, f"{self.path}/{NEXT}/*/{self.partition}=*")}
        found = {}
        for name in sorted(names):
            _, pointer = self.pointer(name)
            if pointer and exists(self.spark, f"{self.path}/{NEXT}/{pointer['id']}/{name}"):
                found[name] = pointer
        return found

    def files(self, name: str, pointer: dict | None = None) -> list[str]:
        """Files of a date in their place, without those that ``pointer`` says will go."""
        gone = set((pointer or {}).get("gone", ()))
        return [f for f in glob(self.spark, f"{self.path}/{name}/[!_.]*") if f.rsplit("/", 1)[1] not in gone]

    def switch(self, name: str, new: str, seen: int, gone: list[str] | None = None) -> None:
        """Make the folder ``new`` the date, or with ``gone`` put its files in place of these, provided that its pointer is
        still the one seen before its rows were read."""
        path = f"{self.path}/{POINTERS}/{name}/{seen + 1:08d}.json"
        had = exists(self.spark, f"{self.path}/{name}")
        create_text(self.spark, path, json.dumps({"id": new, "had": had} | ({} if gone is None else {"gone": gone})))
        self.finish(name)
        for old in self._pointers(name)[:-1]:
            delete(self.spark, old)

    def finish(self, name: str) -> None:
        """Put a switched folder in its place. Every step may be repeated."""
        _, pointer = self.pointer(name)
        if pointer is None:
            return
        work = f"{self.path}/{NEXT}/{pointer['id']}"
        place = f"{self.path}/{name}"
        if "gone" in pointer:
            for file in glob(self.spark, f"{work}/{name}/[!_.]*"):
                rename(self.spark, file, f"{place}/{file.rsplit('/', 1)[1]}")
            for file in pointer["gone"]:
                delete(self.spark, f"{place}/{file}")
        elif exists(self.spark, f"{work}/{name}"):
            if exists(self.spark, place):
                if pointer["had"] and not exists(self.spark, f"{work}/_old"):
                    rename(self.spark, place, f"{work}/_old")
                else:  # what an earlier attempt has moved in part
                    delete(self.spark, place)
            rename(self.spark, f"{work}/{name}", place)
        delete(self.spark, work)

    def recover(self) -> None:
        for name in self.under_way():
            self.finish(name)


def read_dates(spark: SparkSession, path: str, schema: T.StructType | None = None, partition: str = "snapshot_date") -> DataFrame:
    """A table of dates as its newest switches have it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    pending = Dates(spark, path, partition).under_way()
    if not pending:
        return reader.parquet(path)
    settled = [p for p in glob(spark, f"{path}/{partition}=*") if p.rsplit("/", 1)[1] not in pending]
    parts = []
    for name, pointer in pending.items():
        work = f"{path}/{NEXT}/{pointer['id']}"
        if "gone" in pointer:
            settled += Dates(spark, path, partition).files(name, pointer)
        if glob(spark, f"{work}/{name}/[!_.]*"):
            parts.append(reader.option("basePath", work).parquet(f"{work}/{name}"))
    if settled:
        parts.insert(0, reader.option("basePath", path).parquet(*settled))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*whole.columns))
    return whole


def replace_where(
    df: DataFrame,
    path: str,
    day: date | str,
    scope: Column | None = None,
    partition: str = "snapshot_date",
    allow_empty: bool = False,
) -> None:
    """Replace the rows of ``day`` (and, with ``scope``, only those it selects) by ``df``.

    No other date is touched. Every new row must lie inside what it replaces: the write itself fails on the first that
    does not. ``df`` must not be empty unless allowed; when allowed, the emptied partition is removed.
    """
    spark = df.sparkSession
    this_day = F.col(partition) == F.lit(str(day)).cast("date")
    inside = F.coalesce(this_day if scope is None else this_day & scope, F.lit(False))
    offence = F.concat(F.lit(f"row outside the replaced scope of {day}: "), F.to_json(F.struct(*df.columns)))
    rows = df.withColumn(partition, F.when(inside, F.col(partition)).otherwise(F.raise_error(offence)))

    dates = Dates(spark, path, partition)
    dates.recover()
    name = f"{partition}={day}"
    folder = f"{path}/{name}"
    seen, _ = dates.pointer(name)
    gone: list[str] | None = None
    if scope is not None and exists(spark, folder):
        selected = F.coalesce(scope, F.lit(False))
        current = spark.read.schema(df.schema).option("basePath", path).parquet(folder)
        file = F.element_at(F.split(current.metadataColumn("_metadata").getField("file_path"), "/"), -1)
        # A name per file that holds rows of the scope, of one date's files.
        gone = [unquote(row[0]) for row in current.filter(selected).select(file).distinct().collect()]
        if gone:
            touched = spark.read.schema(df.schema).option("basePath", path).parquet(*(f"{folder}/{f}" for f in gone))
            rows = rows.unionByName(touched.select(*df.columns).filter(~selected))

    written = Observation()
    new = uuid.uuid4().hex
    work = f"{path}/{NEXT}/{new}"
    try:
        # All rows go to one partition, so no shuffle is needed to keep files few.
        rows.observe(written, F.count("*").alias("rows")).write.partitionBy(partition).parquet(work)
    except Exception:
        delete(spark, work)
        raise
    if written.get["rows"] == 0:
        delete(spark, work)
        if not allow_empty:
            raise ValueError(f"nothing to publish for {day} at {path}")
        for old in dates.files(name) if gone is None else [f"{folder}/{f}" for f in gone]:
            delete(spark, old)
        if not dates.files(name):
            delete(spark, folder)
        return
    try:
        dates.switch(name, new, seen, gone)
    except FileExistsError:
        delete(spark, work)
        raise

"""Keyed upsert into plain Parquet, and the table form it publishes.

A table is a set of folders. New rows are first written as a draft: a folder inside the table
that no reader sees yet. The quality gate reads the draft, and publishing it writes one small
state file that names the folders which make up the table from now on; readers follow the newest
state. A job that dies leaves the table as it was, and a reader never sees half an upsert.

Rows lie in hash buckets of their key, in a table with partition columns in each partition's own, so
a folder holds the rows of one partition and bucket. A bucket that has grown past the target size is split by the next
bits of the hash (``buckets``), so that what a small batch rewrites does not grow with the table. The state file
names each folder's bucket and the buckets of each partition.

Without partition columns the buckets of a batch are known from the draft's folder names: only those of the table are
read, and each is replaced by one folder. With partition columns a key may stand in any partition: the batch's
hashes say which buckets of each may hold it, a bitmap of its keys thins out what is read from those, and only
folders that hold a matched key are rewritten; new rows get folders of their own until a bucket has many.
Folders that a state no longer names are deleted by a later publish, once they have been out of use for the
retention period.

Tables of a fixed number of buckets, and without buckets in their partitions, as earlier versions wrote them,
are read and go on as they are: their buckets are codes too, and split when they are next rewritten.
"""

from __future__ import annotations

import functools
import json
import statistics
import uuid
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.functions.columns import all_present
from silvermill.operators.keyfilter import join_side, may_match
from silvermill.operators.latest import latest_by
from silvermill.sinks.buckets import MAX_DEPTH, ROOT, Directory, bits_to_split, depth, key_hash, low_bits_of
from silvermill.sinks.replace import read_dates
from silvermill.storage import create_text, delete, exists, glob, read_text, size

BUCKETS = 16  # of a new table without partition columns
BUCKET_BYTES = 256 << 20  # a bucket above this is split
CROWD = 8  # folders of one partition and bucket, beyond which they become one
RETENTION = timedelta(days=1)
_BUCKET = "_bucket"
_NULL = "__HIVE_DEFAULT_PARTITION__"


class DuplicateKeys(ValueError):
    """The source holds more than one row for a merge key."""


class SilverTable:
    """A published table at ``path``: the folders its newest state file names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def _states(self) -> list[str]:
        return glob(self.spark, f"{self.path}/_state/*.json")

    def state(self) -> dict | None:
        """The newest state; one that is still being written does not count yet."""
        for path in reversed(self._states()):
            try:
                return json.loads(read_text(self.spark, path))
            except ValueError:
                continue
        return None

    def read_folders(self, folders: Sequence[str], schema: T.StructType) -> DataFrame:
        """Rows of ``folders``. Those with and without a bucket in their path are read apart, as one scan takes paths of
        one form only."""
        if not folders:
            return self.spark.createDataFrame([], schema)
        forms = defaultdict(list)
        for folder in folders:
            forms[tuple(name for name, _ in _parts(folder))].append(f"{self.path}/{folder}")
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return functools.reduce(DataFrame.unionByName, [reader.parquet(*paths) for paths in forms.values()])

    def write_folder(self, rows: DataFrame, partition_by: Sequence[str]) -> list[str]:
        """Write rows to a folder of their own; returns its partition folders, or just itself."""
        folder = f"_v={uuid.uuid4().int >> 66}"
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(f"{self.path}/{folder}")
        leaves = glob(self.spark, "/".join([self.path, folder, *["*=*"] * len(partition_by)]))
        return [leaf[leaf.index("_v=") :] for leaf in leaves]

    def publish(
        self, draft: Draft, folders: Mapping[str, int], directories: Mapping[str, Directory], retention: timedelta,
        marks: Mapping[str, object] | None = None,
    ) -> None:
        """Make ``folders``, each with the code of its bucket, the table, and delete what has been out of use for
        ``retention``. ``marks`` are kept in the state until a later publish replaces them by name."""
        now = datetime.now(timezone.utc)
        before = draft.state or {"version": 0, "folders": [], "retired": []}
        retired = dict.fromkeys({*before["folders"]} - {*folders}, now.isoformat()) | dict(before["retired"])
        due = [f for f, since in retired.items() if now - datetime.fromisoformat(since) >= retention]
        files = {int(path.rsplit("/", 1)[1].split(".")[0]): path for path in self._states()}
        later = [n for n in files if n > before["version"]]
        current = self.state()
        if current is not None and current["version"] > before["version"]:
            raise FileExistsError(f"{self.path} was published by another job; rerun on the new state.")
        version = max([before["version"], *later]) + 1  # past a file that a dying writer left unreadable
        state = {
            "version": version,
            "schema": json.loads(draft.schema.json()),
            "partition_by": list(draft.partition_by),
            "bucket_by": list(draft.bucket_by),
            "folders": list(folders),
            "codes": list(folders.values()),
            "buckets": {place: directories[place].codes for place in sorted({"", *map(_place, folders)} & {*directories})},
            "retired": sorted((f, since) for f, since in retired.items() if f not in due),
            "marks": {**before.get("marks", {}), **(marks or {})},
        }
        create_text(self.spark, f"{self.path}/_state/{version:08d}.json", json.dumps(state))
        unseen = {*draft.folders} - {*folders}  # written again by the merge; no reader knows them
        for folder in [*due, *unseen]:
            delete(self.spark, f"{self.path}/{folder}")
        for number, path in files.items():
            if number < before["version"]:
                delete(self.spark, path)


@dataclass
class Draft:
    """Rows written into a table's folder but not part of the table yet."""

    table: SilverTable
    state: dict | None
    schema: T.StructType
    partition_by: tuple[str, ...]
    bucket_by: tuple[str, ...]
    directories: dict[str, Directory]  # by partition, as their folders' paths name it
    initial: Directory  # of a partition that has none yet
    bucket_bytes: int
    folders: list[str] = field(default_factory=list)
    rest: list[str] = field(default_factory=list)  # rows written again by the merge

    @property
    def stored(self) -> T.StructType:
        """The schema of the folders: the table's, and the bucket."""
        return _with_bucket(self.schema)

    @property
    def layout(self) -> tuple[str, ...]:
        return (_BUCKET, *self.partition_by)

    def directory(self, place: str) -> Directory:
        return self.directories.get(place, self.initial)

    def read(self, folders: Sequence[str]) -> DataFrame:
        return self.table.read_folders(folders, self.stored)

    @property
    def rows(self) -> DataFrame:
        return self.read(self.folders).select(*self.schema.fieldNames())

    def discard(self) -> None:
        """Delete what was written, unless it has been published: a publish may fail behind its state file."""
        published = {f.split("/")[0] for f in (self.table.state() or {"folders": []})["folders"]}
        for folder in {f.split("/")[0] for f in self.folders + self.rest} - published:
            delete(self.table.spark, f"{self.table.path}/{folder}")


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])


def _parts(folder: str) -> list[tuple[str, str]]:
    return [tuple(part.split("=", 1)) for part in folder.split("/")]


def _place(folder: str) -> str:
    """The partition a folder belongs to: its path without version and bucket."""
    return "/".join(f"{name}={value}" for name, value in _parts(folder) if name not in ("_v", _BUCKET))


def _code_in(folder: str) -> int:
    """The bucket in the path of a folder written by this version."""
    return int(dict(_parts(folder))[_BUCKET])


def _codes(state: dict | None) -> dict[str, int]:
    """The table's folders and the codes of their buckets."""
    if state is None:
        return {}
    if "codes" in state:
        return dict(zip(state["folders"], state["codes"]))
    # Written with a fixed number of buckets: a power of two of them is one level of the directory, any other
    # number cuts across it, and all such folders belong to the one bucket of all rows.
    fixed = state["buckets"] if state["bucket_by"] else 0
    level = fixed if fixed and fixed & (fixed - 1) == 0 else 0
    return {f: level + int(dict(_parts(f))[_BUCKET]) if level else ROOT for f in state["folders"]}


def _directories(state: dict | None) -> dict[str, Directory]:
    if state is None:
        return {}
    if "codes" in state:
        return {place: Directory(tuple(codes)) for place, codes in state["buckets"].items()}
    fixed = state["buckets"] if state["bucket_by"] else 0
    if not fixed:
        return {}
    return {"": Directory.at_least(fixed) if fixed & (fixed - 1) == 0 else Directory()}


def _in_bucket(df: DataFrame, draft: Draft, directories: Mapping[str, Directory]) -> DataFrame:
    """``df`` with the code of each row's bucket in its partition."""
    hashed = key_hash(df, draft.bucket_by)
    if not draft.partition_by:
        return df.withColumn(_BUCKET, directories.get("", draft.initial).code(hashed))
    split = {place: d for place, d in directories.items() if d.codes != draft.initial.codes}
    if not split:
        return df.withColumn(_BUCKET, draft.initial.code(hashed))
    # As many numbers as there are buckets, which the driver lists anyway.
    names = [f"_in_{c}" for c in draft.partition_by]
    known = df.sparkSession.createDataFrame(
        [(*_values(place), d.depth, d.places()) for place, d in split.items()],
        ", ".join([*(f"`{n}` string" for n in names), "_depth int", "_places array<int>"]),
    )
    values = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")) for c in draft.partition_by]
    same = functools.reduce(Column.__and__, [v.eqNullSafe(F.col(f"`{n}`")) for v, n in zip(values, names)])
    low = F.col("_hash").bitwiseAND(F.expr("shiftleft(1L, _depth) - 1"))
    found = F.element_at("_places", low.cast("int") + 1)
    rows = df.withColumn("_hash", hashed).join(F.broadcast(known), same, "left")
    code = F.coalesce(found, draft.initial.code(F.col("_hash")))
    return rows.select(*[f"`{c}`" for c in df.columns], code.alias(_BUCKET))


def _values(place: str) -> tuple[str | None, ...]:
    """``day=2026-04-06/part=x`` to its values, as Spark reads them."""
    values = (unquote(value) for _, value in _parts(place))
    return tuple(None if v == _NULL else v for v in values)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its types. A value that its type cannot hold fails the job."""

    def cast(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`")
        if df.schema[f.name].dataType == f.dataType:
            return column
        tried = column.try_cast(f.dataType)
        lost = column.isNotNull() & tried.isNull()
        problem = F.concat(F.lit(f"{f.name} cannot be kept as {f.dataType.simpleString()}: "), column.cast("string"))
        return F.when(lost, F.raise_error(problem)).otherwise(tried).alias(f.name)

    for f in schema:
        have = df.schema[f.name].dataType
        if have != f.dataType and (isinstance(have, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))):
            raise TypeError(f"{f.name} is {have.simpleString()}, the table keeps {f.dataType.simpleString()}")
    return df.select(*[cast(f) for f in schema])


def write_draft(
    spark: SparkSession, df: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str] = (),
    rebalance: bool = True, buckets: int = BUCKETS, bucket_bytes: int = BUCKET_BYTES,
    observed: tuple[Observation, Sequence[Column]] | None = None, partition_bytes: int = 0,
) -> Draft:
    """Compute and write new rows for the table at ``path``, which need not exist yet. An existing
    table keeps its own columns, types, partitioning and buckets.

    ``rebalance`` gathers the rows of a folder before they are written, splitting a large one over tasks; it is
    left out on request where all rows go to one partition of ``BUCKETS`` buckets at most: a task then writes a file for
    each. ``observed`` is measured on the rows by the tasks that write them. ``partition_bytes`` is about what the new
    rows will take where all go to one partition, or the table has none: what starts now gets as many buckets as that
    needs, so that the rows are not written a second time to split it.
    """
    if not keys:
        raise ValueError("an upsert needs at least one key")
    table = SilverTable(spark, path)
    state = table.state()
    bucket_by = tuple(keys)
    if state is not None:
        partition_by = state["partition_by"]
        bucket_by = tuple(state["bucket_by"]) or bucket_by
        if bucket_by != tuple(keys):
            raise ValueError(f"{path} is kept by {', '.join(bucket_by)}, not by {', '.join(keys)}")
        df = conform(df, T.StructType.fromJson(state["schema"]))
    elif exists(table.spark, path) and glob(table.spark, f"{path}/[!_.]*"):
        raise ValueError(f"{path} holds a table that upsert does not manage")
    directories = _directories(state)
    if partition_by:
        # A new partition starts with as many buckets as others have.
        depths = [directories.get(place, Directory()).depth for place in {_place(f) for f in _codes(state)}]
        initial = Directory.of_depth(statistics.median_low(depths) if depths else 0)
    else:
        initial = Directory.at_least(buckets)
    if state is None or "codes" in state:  # earlier versions do not list the buckets of a partition
        initial = Directory.of_depth(max(initial.depth, bits_to_split(partition_bytes, bucket_bytes, ROOT)))
    draft = Draft(table, state, df.schema, tuple(partition_by), bucket_by, directories, initial, bucket_bytes)
    rows = _in_bucket(df, draft, directories)
    few_folders = not rebalance and all(len(d.codes) <= BUCKETS for d in (initial, *directories.values()))
    rows = rows if few_folders else rows.hint("rebalance", *draft.layout)
    if observed is not None:
        # Behind the shuffle: in the tasks that write, of which only those that succeed count.
        rows = rows.observe(observed[0], *observed[1])
    draft.folders = table.write_folder(rows, draft.layout)
    return draft


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a non-null merge key occurs twice (null keys match nothing and may repeat)."""
    repeated = source.filter(all_present(keys)).groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise DuplicateKeys(f"source rows are not unique on {', '.join(keys)}")


def _near(draft: Draft, some_keys: DataFrame, keys: Sequence[str]) -> list[str]:
    """Folders of the table whose bucket is one that ``some_keys``, none of them null, fall into."""
    old = _codes(draft.state)
    if not old:
        return []
    deepest = max(map(depth, old.values()))
    holding = Directory(tuple({*old.values()})).holding(low_bits_of(some_keys, F.xxhash64(*keys), deepest), deepest)
    return [folder for folder, code in old.items() if code in holding]


def _touched(
    draft: Draft, source_keys: DataFrame, keys: Sequence[str], retract: DataFrame | None = None
) -> set[str]:
    """Folders of the table that may hold a key of the draft or of ``retract``, nulls left out.

    Without partition columns those of the draft's buckets and of the retracted keys'. With partition columns those in which
    the key columns and the folder's own values find a key; only buckets that the keys' hashes fall into
    are listed and read, and a bitmap of the keys goes ahead of the join. A row per folder reaches the driver."""
    if not draft.partition_by:
        codes = {_code_in(f) for f in draft.folders}
        touched = {f for f, code in _codes(draft.state).items() if code in codes}
        return touched if retract is None else touched.union(_near(draft, retract, keys))
    some_keys = source_keys if retract is None else source_keys.unionByName(retract).distinct()
    near = _near(draft, some_keys, keys)
    if not near:
        return set()
    place = {"_v": F.col("_v"), _BUCKET: F.col(_BUCKET), **{c: F.col(f"`{c}`") for c in draft.partition_by}}
    values = [column.cast("string").alias(f"_in_{name}") for name, column in place.items()]
    rows = draft.read(near).select(*keys, *values)
    n = some_keys.count()
    hits = may_match(rows, some_keys, keys, n).join(join_side(some_keys, n), list(keys), "left_semi")
    found = {tuple(row) for row in hits.select(*[f"`_in_{name}`" for name in place]).distinct().collect()}

    def values_of(folder: str) -> tuple:
        parts = dict(_parts(folder))
        return (parts["_v"], parts.get(_BUCKET), *_values(_place(folder)))

    return {folder for folder in near if values_of(folder) in found}


def _grown(draft: Draft, old: Mapping[str, int], new: Mapping[str, int], touched: set[str]):
    """(directories, folders to write again): buckets the batch has touched are split where they have grown past the
    target, and made one folder where they have many."""
    directories = dict(draft.directories)
    again: set[str] = set()
    members: dict[tuple[str, int], list[str]] = defaultdict(list)
    for folder, code in [*old.items(), *new.items()]:
        members[_place(folder), code].append(folder)
    for place in map(_place, new):
        directories.setdefault(place, draft.initial)
    for place in map(_place, old):
        directories.setdefault(place, Directory())
    for (place, code), folders in members.items():
        if not (touched.intersection(folders) or any(f in new for f in folders)):
            continue
        total = sum(size(draft.table.spark, f"{draft.table.path}/{f}") for f in folders)
        more = bits_to_split(total, draft.bucket_bytes, code)
        if more and depth(code) < MAX_DEPTH:
            directories[place] = directories[place].split(code, more)
            again.update(folders)
        elif len(folders) > CROWD:
            again.update(folders)
    return directories, again


def merge(
    draft: Draft, keys: Sequence[str], newer_by: str | None = None, unique: bool = False,
    retention: timedelta = RETENTION, retract: DataFrame | None = None, marks: Mapping[str, object] | None = None,
) -> None:
    """Publish a draft: rows whose keys match are replaced, the others inserted, none deleted.

    A matched row is replaced whatever its age; with ``newer_by`` the side that is higher in that
    column stays, the draft's on a tie. Rows with a null key never match. ``unique`` says the
    caller has checked that the draft's keys are. Rows with one of the keys in ``retract`` leave the table first,
    whatever their age. ``marks`` go into the state (see ``publish``).
    """
    source = draft.rows
    if not unique:
        check_unique(source, keys)
    columns = draft.schema.fieldNames()
    old, new = _codes(draft.state), {f: _code_in(f) for f in draft.folders}
    if draft.state is not None and retract is None and source.isEmpty():
        draft.discard()
        if marks:
            draft.folders = []
            draft.table.publish(draft, old, draft.directories, retention, marks)
        return
    keyed_source = source.filter(all_present(keys))
    source_keys = keyed_source.select(*keys)
    if retract is not None:
        retract = retract.select(*keys).filter(all_present(keys))
    touched = _touched(draft, source_keys, keys, retract)
    directories, grown = _grown(draft, old, new, touched)
    again = touched | grown.intersection(old)
    if newer_by is not None and touched:
        written_again = set(new)
    elif draft.partition_by:
        written_again = grown.intersection(new)
    else:
        # One folder a bucket: the draft's rows are written with the old ones.
        shared = {old[f] for f in again}
        written_again = {f for f, code in new.items() if code in shared} | grown.intersection(new)
    folders = {f: code for f, code in {**old, **new}.items() if f not in again | written_again}
    if again or written_again:
        rest = draft.read(sorted(written_again)).select(*columns)
        if again:
            before = draft.read(sorted(again)).select(*columns)
            # Kept out of the joins: rows without a key match nothing and would pile up in one task.
            unkeyed = before.filter(~all_present(keys))
            keyed = before.filter(all_present(keys))
            if retract is not None:
                keyed = keyed.join(join_side(retract, retract.count()), list(keys), "left_anti").select(*columns)
            if newer_by is None:
                replaced = join_side(source_keys, source_keys.count())
                rest = keyed.join(replaced, list(keys), "left_anti").select(*columns).unionByName(rest)
            else:
                both = keyed.withColumn("_from_source", F.lit(0)).unionByName(
                    keyed_source.withColumn("_from_source", F.lit(1))
                )
                rest = latest_by(both, keys, [newer_by, "_from_source"]).select(*columns)
                rest = rest.unionByName(source.filter(~all_present(keys)))
                folders = {f: code for f, code in folders.items() if f not in new}
            rest = rest.unionByName(unkeyed)
        rest = _in_bucket(rest, draft, directories).hint("rebalance", *draft.layout)
        draft.rest = draft.table.write_folder(rest, draft.layout)
        folders |= {f: _code_in(f) for f in draft.rest}
    if not draft.partition_by:
        directories.setdefault("", draft.initial)
    draft.table.publish(draft, folders, directories, retention, marks)


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    newer_by: str | None = None,
    retention: timedelta = RETENTION,
    bucket_bytes: int = BUCKET_BYTES,
    retract: DataFrame | None = None,
    marks: Mapping[str, object] | None = None,
) -> None:
    """Draft and merge in one call. The first load creates the table."""
    draft = write_draft(df.sparkSession, df, path, keys, partition_by, bucket_bytes=bucket_bytes)
    try:
        merge(draft, keys, newer_by, retention=retention, retract=retract, marks=marks)
    except Exception:
        draft.discard()
        raise


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A silver table: an upserted one through its state, any other as plain Parquet by its dates."""
    table = SilverTable(spark, path)
    state = table.state()
    if state is None:
        return read_dates(spark, path)
    schema = T.StructType.fromJson(state["schema"])
    return table.read_folders(state["folders"], _with_bucket(schema)).select(*schema.fieldNames())

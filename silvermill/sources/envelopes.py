"""Explicit-schema scans of landed envelopes, limited to a date and an entity."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.sinks.landing import TIME_PARTITIONS
from silvermill.storage import glob


@dataclass(frozen=True)
class Scope:
    """What a run reads: one process date, and all entities or exactly one."""

    process_date: str | None = None
    owner: str | None = None
    repo: str | None = None

    def __post_init__(self):
        if bool(self.owner) != bool(self.repo):
            raise ValueError("Give both owner and repo, or neither.")
        if self.process_date is not None:
            datetime.strptime(self.process_date, "%Y-%m-%d")

    @property
    def date_folder(self) -> str:
        if self.process_date is None:
            return ""
        day = datetime.strptime(self.process_date, "%Y-%m-%d")
        return f"/yyyy={day:%Y}/mm={day:%m}/dd={day:%d}"

    @property
    def entity(self) -> Column | None:
        """Row filter; a partition filter where owner and repo are folders."""
        if not self.owner:
            return None
        return (F.col("owner") == F.lit(self.owner)) & (F.col("repo") == F.lit(self.repo))

    def bare_path(self, root: str) -> str:
        """Path in the layout ``root/owner/repo/yyyy=/mm=/dd=/hh=`` with plain entity folders."""
        entity = f"/{self.owner}/{self.repo}" if self.owner else "/*/*"
        return f"{root}{entity}{self.date_folder}"


def scan_envelopes(
    spark: SparkSession,
    root: str,
    schema: str,
    scope: Scope = Scope(),
    layout: str = "keyed",
    endpoint: str | None = None,
    allow_missing: bool = False,
    corrupt_column: str | None = None,
    with_partitions: bool = False,
) -> DataFrame:
    """Envelopes of a scope with the columns of ``schema`` (DDL, trimmed to what is used).

    Permissive: unknown fields are dropped, missing ones and wrongly typed ones are null, a
    corrupt line is an all-null row (its text goes to ``corrupt_column`` when named). Only the
    scope's date folder is listed. ``layout="bare"`` reads folders that name owner and repo
    without keys and takes both from the envelope. A missing path raises, or with
    ``allow_missing`` gives an empty frame.
    """
    fields = T.StructType.fromDDL(schema)
    columns = fields.fieldNames()
    if corrupt_column:
        fields = fields.add(corrupt_column, "string")
        columns = [*columns, corrupt_column]
    reader = spark.read.option("mode", "PERMISSIVE")
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)

    if layout == "bare":
        path = scope.bare_path(root)
        reader = reader.option("recursiveFileLookup", "true")
    else:
        path = root + scope.date_folder
        reader = reader.option("basePath", root)
        for name in TIME_PARTITIONS:
            fields = fields.add(name, "string")
        if with_partitions:
            columns = [*columns, *TIME_PARTITIONS]

    if allow_missing and not glob(spark, path):
        return spark.createDataFrame([], fields).select(*columns)
    df = reader.schema(fields).json(path)
    if scope.entity is not None and layout != "bare":
        df = df.filter(scope.entity)
    if endpoint is not None:
        ours = F.col("endpoint") == F.lit(endpoint)
        # A line that cannot be read has no endpoint; it is kept where its text is asked for.
        df = df.filter(ours | F.col(corrupt_column).isNotNull() if corrupt_column else ours)
    return df.select(*columns)

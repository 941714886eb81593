"""Session settings and the shared scratch area that multi-step jobs stage their tables in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from silvermill.storage import delete, glob, make_until_exit, size

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot lookup key is split over tasks even where a later step then needs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Unless the caller has set them. Columns unpack to some ten times their bytes in a file, and tasks sort what they read:
# at Spark's 128 MB a split they spill.
DEFAULTS = {"spark.sql.files.maxPartitionBytes": "32m"}

_folders: dict[str, str] = {}


def get_spark(app: str, **conf: str) -> SparkSession:
    """The application's own session, with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def derived_session(spark: SparkSession) -> SparkSession:
    """A session beside the caller's, with its settings and then ours; the caller's stays as it is."""
    own = spark.newSession()
    for key, value in {**DEFAULTS, **spark.conf.getAll, **SETTINGS}.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    return own


def shared_folder(spark: SparkSession) -> str:
    """This application's folder among those all executors see: under ``spark.checkpoint.dir``, or where
    that is unset under the warehouse. It is deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        _folders[app] = make_until_exit(spark, f"{root.rstrip('/')}/{app}-{uuid.uuid4().hex[:8]}")
    return _folders[app]


class Scratch:
    """Staged tables of one job. Used as a context manager it deletes them at the end.

    A staged table is computed once, survives the loss of executors and is re-read with column
    pruning, which is what the quality checks and the publish step behind it need.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.folder)

    def path(self, label: str) -> str:
        return f"{self.folder}/{label}-{uuid.uuid4().hex[:8]}"

    def size(self, label: str, partition: str = "") -> int:
        """Bytes of the tables staged under ``label``, or of one partition of theirs."""
        return sum(size(self.spark, path) for path in glob(self.spark, f"{self.folder}/{label}-*/{partition}".rstrip("/")))

    def stage(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.path(label)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

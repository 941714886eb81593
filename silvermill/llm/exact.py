"""Exact deduplication as a stateful stream.

Every document becomes a record of digest, id and locator (file and row in it). A stream takes the
records in; its state, on disk in RocksDB and without expiry, keeps per digest how many came, the largest
id and where that document's text is to be found. Aggregation before the shuffle leaves one record per
digest and task, so a text that a third of all documents share is no hot key. A restarted or
continued stream goes on from its checkpoint.

A digest that came more than once is a hit, and hits are checked on the full bytes: the texts behind
hits are read again and grouped by their bytes. Where a group has as many rows as its digest's state, the state is right;
a digest whose texts differ falls apart into groups of their own. A bitmap of fixed size over the
hits' digests lets all other documents pass without moving their texts.

Defined cases: a null text counts as empty, and empty texts are equal; texts are equal when their bytes are;
of equal texts the largest id stays, a null id only if all are null, and of rows that repeat the id the last by file
and row; an empty table gives no rows. Texts are read whole. Columns of the input may have any names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.llm.common import located, new_folder, split_by_keys, staged

BATCH_BYTES = 64 << 30  # of records (about 150 bytes a document) per micro-batch
_STATE = "spark.sql.streaming.stateStore"
STATE_SETTINGS = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Else every partition's store reserves megabytes of disk before it has a row.
    f"{_STATE}.rocksdb.allowFAllocate": "false",
}
RECORD = "digest binary, doc_id long, file string, row long"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@contextmanager
def _settings(spark: SparkSession, **values: str):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def keep_state(spark: SparkSession, records: str, checkpoint: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Take in all records under the folder that the stream has not seen, and return its state:
    digest, n, keeper (doc_id, file, row)."""
    keeper = F.max(F.struct("doc_id", "file", "row")).alias("keeper")
    stream = spark.readStream.schema(RECORD).option("maxBytesPerTrigger", batch_bytes).parquet(records)
    counted = stream.groupBy("digest").agg(F.count("*").alias("n"), keeper)
    with _settings(spark, **STATE_SETTINGS):
        query = (
            counted.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
            .queryName(f"exact-{uuid.uuid4().hex}").option("checkpointLocation", checkpoint).start()
        )
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
    value = [F.col(f"value.`{name}`") for name in state.schema["value"].dataType.names]
    return state.select("key.digest", value[0].alias("n"), value[1].alias("keeper"))


def grouped(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Every row's struct ``doc``, its doc_id and text, n (rows of its text), keep_id, and kept."""
    spark = docs.sparkSession
    rows = located(docs, id_col, text_col).withColumn("digest", digest(F.col("text")))
    records = new_folder(spark, "exact-records")
    rows.select("digest", "doc_id", "file", "row").write.parquet(records)
    state = keep_state(spark, records, new_folder(spark, "exact-stream"), batch_bytes)
    hits = staged(state.filter("n > 1"), "exact-hits")

    single, several = split_by_keys(rows, hits, "digest")
    same = several.groupBy("digest", "text").agg(
        F.count("*").alias("n"), F.max(F.struct("doc_id", "file", "row")).alias("keeper")
    )
    same = same.join(hits.select("digest", F.col("n").alias("n_state")), "digest", "left")
    # Whole: all rows of the digest have these bytes. Only of other digests the text itself is kept.
    whole = F.coalesce(F.col("n") == F.col("n_state"), F.col("n") == 1)
    same = staged(
        same.select("digest", "n", "keeper", whole.alias("whole"), F.when(~whole, F.col("text")).alias("bytes")),
        "exact-groups",
    )
    here = F.struct("doc_id", "file", "row")
    out = ["doc", "doc_id", "text", "n", F.col("keeper.doc_id").alias("keep_id"), here.eqNullSafe(F.col("keeper")).alias("kept")]
    alone = single.select("doc", "doc_id", "text", F.lit(1).cast("long").alias("n"), F.col("doc_id").alias("keep_id"), F.lit(True).alias("kept"))
    by_digest = several.join(same.filter("whole").drop("bytes", "whole"), "digest").select(*out)
    clashing = same.filter("not whole").drop("whole")
    by_bytes = several.join(clashing, (several["digest"] == clashing["digest"]) & (several["text"] == clashing["bytes"]))
    return alone.unionAll(by_digest).unionAll(by_bytes.select(*out))


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    return grouped(docs, id_col, text_col, **options).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"), "kept", F.sha2("text", 256).alias("text_sha256")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each text, with the columns it came with."""
    return grouped(docs, id_col, text_col, **options).filter("kept").select("doc.*")

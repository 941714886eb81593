"""Small helpers of the operators: input projection, splits of labelled rows, staged tables."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.session import shared_folder



BITS = 1 << 26  # of the bitmap that tells rows apart: 8 MB, whatever the input


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, a null text as the empty one. Whatever other columns
    the table has are left behind, so their names cannot clash with an operator's own."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def held_out(id_column: Column, parts: int, part: int) -> Column:
    """True where crc32 of the id as text leaves ``part`` modulo ``parts``, and for a null id."""
    remainder = F.crc32(id_column.cast("string").cast("binary")) % parts
    return F.coalesce(remainder == part, F.lit(True))


def new_folder(spark: SparkSession, label: str) -> str:
    """A path that no other run uses, inside the folder all executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called that, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, rows: int,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents outside the held-out part, those with the
    smallest hashes of their ids. Rows with a null id or label are never learned from. Labels without a document do
    not count: those of documents are found by ids alone, before any text is read. Of several texts with one id
    the last in order is learned from."""
    known = docs.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    chosen = (
        labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"), parts, part))
        .distinct()
        .join(known, "doc_id", "left_semi")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(rows)
    )
    # The chosen ids are at most ``rows``, which bounds the broadcast.
    found = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("text", "label")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once and read back: later steps do not compute it again, and no executor's
    loss can take it away."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, doc_id, text, file, row): the input's own columns in one struct, so that no name clashes, and
    the file and row a document stands in. A frame that does not come from files is written to some."""
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")

    def placed(df: DataFrame) -> DataFrame:
        where = df.metadataColumn("_metadata")
        return df.select(doc, where.getField("file_path").alias("file"), where.getField("row_index").alias("row"))

    try:
        rows = placed(docs)
    except AnalysisException:
        rows = placed(staged(docs, "input"))
    text = F.coalesce(F.col("doc").getField(text_col), F.lit(""))
    return rows.withColumns({"doc_id": F.col("doc").getField(id_col).cast("long"), "text": text})


def split_by_keys(rows: DataFrame, keys: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    """Rows that certainly match none of ``keys`` on the columns ``on``, and the others, without a shuffle of
    ``rows``: a bitmap of fixed size over the hashes of the keys is broadcast. The more keys, the more
    rows without a match are among the others, so a join has to follow."""
    at = F.pmod(F.xxhash64(*on), F.lit(BITS))
    places = keys.select(at.alias("_at"))
    bitmap = places.groupBy(F.bitmap_bucket_number("_at").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )
    # At most BITS / 32768 rows of 4 KB.
    marked = rows.withColumn("_bucket", F.bitmap_bucket_number(at)).join(F.broadcast(bitmap), "_bucket", "left")
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    powers = F.array(*(F.lit(1 << i) for i in range(8)))
    is_set = byte.bitwiseAND(F.element_at(powers, (bit % 8).cast("int") + 1)) != 0
    found = F.coalesce(is_set, F.lit(False))
    return marked.filter(~found).select(*rows.columns), marked.filter(found).select(*rows.columns)

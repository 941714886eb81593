"""The corpus pipeline: good and clean documents, one of each text and class of near copies, packed.

Defined cases: a null text counts as empty and is judged, deduplicated and packed like one; of equal texts the
row with the largest id stays, one without an id only if all lack it, and of rows that repeat that id the last by file and
row; of a class of near copies the one with the least id stays, again one without only if all lack it, and of rows that
repeat it the first by file and row; documents without words are near copies of none; an empty table gives no rows at any
stage; columns besides doc_id and text pass through unread, whatever their names; texts are read whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from silvermill.llm import exact, ngram_join, packing, quality, toxicity
from silvermill.llm.common import staged, table


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def keep_not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def keep_one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_one(docs)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_good_quality),
    ("toxicity", keep_not_toxic),
    ("exact_dedup", keep_one_of_each_text),
    ("near_dedup", keep_one_of_each_class),
    ("packing", pack),
]

# Learned scores and a tokenizer decide rows, which SQL cannot express; tests/llm has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The registered queries of the operators, over their whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.token_files import token_file_digests

    return token_file_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op8_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.bpe import digests, encode_and_decode

    return digests(
        encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    )


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.common import held_out
    from silvermill.llm.language import predict, train

    docs = table(spark, sf_dir, "documents")
    learned = docs.filter(F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 3, 1))
    scored = predict(docs, train(learned))
    return scored.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.common import held_out
    from silvermill.llm.quality import score, train

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.common import held_out
    from silvermill.llm.toxicity import score, train

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score", "predicted")


@query
def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.knn import top_k

    return top_k(table(spark, sf_dir, "embeddings"))


ORACLES["op4_top_k"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as vec
  from embeddings where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5"""


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.exact import duplicates

    return duplicates(table(spark, sf_dir, "documents"))


ORACLES["op2_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  coalesce(doc_id = max(doc_id) over same, false) as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.ngram_join import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.lines import drop_recurring_lines

    return drop_recurring_lines(table(spark, sf_dir, "documents"), short_lines=True)


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.alignment import align_and_score

    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_and_score(table(spark, sf_dir, "documents"), *paths)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.periodic import digests, periodic_runs, with_planted_periods

    return digests(periodic_runs(with_planted_periods(table(spark, sf_dir, "documents"))))


@query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from silvermill.llm.secret_scan import digests, find_secrets

    return digests(find_secrets(table(spark, sf_dir, "documents")))

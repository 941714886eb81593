"""Line deduplication by a tree of templates of fixed depth.

A line's path in the tree is its number of tokens and its leading tokens; tokens with a digit and addresses are
variable fields from the start. In a leaf, a token is fixed where enough lines have it in that place, any other is a
variable field too. The line with its variable fields generalised is its template, if enough of its
tokens are fixed, else the line itself is, with what stands in its fields. Templates that occur in at least ``min_docs`` documents recur, and
their lines are dropped from all documents.

Only leaves that enough documents reach can hold such a template. These are counted first, one number per
leaf and batch, and only their lines go on; a bitmap of fixed size tells which, and a leaf that shares a bit with
another does no harm, since all later counts are of the lines themselves. Equal lines are aggregated before they
are shuffled. The different lines to drop are broadcast, 16 bytes each, up to a checked number; beyond it the
documents that lose a line are joined with what they lose.

Lines of fewer than ``min_tokens`` tokens, as also long ones in scripts without spaces are, are not generalised: with
``short_lines`` each stands for itself and is dropped where it recurs, without it they stay.

Defined cases: lines end at a line feed; blank lines are never dropped; a
null text counts as empty, with one empty line; null ids and repeated rows are documents like others, so rows that
repeat often enough lose their lines; an empty table gives no rows. Columns may have any names; lines and texts are
read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silvermill.llm.common import BITS, located, split_by_keys, staged

LEADING = 3
MIN_TOKENS = 4
MIN_DOCS = 10
MIN_FIXED = 0.6
BROADCAST_LINES = 500_000  # 16 bytes each; more different lines to drop are joined with the documents instead
FIELD = "<*>"

_VARIABLE = re.compile(r"\d|://|@")
_PAGE = 1 << 15  # bits of one bitmap row


def tokens(line: str) -> list[str]:
    """The line's tokens, those that are variable by their form as ``<*>``."""
    found = line.split()
    if _VARIABLE.search(line):
        found = [FIELD if _VARIABLE.search(t) else t for t in found]
    return found


def leaf(found: list[str]) -> int:
    """Hash of the path: token count and leading tokens."""
    path = " ".join([str(len(found)), *found[:LEADING]])
    return xxhash.xxh3_64_intdigest(path.encode("utf-8", "surrogatepass")) - (1 << 63)


def digest(found: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(found).encode("utf-8", "surrogatepass"))


def own_digest(line: str) -> bytes:
    """Digest of the line's tokens as they are; by its seed it is no digest of masked tokens."""
    return xxhash.xxh3_128_digest(" ".join(line.split()).encode("utf-8", "surrogatepass"), seed=1)


def parsed(text: str, min_tokens: int = MIN_TOKENS, short_lines: bool = False) -> Iterator[tuple[str, list[str] | None]]:
    """(line, tokens) of each line; no list for one that is never dropped, an empty one for a short line, which
    only stands for itself."""
    for line in text.split("\n"):
        found = tokens(line)
        if len(found) >= max(1, min_tokens):
            yield line, found
        else:
            yield line, [] if found and short_lines else None


def _path(line: str, found: list[str]) -> int:
    """The leaf of a line's template; a short line has one of its own."""
    if found:
        return leaf(found)
    return int.from_bytes(own_digest(line)[:8], "little", signed=True)


def _place(leaf_hash: int) -> int:
    return leaf_hash % BITS


def count_leaves(rows: DataFrame, min_tokens: int, short_lines: bool = False) -> DataFrame:
    """(leaf, n): numbers of documents that reach a leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                lines = parsed(text.as_py(), min_tokens, short_lines)
                seen.update({_path(line, found) for line, found in lines if found is not None})
            yield pa.RecordBatch.from_pydict(
                {"leaf": pa.array(list(seen), pa.int64()), "n": pa.array(list(seen.values()), pa.int64())}
            )

    return rows.select("text").mapInArrow(run, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n"))


def _bitmap(leaves: DataFrame) -> np.ndarray:
    """One bit for every leaf, in BITS / 8 bytes whatever their number."""
    at = leaves.select(F.pmod("leaf", F.lit(BITS)).alias("at"))
    pages = at.groupBy((F.col("at") / _PAGE).cast("int").alias("page")).agg(
        F.bitmap_construct_agg((F.col("at") % _PAGE).cast("int")).alias("bits")
    )
    bitmap = np.zeros(BITS // 8, np.uint8)
    for page, bits in pages.collect():
        bitmap[page * _PAGE // 8 : page * _PAGE // 8 + len(bits)] = np.frombuffer(bits, np.uint8)
    return bitmap


def candidate_lines(rows: DataFrame, leaves: DataFrame, min_tokens: int, short_lines: bool = False) -> DataFrame:
    """(file, row, line, own, leaf, masked, first): each document's different lines in the given leaves; ``line`` is
    a 128-bit hash of ``masked``, ``own`` one of the line as it is, ``first`` true once per document and ``line``. A short
    line has no ``masked``, and ``own`` as its ``line``."""
    shared = rows.sparkSession.sparkContext.broadcast(_bitmap(leaves))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for file, row, text in zip(*(c.to_pylist() for c in batch.columns)):
                seen, seen_own = set(), set()
                for text_line, found in parsed(text, min_tokens, short_lines):
                    if found is None:
                        continue
                    path = _path(text_line, found)
                    at = _place(path)
                    if bitmap[at >> 3] >> (at & 7) & 1:
                        own = own_digest(text_line)
                        if own not in seen_own:
                            seen_own.add(own)
                            line = digest(found) if found else own
                            masked = " ".join(found) if found else None
                            values = (file, row, line, own, path, masked, line not in seen)
                            seen.add(line)
                            for column, value in zip(out, values):
                                column.append(value)
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string(), pa.bool_())
            columns = [pa.array(column, kind) for column, kind in zip(out, kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["file", "row", "line", "own", "leaf", "masked", "first"])

    schema = "file string, row long, line binary, own binary, leaf long, masked string, first boolean"
    return rows.select("file", "row", "text").mapInArrow(run, schema)


def templates(lines: DataFrame, min_docs: int, min_fixed: float) -> DataFrame:
    """(line, template) of those different lines (line, leaf, masked, n) that have enough fixed tokens."""
    words = lines.select("line", "leaf", "n", F.posexplode(F.split("masked", " ")).alias("place", "token"))
    often = words.groupBy("leaf", "place", "token").agg(F.sum("n").alias("support")).filter(F.col("support") >= min_docs)
    often = often.filter(F.col("token") != FIELD).select("leaf", "place", "token", F.lit(True).alias("fixed"))
    marked = words.join(staged(often, "fixed-tokens"), ["leaf", "place", "token"], "left")
    token = F.when(F.col("fixed"), F.col("token")).otherwise(FIELD)
    general = marked.groupBy("line", "leaf").agg(
        F.array_sort(F.collect_list(F.struct("place", token.alias("token")))).alias("tokens"),
        F.avg(F.coalesce(F.col("fixed"), F.lit(False)).cast("int")).alias("share"),
    )
    pattern = F.concat_ws(" ", "leaf", F.array_join("tokens.token", " "))
    return general.filter(F.col("share") >= min_fixed).select("line", pattern.alias("template"))


def recurring_lines(
    rows: DataFrame, min_docs: int, min_tokens: int, min_fixed: float, short_lines: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(line): digests of the different lines to drop, masked where a template covers them, else their own; and
    (file, row, line): both digests of the lines of frequent leaves that documents hold."""
    leaves = staged(count_leaves(rows, min_tokens, short_lines).filter(F.col("n") >= min_docs).select("leaf"), "leaves")
    lines = staged(candidate_lines(rows, leaves, min_tokens, short_lines), "candidate-lines")
    whole = lines.filter("masked is not null")
    different = whole.groupBy("line", "leaf", "masked").agg(F.count_if("first").alias("n"))
    named = staged(templates(staged(different, "different-lines"), min_docs, min_fixed), "templates")
    # Documents of a template, each once however many of its lines it has. A line without one is its own.
    own = F.concat(F.lit("="), F.hex("own"))
    held = lines.select("file", "row", "line", "own").join(named, "line", "left")
    held = held.select(F.coalesce("template", own).alias("template"), "file", "row").distinct()
    recurring = held.groupBy("template").agg(F.count("*").alias("docs")).filter(F.col("docs") >= min_docs)
    recurring = staged(recurring.select("template"), "recurring")
    alone = recurring.filter(F.col("template").startswith("="))
    dropped = named.join(recurring, "template").select("line").unionAll(
        alone.select(F.unhex(F.expr("substring(template, 2)")).alias("line"))
    )
    digests = F.explode(F.array_distinct(F.array("line", "own"))).alias("line")
    return staged(dropped, "dropped"), lines.select("file", "row", digests).distinct()


_LEFT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())])


def _without(text: str, drop: set[bytes] | frozenset[bytes], min_tokens: int, short_lines: bool) -> tuple[str, int]:
    parts = text.split("\n")
    kept = [
        line
        for line, found in parsed(text, min_tokens, short_lines)
        if found is None or (own_digest(line) not in drop and (not found or digest(found) not in drop))
    ]
    return "\n".join(kept), len(parts) - len(kept)


def _by_broadcast(rows: DataFrame, dropped: DataFrame, min_tokens: int, short_lines: bool) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(frozenset(bytes(r["line"]) for r in dropped.collect()))

    @F.pandas_udf(_LEFT)
    def left(texts: pd.Series) -> pd.DataFrame:
        out = [_without(t, shared.value, min_tokens, short_lines) for t in texts]
        return pd.DataFrame(out, columns=["text", "n_dropped"])

    return rows.select("doc_id", "text", left("text").alias("left"))


def _by_join(rows: DataFrame, dropped: DataFrame, lines: DataFrame, min_tokens: int, short_lines: bool) -> DataFrame:
    @F.pandas_udf(_LEFT)
    def left(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
        out = [_without(t, set(d), min_tokens, short_lines) for t, d in zip(texts, drops)]
        return pd.DataFrame(out, columns=["text", "n_dropped"])

    drops = lines.join(dropped, "line").groupBy("file", "row").agg(F.collect_list("line").alias("lines"))
    drops = staged(drops, "dropped-lines")
    sure, doubtful = split_by_keys(rows, drops, "file", "row")
    none = F.array().cast("array<binary>")
    joined = doubtful.join(drops, ["file", "row"], "left").withColumn("lines", F.coalesce("lines", none))
    whole = F.struct(F.col("text").alias("text"), F.lit(0).cast("long").alias("n_dropped"))
    return sure.select("doc_id", "text", whole.alias("left")).unionAll(
        joined.select("doc_id", "text", left("text", "lines").alias("left"))
    )


def drop_recurring_lines(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    min_tokens: int = MIN_TOKENS,
    min_fixed: float = MIN_FIXED,
    id_col: str = "doc_id",
    text_col: str = "text",
    short_lines: bool = False,
) -> DataFrame:
    """doc_id, n_lines, n_dropped and text (what is left) of every document."""
    rows = located(docs, id_col, text_col).select("doc_id", "text", "file", "row")
    dropped, lines = recurring_lines(rows, min_docs, min_tokens, min_fixed, short_lines)
    if dropped.count() <= BROADCAST_LINES:
        left = _by_broadcast(rows, dropped, min_tokens, short_lines)
    else:
        left = _by_join(rows, dropped, lines, min_tokens, short_lines)
    n_lines = F.size(F.split("text", "\n")).cast("long").alias("n_lines")
    return left.select("doc_id", n_lines, "left.n_dropped", "left.text")

"""Alignment of two tokenizers' tokens over the same bytes, and how many documents link which ids.

A document is encoded by a byte-level vocabulary of the tokenizers library (A, with a space in front)
and by a sentencepiece model (B, which puts that space in front itself). Where a token of A and one of
B end at the same byte a group ends; every pair of an A and a B token whose bytes overlap is a link.

Identity map: for each A id the B id of the same bytes, or -1. A link between an id and its twin, which
is what exact one-to-one groups consist of, is counted in a vector as long as A's vocabulary, one per
task. Only the other links, those of irregular groups, enter the shuffle of pairs, distinct per document
and summed per task before. To score documents, the vector and the most frequent irregular pairs (at
most ``hot_pairs``) go to every task; links to rarer pairs are joined. What is frequent is never a join key.

Defined cases: a null or empty text, and one that either tokenizer does not give back byte for byte (B
turns U+2581 into a space), has no tokens, no links and an empty string of groups. Repeated rows and rows
with null ids are documents like others and counted each. Of several B ids with the same bytes the
identity map names the lowest whole piece, else the byte piece. Special tokens' strings are plain text.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text, staged
from silvermill.llm.tokens import _BYTE_LETTERS as BYTE_LETTERS
from silvermill.llm.tokens import Encoder, Generations

HOT_PAIRS = 1 << 20
BATCH_BYTES = 1 << 20  # of text that is aligned in one go
PENDING_KEYS = 1 << 22  # pair keys a task holds before it sums them
HELD_KEYS = 1 << 20  # different pairs a task holds before it sends them on

ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string,"
    " twins binary, twin_links binary, pairs binary, pair_links binary"
)
LINKS = ("twins", "twin_links", "pairs", "pair_links")
SPACE = "▁"

_SEGMENT = re.compile(" *[^ ]+| +")


class PieceEncoder:
    """Ids of a sentencepiece model. No piece has a space mark behind another character, so words with
    the spaces before them are encoded apart; their ids are kept, as in ``tokens.Encoder``."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.apart = not any(SPACE in piece.lstrip(SPACE) for piece in pieces)
        self.byte_pieces = {i for i in range(size) if self.model.is_byte(i)}
        # Fixed values: <0xHH> is the byte HH, the mark a space.
        self.content = [
            bytes([int(p[3:5], 16)]) if i in self.byte_pieces else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.segments = Generations(self._segment)

    def _segment(self, segment: str) -> bytes:
        if segment.isspace() and not segment.strip(" "):
            ids = self.model.encode("a" + segment)[len(self.model.encode("a")) :]
        else:
            ids = self.model.encode(segment[1:])
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of space and text, as unsigned 32-bit integers."""
        if not self.apart or SPACE in text:
            return array("I", self.model.encode(text)).tobytes()
        return b"".join(map(self.segments.__getitem__, _SEGMENT.findall(" " + text)))


class Vocabulary:
    """Bytes of every id, laid end to end, and the id as text with a separator."""

    def __init__(self, content: list[bytes], inner: str, last: str):
        self.data = np.frombuffer(b"".join(content), "u1")
        self.length = np.array([len(c) for c in content], "i8")
        self.start = np.cumsum(self.length) - self.length
        self.inner = np.array([f"{i}{inner}" for i in range(len(content))], object)
        self.last = np.array([f"{i}{last}" for i in range(len(content))], object)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.length[ids])

    def joined(self, ids: np.ndarray) -> bytes:
        n = self.length[ids]
        at = np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return self.data[at].tobytes()


class Aligner:
    """Both tokenizers, their vocabularies and the identity map."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Encoder(a_path)
        self.a.tokenizer.encode_special_tokens = True
        self.b = PieceEncoder(b_path)
        letters = {chr(point): byte for byte, point in BYTE_LETTERS.items()}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        content = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            content[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.a_words = Vocabulary(content, ",", "|")
        self.b_words = Vocabulary(self.b.content, ",", ";")
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(self.b.content)), key=lambda i: (i in self.b.byte_pieces, i)):
            if not self.b.model.is_control(i) and not self.b.model.is_unknown(i):
                by_bytes.setdefault(self.b.content[i], i)
        self.twin = np.array([by_bytes.get(c, -1) if c else -1 for c in content], "i8")

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        a = np.frombuffer(self.a.encode(" " + text), self.a.dtype).astype("i8")
        return a, np.frombuffer(self.b.encode(text), "u4").astype("i8")

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both, or none where one of them does not give the text back."""
        none = np.empty(0, "i8")
        if not text:
            return none, none
        a, b = self.ids(text)
        data = (" " + text).encode()
        same = self.a_words.joined(a) == data and self.b_words.joined(b) == data
        return (a, b) if same else (none, none)


_ALIGNERS: dict = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process, so its caches outlive a task."""
    key = (a_path, b_path)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(a_path, b_path)
    return _ALIGNERS[key]


def _distinct(doc: np.ndarray, key: np.ndarray, keys: int, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different keys (below ``keys``) per document in order, how often each occurs there, and where documents begin."""
    every, times = np.unique(doc * keys + key, return_counts=True)
    return every % keys, times, np.searchsorted(every, np.arange(docs + 1) * keys)


def _slices(values: np.ndarray, dtype: str, bounds: np.ndarray) -> list[bytes]:
    values = values.astype(dtype)
    return [values[i:j].tobytes() for i, j in zip(bounds[:-1], bounds[1:])]


def align_batch(aligner: Aligner, texts: list[str]) -> dict[str, list]:
    """The columns of ``ALIGNED`` behind the id. All documents are laid end to end: both tokenizers' tokens
    cover the same bytes, so a document's end is an end of tokens on either side."""
    both = [aligner.tokens(text) for text in texts]
    docs = len(texts)
    n_a, n_b = (np.array([len(ids[side]) for ids in both], "i8") for side in (0, 1))
    a, b = (np.concatenate([np.empty(0, "i8"), *(ids[side] for ids in both)]) for side in (0, 1))
    a_ends, b_ends = aligner.a_words.ends(a), aligner.b_words.ends(b)
    doc_of_a = np.repeat(np.arange(docs), n_a)

    a_shared = np.isin(a_ends, b_ends, assume_unique=True)
    b_shared = np.isin(b_ends, a_ends, assume_unique=True)
    group_of_a = np.cumsum(a_shared) - a_shared
    group_of_b = np.cumsum(b_shared) - b_shared
    groups = int(a_shared.sum())
    in_a, in_b = np.bincount(group_of_a, minlength=groups), np.bincount(group_of_b, minlength=groups)

    # One stretch of bytes between two neighbouring ends is one link.
    ends = np.union1d(a_ends, b_ends)
    link_a, link_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    doc, a_id, b_id = doc_of_a[link_a], a[link_a], b[link_b]
    # An exact one-to-one group is a link of twins. Twins that overlap inside an irregular group count with them.
    twin = aligner.twin[a_id] == b_id
    size_a, size_b = len(aligner.a_words.length), len(aligner.b_words.length)
    same, same_times, same_bounds = _distinct(doc[twin], a_id[twin], size_a, docs)
    other, other_times, other_bounds = _distinct(doc[~twin], (a_id * size_b + b_id)[~twin], size_a * size_b, docs)
    other = other // size_b << 32 | other % size_b

    # A group is written as its A ids, then its B ids.
    words = np.empty(len(a) + len(b), object)
    before_a = np.cumsum(in_b) - in_b
    before_b = np.cumsum(in_a)
    words[np.arange(len(a)) + before_a[group_of_a]] = np.where(a_shared, aligner.a_words.last[a], aligner.a_words.inner[a])
    words[np.arange(len(b)) + before_b[group_of_b]] = np.where(b_shared, aligner.b_words.last[b], aligner.b_words.inner[b])
    stops = np.cumsum(n_a + n_b)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(doc_of_a[a_shared], minlength=docs),
        "n_links": np.bincount(doc, minlength=docs),
        "groups": ["".join(words[j - n : j].tolist())[:-1] for j, n in zip(stops, n_a + n_b)],
        "twins": _slices(same, "<u4", same_bounds),
        "twin_links": _slices(same_times, "<u4", same_bounds),
        "pairs": _slices(other, "<u8", other_bounds),
        "pair_links": _slices(other_times, "<u4", other_bounds),
    }


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: token, group and link counts, the groups as ``a1,a2|b1;a3|b2,b3``, and its
    different links: A ids linked to their twins, other links as A id * 2**32 + B id, each with how often
    it occurs there, packed little-endian."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)

        def done(ids, texts) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), **align_batch(both, texts)})

        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                texts.append(text.as_py())
                size += len(texts[-1]) + 64
                if size >= BATCH_BYTES:
                    yield done(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield done(ids, texts)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, ALIGNED)


def _documents_per_link(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, docs), per task: a vector over A's vocabulary for twins, sums of the other pairs."""

    def rows(a: np.ndarray, b: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"a": a.astype("i4"), "b": b.astype("i4"), "docs": docs.astype("i8")})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twin = aligner(a_path, b_path).twin
        vector = np.zeros(len(twin), "i8")
        held, docs = np.empty(0, "i8"), np.empty(0, "i8")
        pending, size = [], 0

        def summed() -> None:
            nonlocal held, docs, pending, size
            keys, times = np.unique(np.concatenate([np.empty(0, "i8"), *pending]), return_counts=True)
            every, place = np.unique(np.concatenate([held, keys]), return_inverse=True)
            total = np.zeros(len(every), "i8")
            np.add.at(total, place, np.concatenate([docs, times]))
            held, docs, pending, size = every, total, [], 0

        for batch in batches:
            for twins, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                vector[np.frombuffer(twins, "<u4")] += 1
                pending.append(np.frombuffer(pairs, "<u8").astype("i8"))
                size += len(pending[-1]) + 1
                if size >= PENDING_KEYS:
                    summed()
                    if len(held) >= HELD_KEYS:
                        yield rows(held >> 32, held & 0xFFFFFFFF, docs)
                        held, docs = np.empty(0, "i8"), np.empty(0, "i8")
        summed()
        if len(held):
            yield rows(held >> 32, held & 0xFFFFFFFF, docs)
        seen = np.flatnonzero(vector)
        if len(seen):
            yield rows(seen, twin[seen], vector[seen])

    return aligned.select("twins", "pairs").mapInArrow(run, "a int, b int, docs long")


def link_counts(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, docs, best): in how many documents a pair of ids is linked, and whether that is its A id's
    highest count; staged."""
    counts = _documents_per_link(aligned, a_path, b_path).groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    counts = staged(counts, "links")
    # A row per id of A's vocabulary at most.
    highest = F.broadcast(counts.groupBy("a").agg(F.max("docs").alias("_top")))
    return counts.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def _least_hot(others: DataFrame, hot_pairs: int) -> int:
    """The smallest class of counts such that it and all higher ones hold at most ``hot_pairs`` pairs. There are
    some hundred classes, whatever the table."""
    sizes = {r["class"]: r["count"] for r in others.groupBy("class").count().collect()}
    least, pairs = 1 << 30, 0
    for each in sorted(sizes, reverse=True):
        pairs += sizes[each]
        if pairs > hot_pairs:
            return least
        least = each
    return -1


def score_links(
    aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS
) -> DataFrame:
    """``aligned`` (stored, with a different ``row`` per document) without its links, with n_best, the links whose
    count is their A id's highest, and count_sum, the sum of all links' counts."""
    spark = aligned.sparkSession
    twin = aligner(a_path, b_path).twin
    twins = spark.createDataFrame(pa.table({"a": np.arange(len(twin), dtype="i4"), "b": twin.astype("i4")}))
    # Both are bounded: twins by A's vocabulary, hot pairs by their number.
    of_twins = counts.join(F.broadcast(twins), ["a", "b"], "left_semi").select("a", "docs", "best")
    others = counts.join(F.broadcast(twins), ["a", "b"], "left_anti")
    others = others.withColumn("class", F.floor(8 * F.log2("docs")).cast("int"))
    least = _least_hot(others, hot_pairs)
    hot = others.filter(F.col("class") >= least).select("a", "b", "docs", "best").toArrow()
    keys = hot["a"].to_numpy().astype("i8") << 32 | hot["b"].to_numpy()
    order = np.argsort(keys)
    known = of_twins.toArrow()
    twin_docs, twin_best = np.zeros(len(twin), "i8"), np.zeros(len(twin), "i8")
    twin_docs[known["a"].to_numpy()] = known["docs"].to_numpy()
    twin_best[known["a"].to_numpy()] = known["best"].to_numpy(zero_copy_only=False)
    shared = spark.sparkContext.broadcast(
        (
            twin_docs, twin_best, keys[order], hot["docs"].to_numpy()[order].astype("i8"),
            hot["best"].to_numpy(zero_copy_only=False)[order].astype("i8"),
        )
    )

    def split(pairs: bytes, hot_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, where they would stand among the hot ones, and whether they do."""
        keys = np.frombuffer(pairs, "<u8").astype("i8")
        at = np.searchsorted(hot_keys, keys)
        return keys, at, np.append(hot_keys, -1)[at] == keys

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twin_docs, twin_best, hot_keys, hot_docs, hot_best = shared.value
        for batch in batches:
            best, total = [], []
            links = (batch.column(c).to_pylist() for c in ("twins", "twin_links", "pairs", "pair_links"))
            for twins, twin_links, pairs, pair_links in zip(*links):
                a, n = np.frombuffer(twins, "<u4"), np.frombuffer(twin_links, "<u4").astype("i8")
                _, at, is_hot = split(pairs, hot_keys)
                at, m = at[is_hot], np.frombuffer(pair_links, "<u4").astype("i8")[is_hot]
                best.append(int(n @ twin_best[a] + m @ hot_best[at]))
                total.append(int(n @ twin_docs[a] + m @ hot_docs[at]))
            kept = {c: batch.column(c) for c in batch.schema.names if c not in LINKS}
            yield pa.RecordBatch.from_pydict({**kept, "n_best": pa.array(best, pa.int64()), "count_sum": pa.array(total, pa.int64())})

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema if f.name not in LINKS]
    scored = aligned.mapInArrow(score, ", ".join([*kept, "n_best long", "count_sum long"]))
    if least < 0:  # every pair is among the hot ones
        return scored

    def cold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_keys = shared.value[2]
        for batch in batches:
            for row, pairs, links in zip(*(batch.column(c).to_pylist() for c in ("row", "pairs", "pair_links"))):
                keys, _, is_hot = split(pairs, hot_keys)
                keys, links = keys[~is_hot], np.frombuffer(links, "<u4")[~is_hot]
                if len(keys):
                    columns = [np.full(len(keys), row), (keys >> 32).astype("i4"), (keys & 0xFFFFFFFF).astype("i4"), links.astype("i8")]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "a", "b", "n"])

    links = aligned.select("row", "pairs", "pair_links").mapInArrow(cold, "row long, a int, b int, n long")
    rare = staged(others.filter(F.col("class") < least).select("a", "b", "docs", "best"), "rare")
    sums = links.join(rare, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("_best"), F.sum(F.col("n") * F.col("docs")).alias("_sum")
    )
    more = {
        "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
        "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
    }
    return scored.join(sums, "row", "left").withColumns(more).drop("_best", "_sum")


def align_and_score(docs: DataFrame, a_path: str, b_path: str, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """A row per document: its counts, the digest of its groups and the scores of its links."""
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = align(docs, a_path, b_path).withColumn("groups_sha256", digest).drop("groups")
    aligned = staged(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = staged(link_counts(aligned, a_path, b_path), "counts")
    return score_links(aligned, counts, a_path, b_path, hot_pairs).drop("row")

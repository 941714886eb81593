"""Similarity join of documents on word 5-grams by chosen paths, and classes of near duplicates.

A document is the set of its 5-word shingles; documents with the same set are one set with copies. Each
set is embedded as a MinHash signature, whose entries are its tokens. From a root, every set follows the
tokens that a hash of (path, token) chooses, ``CHILDREN`` of them on average; sets on the same path
share a bucket, and similar sets share chosen tokens. A bucket of at most ``LEAF`` sets is compared
pair by pair on signatures. In a larger one every set is compared with a bounded number of sampled members
(which so have met the whole bucket and leave it, with the sets that nearly equal one of them, whose
links theirs imply); the rest goes on to the bucket's children. Independent runs are repeated until
a pair at the threshold is found with the target probability, which follows from the branching
process: f(0) = 1, f(d) = 1 - exp(-CHILDREN * threshold * f(d - 1)).

Candidate pairs only group the sets: the exact join is then made inside each connected group, pair by pair over the
full shingle sets, with a large group split into blocks whose pairs are separate pieces of work. So a
group's links are complete once it is connected. A task sends on a count of links and a tree of them, never
the pairs.

Defined cases: words are runs of letters, digits and underscores in lower case; a text of one to four words is one
shingle of all of them; a text without words (null, empty) is similar to none and its own class; equal
sets are linked; null ids and repeated rows are documents like others, and a class whose documents all
have null ids has a null id; an empty table gives no rows. Columns may have any names; texts are read whole.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from silvermill.llm.common import located, split_by_keys, staged
from silvermill.llm.components import components
from silvermill.llm.tokens import Generations

WORDS = 5
THRESHOLD = 0.8
TOKENS = 64  # entries of a signature
CHILDREN = 2.0
TARGET_RECALL = 0.9999
DEPTH = 3
LEAF = 256
TILE = 1024  # sets of a block of a bucket that has not come apart
MEMBERS = 16
CANDIDATE = 36  # equal entries of 64; a pair at 0.8 has fewer with probability 4e-6
NEARLY_EQUAL = 61
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 21

_WORD = re.compile(r"\w+")
_RNG = np.random.default_rng(20170619)
_MULTIPLY = _RNG.integers(1 << 63, size=TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1 << 63, size=TOKENS, dtype=np.uint64)
_PLACE = _RNG.integers(1 << 63, size=TOKENS, dtype=np.uint64)
_WEIGHT = _RNG.integers(1 << 63, size=WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 4096

# Small, as it stays in a worker that later steps use too, and a hash is soon computed again.
_HASHES = Generations(lambda word: xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")), 50_000)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Ascending distinct hashes of the text's shingles."""
    words = _WORD.findall(text.lower())
    if not words:
        return np.array([], np.uint64)
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64) * _WEIGHT[WORDS]
    for i in range(size):
        total += _mix(hashes[i : len(words) - size + 1 + i] * _WEIGHT[i])
    return np.unique(_mix(total))


def signature(hashes: np.ndarray) -> np.ndarray:
    least = np.full(TOKENS, 0xFFFFFFFF, np.uint32)
    for first in range(0, len(hashes), _CHUNK):
        part = hashes[first : first + _CHUNK]
        values = (_MULTIPLY[:, None] * part + _ADD[:, None]) >> np.uint64(32)
        np.minimum(least, values.min(1).astype(np.uint32), out=least)
    return least


def runs_needed(threshold: float = THRESHOLD, recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    found = 1.0
    for _ in range(depth):
        found = 1 - math.exp(-CHILDREN * threshold * found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def _signatures(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, TOKENS)


def _choose(paths: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and child paths of the chosen tokens of sets (rows of ``tokens``) on ``paths``."""
    hashed = _mix(tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + _PLACE + _mix(paths)[:, None])
    chosen = hashed < np.uint64(int(CHILDREN / TOKENS * 2.0**64))
    places, _ = np.nonzero(chosen)
    return places, _mix(hashed[chosen] ^ np.uint64(0xD6E8FEB86659FD93))


def embed(rows: DataFrame) -> DataFrame:
    """(file, row, doc_id, key, size, sig) of located documents; key names the set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, sigs = [], [], []
            for text in batch.column(3):
                found = shingles(text.as_py())
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                sigs.append(signature(found).tobytes() if len(found) else None)
            out = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *out], ["file", "row", "doc_id", "key", "size", "sig"]
            )

    schema = "file string, row long, doc_id long, key binary, size long, sig binary"
    return rows.select("file", "row", "doc_id", "text").mapInArrow(run, schema)


def _first_paths(sets: DataFrame, runs: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            tokens = _signatures(batch.column(1))
            for r in range(runs):
                places, paths = _choose(np.full(len(tokens), r + 1, np.uint64), tokens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths.view(np.int64)), batch.column(0).take(pa.array(places))], ["path", "key"]
                )

    return sets.select("key", "sig").mapInArrow(run, "path long, key binary")


def _meet_members(large: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, path) of large buckets: candidate pairs with members (a, b), and the sets (a) that go on
    (path). Members are drawn by a hash of path and set, so that other buckets have other members."""
    draw = Window.partitionBy("path").orderBy(F.xxhash64("path", "key"), "key")
    drawn = large.withColumn("n", F.row_number().over(draw)).filter(F.col("n") <= MEMBERS).select("path", "key")
    members = drawn.join(sets.select("key", "sig"), "key").groupBy("path").agg(
        F.collect_list("key").alias("keys"), F.collect_list("sig").alias("sigs")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            paths = batch.column(0).to_numpy().view(np.uint64)
            keys = batch.column(1).to_pylist()
            tokens = _signatures(batch.column(2))
            a, b, stays = [], [], np.ones(len(keys), bool)
            joined: dict[bytes, bytes] = {}  # members that this batch has connected, as a forest

            def top(name: bytes) -> bytes:
                while joined.get(name, name) != name:
                    name = joined[name]
                return name

            for i, (names, sigs) in enumerate(zip(batch.column(3), batch.column(4))):
                equal = (_signatures(sigs.values) == tokens[i]).sum(1)
                stays[i] = equal.max() < NEARLY_EQUAL
                places = np.flatnonzero(equal >= CANDIDATE)
                if not len(places):
                    continue
                near = [names[int(p)].as_py() for p in places]
                # One link of the set to a member, and those between members that are still missing.
                links = [(keys[i], near[0])]
                for other in near[1:]:
                    if (one := top(near[0])) != (two := top(other)):
                        joined[one] = two
                        links.append((one, two))
                for one, two in links:
                    if one != two:
                        a.append(one)
                        b.append(two)
            rest = np.flatnonzero(stays)
            places, children = _choose(paths[rest], tokens[rest])
            a += [keys[rest[p]] for p in places]
            yield pa.RecordBatch.from_pydict(
                {
                    "a": pa.array(a, pa.binary()),
                    "b": pa.array(b + [None] * len(places), pa.binary()),
                    "path": pa.array([None] * len(b) + children.view(np.int64).tolist(), pa.int64()),
                }
            )

    rows = large.join(members, "path").join(sets.select("key", "sig"), "key")
    return rows.select("path", "key", "sig", "keys", "sigs").mapInArrow(run, "a binary, b binary, path long")


def _runs_of(values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the end."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def _compare_leaves(leaves: DataFrame, sets: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) inside buckets of bounded size, as a tree of each bucket's links."""

    def links(paths: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        root = np.arange(len(paths))
        left, right = [], []
        for shift in range(1, int(np.diff(_runs_of(paths)).max(initial=0))):
            near = np.flatnonzero(paths[:-shift] == paths[shift:])
            for first in range(0, len(near), 1 << 16):
                i = near[first : first + (1 << 16)]
                i = i[(tokens[i] == tokens[i + shift]).sum(1) >= CANDIDATE]
                left.append(i)
                right.append(i + shift)
        i, j = (np.concatenate(x) if x else np.array([], int) for x in (left, right))
        while True:
            least = np.minimum(root[i], root[j])
            before = root.copy()
            np.minimum.at(root, i, least)
            np.minimum.at(root, j, least)
            root = root[root]
            if (root == before).all():
                return root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solve(rows: pa.Table) -> pa.RecordBatch:
            keys = rows["key"].combine_chunks()
            root = links(rows["path"].to_numpy(), _signatures(rows["sig"]))
            other = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([keys.take(pa.array(other)), keys.take(pa.array(root[other]))], ["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            last = _runs_of(rows["path"].to_numpy())[-2] if rows.num_rows else 0
            rest = rows.slice(last)  # its bucket may go on in the next batch
            if last:
                yield solve(rows.slice(0, last))
        if rest is not None and rest.num_rows:
            yield solve(rest)

    rows = leaves.join(sets.select("key", "sig"), "key").select("path", "key", "sig")
    return rows.repartition("path").sortWithinPartitions("path").mapInArrow(run, "a binary, b binary")


def candidates(sets: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """Links (a, b) between sets that probably reach the threshold, enough to connect those that do."""
    active = _first_paths(sets, runs_needed(threshold, recall))
    leaves, pairs = [], []
    for depth in range(1, DEPTH + 1):
        active = staged(active, "paths")
        sizes = active.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")
        shared = staged(active.join(sizes, "path"), "buckets")
        leaves.append(shared.filter(F.col("n") <= LEAF).select("path", "key"))
        large = shared.filter(F.col("n") > LEAF)
        if large.isEmpty():
            break
        if depth == DEPTH:
            # What has not come apart is compared whole, in pairs of blocks.
            blocks = F.ceil(F.col("n") / TILE).cast("int")
            own = F.pmod(F.xxhash64("key"), blocks).cast("int")
            tiled = large.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            pair = F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other"))
            leaves.append(tiled.select(pair.alias("path"), "key"))
            break
        met = staged(_meet_members(large.select("path", "key"), sets), "members")
        pairs.append(met.filter("b is not null").select("a", "b"))
        active = met.filter("path is not null").select("path", F.col("a").alias("key"))
    all_leaves = leaves[0]
    for more in leaves[1:]:
        all_leaves = all_leaves.unionAll(more)
    found = _compare_leaves(all_leaves, sets)
    for more in pairs:
        found = found.unionAll(more)
    return found


def _common(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of two lists of sets."""
    both = rows if rows is columns else rows + columns
    values, places = np.unique(np.concatenate(both), return_inverse=True)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    shared = np.flatnonzero(np.bincount(places, minlength=len(values)) > 1)
    column = np.full(len(values), -1)
    column[shared] = np.arange(len(shared))
    at = column[places]
    owner, at = owner[at >= 0], at[at >= 0]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    total = np.zeros((len(rows), len(columns)), np.float32)
    for first in range(0, len(shared), _CHUNK):
        lo, hi = np.searchsorted(at, [first, first + _CHUNK])
        block = np.zeros((len(both), min(_CHUNK, len(shared) - first)), np.float32)
        block[owner[lo:hi], at[lo:hi] - first] = 1
        total += block[: len(rows)] @ (block if rows is columns else block[len(rows) :]).T
    return total


def _linked(rows: list[np.ndarray], columns: list[np.ndarray], threshold: float) -> np.ndarray:
    """By pair, whether the Jaccard similarity of two sets reaches the threshold."""
    common = _common(rows, columns).astype("f8")
    sizes = np.array([len(s) for s in rows])[:, None] + np.array([len(s) for s in columns])
    return common * (1 + threshold) >= threshold * sizes - 1e-9


def _solve(own: np.ndarray, sets: list[np.ndarray], copies: np.ndarray, threshold: float, diagonal: bool):
    """Per set, the number of documents it is linked to in this piece of work, and a root of its links."""
    if diagonal:
        linked = _linked(sets, sets, threshold)
        np.fill_diagonal(linked, False)
        i, j = np.nonzero(linked)
    else:
        first = np.flatnonzero(own)
        second = np.flatnonzero(~own)
        if not len(first) or not len(second):
            i = j = np.array([], int)
        else:
            p, q = np.nonzero(_linked([sets[x] for x in first], [sets[x] for x in second], threshold))
            i, j = np.concatenate([first[p], second[q]]), np.concatenate([second[q], first[p]])
    count = np.bincount(i, copies[j], len(sets)).astype("i8")
    root = np.arange(len(sets))
    while True:
        before = root.copy()
        np.minimum.at(root, i, before[j])
        root = root[root]
        if (root == before).all():
            return count, root


def _verify(work: DataFrame, threshold: float) -> DataFrame:
    """(key, root, links, split) per set and piece of work; ``work`` has group, one, two (blocks), block, key, copies,
    split and hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def solve(rows: pa.Table) -> pa.RecordBatch:
            keys, out = rows["key"].combine_chunks(), []
            copies, pieces = rows["copies"].to_numpy(), rows["piece"].to_numpy()
            own, diagonal = rows["own"].to_numpy(zero_copy_only=False), rows["diagonal"].to_numpy(zero_copy_only=False)
            hashes = rows["hashes"].combine_chunks()
            ends = _runs_of(pieces)
            counts, roots = [], []
            for a, b in zip(ends[:-1], ends[1:]):
                sets = [np.frombuffer(h.as_py(), "<u8") for h in hashes[a:b]]
                count, root = _solve(own[a:b], sets, copies[a:b], threshold, bool(diagonal[a]))
                counts.append(count)
                roots.append(root + a)
            out = [keys, keys.take(pa.array(np.concatenate(roots))), pa.array(np.concatenate(counts))]
            return pa.RecordBatch.from_arrays([*out, rows["split"].combine_chunks()], ["key", "root", "links", "split"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest is not None else rows
            last = _runs_of(rows["piece"].to_numpy())[-2] if rows.num_rows else 0
            rest = rows.slice(last)
            if last:
                yield solve(rows.slice(0, last))
        if rest is not None and rest.num_rows:
            yield solve(rest)

    ordered = work.repartition("piece").sortWithinPartitions("piece", "key")
    return ordered.mapInArrow(run, "key binary, root binary, links long, split boolean")


def _hashes(rows: DataFrame) -> DataFrame:
    """(key, hashes) of located rows with a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [shingles(text.as_py()).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["key", "hashes"])

    return rows.select("key", "text").mapInArrow(run, "key binary, hashes binary")


def classes(
    rows: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL
) -> DataFrame:
    """(file, row, doc_id, root, class_id, n_links, class_size) of located documents: class_id is the least doc_id
    of the documents that links connect, root a set among them (null for a document without words), n_links the
    number of other documents at or over the threshold."""
    docs = staged(embed(rows), "signatures")
    sets = docs.filter("key is not null").groupBy("key", "sig", "size").agg(
        F.count("*").alias("copies"), F.min("doc_id").alias("first"), F.min(F.struct("file", "row")).alias("place")
    )
    sets = staged(sets, "sets")
    groups = components(candidates(sets, threshold, recall)).select(F.col("node").alias("key"), F.col("root").alias("group"))

    # The exact join inside groups, over the shingles of one document of each set.
    grouped = staged(groups.join(sets.drop("sig"), "key"), "groups")
    sizes = grouped.groupBy("group").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks")
    )
    places = grouped.select("key", F.col("place.file").alias("file"), F.col("place.row").alias("row"))
    _, texts = split_by_keys(rows.select("file", "row", "text"), places, "file", "row")
    hashes = staged(_hashes(texts.join(places, ["file", "row"])), "shingles")
    work = grouped.select("key", "group", "copies").join(sizes, "group").withColumn(
        "block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    )
    work = work.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    one, two = F.least("block", "other"), F.greatest("block", "other")
    work = work.select(
        F.xxhash64("group", one, two).alias("piece"), (F.col("block") == one).alias("own"), (one == two).alias("diagonal"),
        "key", "copies", (F.col("blocks") > 1).alias("split"),
    )
    solved = staged(_verify(work.join(hashes, "key"), threshold), "links")

    links = solved.groupBy("key").agg(F.sum("links").alias("links"))
    whole = solved.filter(~F.col("split")).select("key", "root")
    parts = components(solved.filter("split").select(F.col("key").alias("a"), F.col("root").alias("b")))
    roots = whole.unionAll(parts.select(F.col("node").alias("key"), "root"))
    linked = links.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    # Sets that no candidate touched are their own class.
    named = staged(
        sets.select("key", "copies", "first").join(linked, "key", "left")
        .select("key", "copies", "first", F.coalesce("root", "key").alias("root"), F.coalesce("links", F.lit(0)).alias("links")),
        "roots",
    )
    totals = named.groupBy("root").agg(F.min("first").alias("class_id"), F.sum("copies").alias("class_size"))
    named = named.join(totals, "root").select(
        "key", "root", "class_id", "class_size", (F.col("links") + F.col("copies") - 1).alias("n_links")
    )
    out = docs.select("file", "row", "doc_id", "key").join(named, "key", "left")
    no_key = F.col("key").isNull()
    return out.select(
        "file", "row", "doc_id", "root",
        F.when(no_key, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, class_id, n_links and class_size of every document."""
    return classes(located(docs, id_col, text_col), **options).drop("file", "row", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, the one with the least id, with the columns it came with."""
    rows = located(docs, id_col, text_col)
    found = staged(classes(rows, **options).filter("class_size > 1"), "near-classes")
    # Of rows that repeat the least id (or all lack one), the first by file and row stays.
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "file", "row")
    firsts = found.groupBy("root").agg(F.min(place).alias("kept"))
    dropped = found.join(firsts, "root").filter(place != F.col("kept"))
    dropped = staged(dropped.select("file", "row"), "near-dropped")
    sure, doubtful = split_by_keys(rows, dropped, "file", "row")
    return sure.unionAll(doubtful.join(dropped, ["file", "row"], "left_anti").select(*rows.columns)).select("doc.*")

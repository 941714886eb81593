"""Token-id output: flat unsigned integers, 64-bit document offsets, bases by prefix sums.

A folder holds, per shard, ``<shard>.bin`` (ids of all its documents one after another, 16 bits each
when the vocabulary allows, else 32), ``<shard>.off`` (64-bit start of each document in the shard,
then the end) and ``<shard>.doc`` (64-bit document ids). ``manifest`` is a small Parquet table with a
row per shard: its numbers of documents and ids and the sums of these over the shards before it.
A folder without a scheme is taken for what Spark takes it for, the default file system.

Shards hold ascending ranges of document ids. A task goes on to another shard when one has ``shard_bytes`` of
ids, so a shard is no larger than that and one document. Rows of one id are split over tasks too. Writing one is idempotent: a task writes files under
a name of its own and then moves them to the shard's name, so a repeated or speculative task leaves
the same bytes. Defined cases: a null text counts as empty and gives the end id alone; null ids
come first (``null_docs`` counts them; they take 0 in ``.doc``); rows that repeat an id stay, in order
of the first characters of their texts and then of a hash; an empty table gives a manifest without rows. Other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text, new_folder
from silvermill.llm.tokens import encoder
from silvermill.storage import qualified

_SHARD = "shard string, docs long, tokens long, null_docs long, width int"
_SHARD_FIELDS = pa.schema(
    [("shard", pa.string()), *((n, pa.int64()) for n in ("docs", "tokens", "null_docs")), ("width", pa.int32())]
)
_MANIFEST = f"{_SHARD}, docs_before long, tokens_before long"
_READ_ROWS = 8192
READ_BYTES = 1 << 23  # of ids that a reader asks a store for at a time, unless one document has more
SHARD_BYTES = 1 << 29
_PREFIX = 32  # characters of a text that rows of one id are dealt and ordered by first


def _store(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    uri = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    if uri.startswith("file:"):  # file:/x, file:///x
        return pyarrow.fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


class _Writer:
    """The shards of one task, one open at a time, each written under a name of its own first."""

    def __init__(self, folder: str, task: int, dtype: np.dtype, shard_bytes: int):
        self.fs, self.root = _store(folder)
        self.task, self.dtype, self.shard_bytes = task, dtype, shard_bytes
        self.written = 0
        self.out = None

    def add(self, doc_id: int | None, data: bytes) -> Iterator[dict]:
        """Append a document; the manifest's row of a shard that this fills."""
        if self.out is None:
            self.shard = f"{self.task:08d}-{self.written:06d}"
            self.draft = f"{self.root}/_draft-{self.shard}-{uuid.uuid4().hex}"
            self.offsets, self.ids, self.nulls = array("q", [0]), array("q"), 0
            self.fs.create_dir(self.root, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.draft}.bin")
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data) // self.dtype.itemsize)
        self.ids.append(doc_id or 0)
        self.nulls += doc_id is None
        if self.offsets[-1] * self.dtype.itemsize >= self.shard_bytes:
            yield from self.close()

    def close(self) -> Iterator[dict]:
        if self.out is None:
            return
        self.out.close()
        for kind, values in (("off", self.offsets), ("doc", self.ids)):
            with self.fs.open_output_stream(f"{self.draft}.{kind}") as f:
                f.write(np.asarray(values, "<i8").tobytes())
        for kind in ("bin", "off", "doc"):
            self.fs.move(f"{self.draft}.{kind}", f"{self.root}/{self.shard}.{kind}")
        yield {
            "shard": self.shard, "docs": len(self.ids), "tokens": self.offsets[-1], "null_docs": self.nulls,
            "width": self.dtype.itemsize,
        }
        self.out = None
        self.written += 1


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> None:
    """Encode every document, append ``end_id``, and write the shards and their manifest to ``folder``."""
    spark = docs.sparkSession
    folder = qualified(spark, folder)

    def write_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, (end_id,))
        end = enc.one(end_id)
        writer = _Writer(folder, TaskContext.get().partitionId(), enc.dtype, shard_bytes)

        def written() -> Iterator[dict]:
            for batch in batches:
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    yield from writer.add(doc_id, enc.encode(text.as_py()) + end)
            yield from writer.close()

        for shard in written():
            yield pa.RecordBatch.from_pylist([shard], _SHARD_FIELDS)

    # Equal rows may lie in any order, so the rows' places in the input deal them out.
    order = ("doc_id", "_prefix", "_hash")
    rows = id_and_text(docs, id_col, text_col).withColumns(
        {"_prefix": F.substring("text", 1, _PREFIX), "_hash": F.xxhash64("text"), "_place": F.monotonically_increasing_id()}
    )
    ordered = rows.repartitionByRange(*order, "_place").sortWithinPartitions(*order, "text").select("doc_id", "text")
    shards = sorted(tuple(r) for r in ordered.mapInArrow(write_shards, _SHARD).collect())  # a row per shard
    docs_before = accumulate((s[1] for s in shards), initial=0)
    tokens_before = accumulate((s[2] for s in shards), initial=0)
    rows = [(*s, d, t) for s, d, t in zip(shards, docs_before, tokens_before)]
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")


def map_shard(folder: str, shard: str, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, offsets and document ids of a shard, for a training process: views of the mapped files where the folder
    is mounted, which a path without a scheme is taken to be; read whole from a remote store."""
    fs, root = _store(folder)

    def view(kind: str, dtype: str) -> np.ndarray:
        path = f"{root}/{shard}.{kind}"
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            return np.memmap(path, dtype, "r")
        with fs.open_input_file(path) as f:
            return np.frombuffer(f.read_buffer(), dtype)

    return view("bin", f"<u{width}"), view("off", "<i8"), view("doc", "<i8")


class _Slices:
    """``slices[a:b]`` of a file of numbers: of its mapping, or read from a remote store by range."""

    def __init__(self, folder: str, name: str, dtype: str):
        fs, root = _store(folder)
        self.dtype = np.dtype(dtype)
        if isinstance(fs, pyarrow.fs.LocalFileSystem):
            self.mapped, self.file = np.memmap(f"{root}/{name}", dtype, "r"), None
        else:
            self.mapped, self.file = None, fs.open_input_file(f"{root}/{name}")

    def __getitem__(self, part: slice) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[part]
        size = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((part.stop - part.start) * size, part.start * size), self.dtype)


def _windows(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``most`` ids together, or of one document with more."""
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = max(first + 1, last)
        yield first, last
        first = last


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document from the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    folder = qualified(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                kinds = (("bin", f"<u{row['width']}"), ("off", "<i8"), ("doc", "<i8"))
                ids, offsets, docs = (_Slices(folder, f"{row['shard']}.{kind}", dtype) for kind, dtype in kinds)
                for first in range(0, row["docs"], _READ_ROWS):
                    last = min(first + _READ_ROWS, row["docs"])
                    at = offsets[first : last + 1]
                    checks = []
                    for one, end in _windows(at, READ_BYTES // row["width"]):
                        held = ids[int(at[one]) : int(at[end])]
                        near = at[one : end + 1] - at[one]
                        checks += [zlib.crc32(held[a:b].astype("<u4").tobytes()) for a, b in zip(near[:-1], near[1:])]
                    nulls = np.arange(first, last) < row["null_docs"]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(docs[first:last], pa.int64(), mask=nulls),
                            "start": pa.array(at[:-1] + row["tokens_before"], pa.int64()),
                            "n_tokens": pa.array(np.diff(at), pa.int64()),
                            "ids_crc32": pa.array(checks, pa.int64()),
                        }
                    )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    shards = read_manifest(spark, folder)
    # A task per shard; the manifest has a row per shard, so the count is of a handful of files.
    return shards.repartition(max(1, shards.count())).mapInArrow(read, schema)


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files of ``docs`` to the shared folder and read them back."""
    folder = new_folder(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(docs.sparkSession, folder)

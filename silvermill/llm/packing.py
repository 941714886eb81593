"""Cost-balanced packing of documents into sequences of a fixed token capacity.

A piece of n tokens costs ``linear * n + quadratic * n**2`` (projections, attention inside the piece).
Longest documents first, each is put into the sequence of the lowest cost so far that has capacity
left; what does not fit there is cut off and queued again by its length. Sequences are opened for
exactly the tokens there are: as many of full capacity as they fill, and one for every power of
two in the remainder, so that nothing is padded.

Every task packs its own part of the table, in blocks of at most ``block_tokens`` (plus one document),
so nothing is shuffled and a repeated task gives the same rows. Sequence ids are the task's number
times 2**33 plus a running number. Defined cases: a null text counts as empty and gives the end id
alone; null ids and repeated rows are documents like others; equal lengths go by position in the
input; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from silvermill.llm.common import id_and_text
from silvermill.llm.tokens import encoder

CAPACITY = 2048
BLOCK_TOKENS = 1 << 22
LINEAR = 1.0
QUADRATIC = 1 / (6 * 4096)  # attention against projections in a model of width 4096

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long,"
    " sequence_tokens long"
)


def capacities(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Full sequences, then descending powers of two, in sum exactly ``tokens``."""
    full, rest = divmod(tokens, capacity)
    return [capacity] * full + [1 << bit for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]


def pack(
    lengths: list[int], capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC
) -> tuple[list[tuple[int, int, int, int, int]], list[int]]:
    """Pieces (document, start, length, sequence, offset) of documents with these lengths, and the
    capacity of each sequence. All sequences end up full."""
    room = capacities(sum(lengths), capacity)
    # Full sequences are open from the start, shorter ones take what is left, longest first.
    full = sum(c == capacity for c in room)
    open_ = [(0.0, s) for s in range(full)]
    short = iter(range(full, len(room)))
    used = [0] * len(room)
    waiting = [(-n, doc, 0) for doc, n in enumerate(lengths) if n]
    heapq.heapify(waiting)
    pieces = []
    while waiting:
        rest, doc, start = heapq.heappop(waiting)
        cost, seq = heapq.heappop(open_) if open_ else (0.0, next(short))
        n = min(-rest, room[seq] - used[seq])
        pieces.append((doc, start, n, seq, used[seq]))
        used[seq] += n
        if used[seq] < room[seq]:
            heapq.heappush(open_, (cost + linear * n + quadratic * n * n, seq))
        if n < -rest:
            heapq.heappush(waiting, (rest + n, doc, start + n))
    return pieces, room


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = CAPACITY,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
    block_tokens: int = BLOCK_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """A row per piece: its document, place there, check sum of its ids, sequence and place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, (end_id,))
        end = enc.one(end_id)
        next_sequence = TaskContext.get().partitionId() << 33
        ids: list[int | None] = []
        data: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            nonlocal next_sequence
            lengths = [len(d) // enc.dtype.itemsize for d in data]
            pieces, room = pack(lengths, capacity, linear, quadratic)
            doc, start, length, seq, offset = (np.array(c, "i8") for c in zip(*pieces))
            wide = [np.frombuffer(d, enc.dtype).astype("<u4") for d in data]
            checks = [zlib.crc32(wide[d][s : s + n]) for d, s, n, _, _ in pieces]
            out = pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids, pa.int64()).take(pa.array(doc)),
                    "start": start,
                    "length": length,
                    "ids_crc32": pa.array(checks, pa.int64()),
                    "doc_tokens": np.array(lengths, "i8")[doc],
                    "sequence_id": seq + next_sequence,
                    "offset": offset,
                    "sequence_tokens": np.array(room, "i8")[seq],
                }
            )
            next_sequence += len(room)
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc_id)
                data.append(enc.encode(text.as_py()) + end)
                size += len(data[-1]) // enc.dtype.itemsize
                if size >= block_tokens:
                    yield block()
                    ids, data, size = [], [], 0
        if data:
            yield block()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, PIECES)

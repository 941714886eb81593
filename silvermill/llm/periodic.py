"""Runs of words: stretches that repeat with a period, found by catching squares as words are appended.

Words are what stands between blanks and the ASCII control characters from tab to carriage return. A run is
a stretch with smallest period q, at least 2q words long and at least ``least``, that no neighbouring word
extends. ``SquareCatcher`` reads one word after the other. For every power of two B it keeps the last
completed blocks of B words; the catcher of a block listens for the block to come again at a distance of
2B-1 to 4B-2, by its last words. Any square of such a period holds one of these blocks in its first half,
so the block is met again before the square ends. Then the common suffix of both places gives where the
stretch starts, and it becomes a run once it has grown to two periods without a mismatch; runs that are
open advance word by word. Only four blocks per power of two listen at a time, and a period that an open
run already explains is not followed again.

All that recurs in a run recurs as six words: stretches of a document that no repeated six words cover are
not given to the catcher. That test is one sort of hashes for many documents at once.

Defined cases: a null text has no words; no words give no runs and an empty collapsed text. Null ids and
repeated rows are documents like others. Runs are ordered by start, then period; of equally long ones
the first in that order is the longest. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from array import array
from collections import deque
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text

LEAST = 12
GRAM = 6  # words that recur in every run of at least LEAST words
BATCH_BYTES = 1 << 20

RUNS = "array<struct<start:long,length:long,period:long>>"


@dataclass(slots=True, eq=False)
class Run:
    start: int
    period: int
    stop: int = -1  # the place behind its last word, once that is known
    earlier: list[Run] = field(default_factory=list)  # runs of its period that it may have its end in common with


class SquareCatcher:
    """Runs of a sequence of integers below 2**31 that is appended one by one."""

    def __init__(self, least: int = LEAST):
        self.least = least
        self.words: list[int] = []
        self.packed = array("i")
        self.open: dict[int, Run] = {}  # by period: the run that reaches the last word
        self.due: dict[int, list[tuple[int, int, int]]] = {}  # place -> stretches that must have lasted until there
        self.followed: set[tuple[int, int]] = set()
        self.found: dict[tuple[int, int], int] = {}  # (start, stop) -> smallest period
        # By the number of last words that are listened for: those words -> blocks.
        self.listening: dict[int, dict[tuple, list[tuple]]] = {1: {}, 2: {}, 4: {}, GRAM: {}}
        # By power of two, oldest first: (size, last place, last words, the run it lies in if that has a short period).
        self.blocks: list[deque] = []

    def append(self, word: int) -> None:
        words, at = self.words, len(self.words)
        words.append(word)
        self.packed.append(word)
        if self.open:
            for period in [p for p in self.open if words[at - p] != word]:
                self._ended(self._close(period, at))
        if at in self.due:
            for period, start, seen in self.due.pop(at):
                self.followed.discard((period, start))
                if self._same(seen + 1, at + 1, period):
                    self.open.setdefault(period, Run(start, period))
        for size, listeners in self.listening.items():
            if listeners and (blocks := listeners.get(tuple(words[-size:]))):
                for size, end, _, run in blocks:
                    if 2 * size - 1 <= at - end <= 4 * size - 2:
                        self._met(size, end, run, at)
        self._complete(at)

    def _met(self, size: int, end: int, run: Run | None, at: int) -> None:
        """The last words of a block stand at ``at`` again."""
        period = at - end
        here = self.open.get(run.period) if run else None
        if here and here.start <= at - size + 1:
            if here is run:
                return
            # Both places lie in runs of one period: unless these begin or end together, what they have in
            # common begins where one of them does, and ends with the first at the latest.
            if run.start + period != here.start and run.stop - max(run.start, here.start - period) < period:
                if run not in here.earlier:
                    here.earlier.append(run)
                return
        for open_run in self.open.values():
            if period % open_run.period == 0 and open_run.start <= end - size + 1:
                return
        common = self._common_suffix(end, at)
        if common >= size:
            self._follow(period, at + 1 - common - period, at)

    def _follow(self, period: int, start: int, seen: int) -> None:
        """A stretch with this period lasts until ``seen``: it is a run if it goes on until it is long enough."""
        until = start + max(2 * period, self.least) - 1
        if until <= seen:
            self.open.setdefault(period, Run(start, period))
        elif (period, start) not in self.followed:
            self.followed.add((period, start))
            self.due.setdefault(until, []).append((period, start, seen))

    def _ended(self, run: Run) -> None:
        """What an earlier run of the same period and the one that has just ended have in common may go on."""
        at = len(self.words) - 1
        for before in run.earlier:
            if self.words[before.stop] == self.words[at]:
                period = run.stop - before.stop
                self._follow(period, at + 1 - self._common_suffix(before.stop, at) - period, at)

    def _same(self, start: int, stop: int, period: int) -> bool:
        return self.packed[start:stop] == self.packed[start - period : stop - period]

    def _common_suffix(self, left: int, right: int) -> int:
        """How many words up to and with ``left`` equal those up to ``right``, by doubling steps and then halving."""
        packed, n, step, grows = self.packed, 0, 8, True
        while step:
            i, j = left - n + 1, right - n + 1
            if step <= i and packed[i - step : i] == packed[j - step : j]:
                n += step
                step = 2 * step if grows else step // 2
            else:
                grows, step = False, step // 2
        return n

    def _complete(self, at: int) -> None:
        """Blocks that end here begin to listen, those too far behind stop."""
        size, power = 1, 0
        while (at + 1) % size == 0 and size <= at + 1:
            if power == len(self.blocks):
                self.blocks.append(deque())
            alive = self.blocks[power]
            listeners = self.listening[min(size, GRAM)]
            while alive and at - alive[0][1] >= 4 * size - 2:
                old = alive.popleft()
                others = listeners[old[2]]
                others.remove(old)
                if not others:
                    del listeners[old[2]]
            inside = (r for r in self.open.values() if 2 * r.period <= size and r.start <= at - size + 1)
            block = (size, at, tuple(self.words[-min(size, GRAM) :]), next(inside, None))
            alive.append(block)
            listeners.setdefault(block[2], []).append(block)
            size, power = 2 * size, power + 1

    def _close(self, period: int, stop: int) -> Run:
        run = self.open.pop(period)
        run.stop = stop
        place = (run.start, stop)
        self.found[place] = min(period, self.found.get(place, period))
        return run

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period. The sequence ends here."""
        for period in list(self.open):
            self._close(period, len(self.words))
        return sorted((start, stop - start, period) for (start, stop), period in self.found.items())


def runs_of(words: Sequence, least: int = LEAST) -> list[tuple[int, int, int]]:
    catcher, ids = SquareCatcher(least), {}
    for word in words:
        catcher.append(ids.setdefault(word, len(ids)))
    return catcher.runs()


def repeating_stretches(documents: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int]]]:
    """(start, stop) of the stretches of each document that repeated grams cover, if as long as a run."""
    lengths = np.array([len(words) for words in documents], "i8")
    total = int(lengths.sum())
    found: list[list[tuple[int, int]]] = [[] for _ in documents]
    if total < GRAM:
        return found
    hashes = np.fromiter((hash(word) for words in documents for word in words), "i8", total).view("u8")
    doc = np.repeat(np.arange(len(documents)), lengths)
    grams = np.zeros(total - GRAM + 1, "u8")
    for i in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + hashes[i : total - GRAM + 1 + i]
        grams ^= grams >> np.uint64(29)
    grams += doc[: len(grams)].astype("u8") * np.uint64(0xD6E8FEB86659FD93)
    whole = np.flatnonzero(doc[: len(grams)] == doc[GRAM - 1 :])
    grams = grams[whole]
    ordered = np.sort(grams)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return found
    starts = whole[np.isin(grams, repeated)]
    covered = np.zeros(total + 1, "i8")
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + GRAM, -1)
    inside = np.cumsum(covered)[:-1] > 0
    first = np.concatenate([[0], np.cumsum(lengths)])
    edge = np.diff(np.concatenate([[0], inside.view("i1"), [0]]))
    begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for begin, stop in zip(begins.tolist(), stops.tolist()):
        d = int(doc[begin])
        while begin < stop:  # neighbouring documents may both be covered to their common edge
            end = min(stop, int(first[d + 1]))
            if end - begin >= least:
                found[d].append((begin - int(first[d]), end - int(first[d])))
            begin, d = end, d + 1
    return found


def collapse(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds behind its first period, joined by blanks."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join(words[i] for i in np.flatnonzero(kept).tolist())


def periodic_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its runs and its text without their repetitions. ``least`` is at least 12."""
    if least < 2 * GRAM:
        raise ValueError(f"runs of fewer than {2 * GRAM} words need not repeat {GRAM} words")

    def done(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
        runs, texts = [], []
        for words, stretches in zip(documents, repeating_stretches(documents, least)):
            own = [(begin + s, n, p) for begin, stop in stretches for s, n, p in runs_of(words[begin:stop], least)]
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in own])
            texts.append(collapse(words, own).decode())
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        columns = [pa.array(ids, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, documents, size = [], [], 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0).to_pylist(), texts):
                data = text.as_py()
                ids.append(doc_id)
                documents.append(data.split())  # of bytes: at ASCII white space only
                size += len(data)
                if size >= BATCH_BYTES:
                    yield done(ids, documents)
                    ids, documents, size = [], [], 0
        if ids:
            yield done(ids, documents)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def digests(found: DataFrame) -> DataFrame:
    """A row per document of ``periodic_runs``: number of runs, the longest one, digests of runs and text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.s")).alias("start"),
        F.col("_best.n").alias("length"),
        (-F.col("_best.p")).alias("period"),
        F.expr("1000 * _best.n div -_best.p").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): in every document whose check sum of the id is divisible by ten, the words from some place on
    become copies of those that follow it. Place, period and number of copies follow from the check sum."""
    rows = id_and_text(docs, id_col, text_col)
    rows = rows.withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = F.coalesce(F.col("_h") % 10 == 0, F.lit(False))
    rows = rows.withColumn("_words", F.when(chosen, words)).withColumn("_n", F.size("_words"))
    rows = rows.withColumn("_g", F.expr("_h div 10")).withColumn("_a", F.expr("case when _n > 0 then _g % _n end"))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    head = F.slice("_words", F.lit(1), F.col("_a").cast("int"))
    period = F.slice("_words", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int"))
    copies = F.expr("1 + (_n - _a) div _p").cast("int")
    tail = F.slice(F.flatten(F.array_repeat(period, copies)), F.lit(1), (F.col("_n") - F.col("_a")).cast("int"))
    planted = F.array_join(F.concat(head, tail), " ")
    return rows.select("doc_id", F.when(F.col("_n") > 0, planted).otherwise(F.col("text")).alias("text"))

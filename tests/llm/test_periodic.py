"""Runs of words against a comparison of every word with the one a period before, for every period."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from silvermill.llm import bindings
from silvermill.llm.periodic import SquareCatcher, digests, periodic_runs, repeating_stretches, runs_of, with_planted_periods
from tests.llm.conftest import SF


def brute_runs(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def brute_row(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n > 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * best[1] // best[2] if runs else None
    return (
        doc_id, len(runs), *best, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def sequences():
    """Few letters, periodic tails, and long runs of short periods with breaks at equal and other distances."""
    rng = random.Random(4)
    for _ in range(2500):
        n = rng.randint(0, 90)
        words = [rng.randrange(rng.choice([1, 2, 2, 3, 4])) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        yield words
    for _ in range(1500):
        root, words = [[1], [1, 2], [1, 1, 2], [1, 2, 1, 3]][rng.randrange(4)], []
        sizes = [rng.randint(1, 40) for _ in range(2)]
        for _ in range(rng.randint(2, 6)):
            piece = root * 40
            shift = rng.randrange(len(root))
            words += piece[shift : shift + rng.choice(sizes)] + rng.choice([[], [9], [9], [8, 9]])
        yield words


def test_catcher_finds_all_runs():
    for words in sequences():
        assert runs_of(words) == brute_runs(words), words


def test_stretches_without_recurring_words_hold_no_run():
    several = [[b"%d" % w for w in words] for words in sequences()]
    for words, stretches in zip(several, repeating_stretches(several)):
        got = sorted((begin + s, n, p) for begin, stop in stretches for s, n, p in runs_of(words[begin:stop]))
        assert got == brute_runs(words), words


def test_runs_are_known_while_words_come():
    catcher = SquareCatcher()
    for word in [7, 8, *[1, 2, 3] * 6, 9, 9]:
        catcher.append(word)
        if len(catcher.words) == 14:  # 12 words of the run
            assert min(catcher.open) == 3 and catcher.open[3].start == 2
    assert catcher.found == {(2, 20): 3}


def test_few_blocks_listen():
    catcher, rng = SquareCatcher(), random.Random(8)
    for _ in range(20_000):
        catcher.append(rng.randrange(50))
        assert sum(map(len, catcher.blocks)) <= 5 * len(catcher.blocks)
    assert sum(len(blocks) for held in catcher.listening.values() for blocks in held.values()) <= 5 * 15


def test_op12_query(spark, documents):
    expected = sorted((brute_row(*row) for row in documents), key=str)
    assert rows_of(bindings.QUERIES["op12_periodic_runs"](spark, SF)) == expected
    assert sum(r[1] for r in expected) > 10


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect() if len(r.text or "") < 1000]
    got = rows_of(digests(periodic_runs(with_planted_periods(odd))))
    assert set(got) >= {brute_row(*row) for row in rows} and len(got) == odd.count()
    long = next(r for r in rows_of(digests(periodic_runs(odd))) if r[0] == 4)
    assert long[1:6] == (1, 0, 100_000, 5, 20_000_000)
    assert long[7] == sha("lorem ipsum dolor sit amet")
    assert rows_of(digests(periodic_runs(empty))) == []


def test_white_space_is_ascii_only(spark):
    text = "a b  x\x85y\x1cz\t\x0b\x0c\r\n" * 12
    docs = spark.createDataFrame([(10, text), (None, text)], "doc_id long, text string")
    assert rows_of(digests(periodic_runs(docs))) == sorted((brute_row(i, text, plant=False) for i in (10, None)), key=str)
    planted = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    docs = spark.createDataFrame([(i, text + " q r s") for i in planted], "doc_id long, text string")
    assert rows_of(digests(periodic_runs(with_planted_periods(docs)))) == sorted((brute_row(i, text + " q r s") for i in planted), key=str)


def test_shorter_runs_than_grams_allow_are_refused(spark, odd):
    with pytest.raises(ValueError):
        periodic_runs(odd, least=8)

"""Token files, packing and the codec against the tokenizers library."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from itertools import accumulate

import numpy as np
import public_tokenizers
import pyarrow.fs
import pytest
from tokenizers import Tokenizer

from silvermill.llm import bindings, token_files
from silvermill.llm.bpe import Codec, digests, encode_and_decode
from silvermill.llm.packing import capacities, pack, pack_documents
from silvermill.llm.token_files import map_shard, read_manifest, read_token_files, token_file_digests, write_token_files
from silvermill.llm.tokens import Encoder, Generations
from tests.llm.conftest import SF

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = list(" \n\t'sdtreaéßΣİＡ½Ⱥſ漢😀\r\x85\xa0_-!?.,<>/\x00\x1c²") + [
    "<|endoftext|>", "<|startoftext|>", "</w>", "  ", " \n", "'s", "'LL", "th", "tion", "the", "aaaa", "....",
]


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def texts():
    rng = random.Random(5)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(8000)]


def test_pieces_give_the_ids_of_the_whole_text(documents):
    encoder, whole = Encoder(BYTES), Tokenizer.from_file(BYTES)
    for text in [*texts(), *(t for _, t in documents)]:
        got = np.frombuffer(encoder.encode(text), encoder.dtype).tolist()
        assert got == whole.encode(text, add_special_tokens=False).ids, repr(text)


def test_backtracking_gives_the_merges(documents):
    codec, whole = Codec(WORDS), Tokenizer.from_file(WORDS)
    for text in [*texts(), *(t for _, t in documents)]:
        ids = whole.encode(text, add_special_tokens=False).ids
        got = codec.encode(text)
        assert got.tolist() == ids, repr(text)
        assert codec.decode(got) == whole.decode(ids, skip_special_tokens=False)


def naive(codec: Codec, word: str) -> list[int]:
    """Merging the best pair, leftmost first, again and again."""
    v = codec.vocabulary
    single = {v_: t for t, v_ in ((t, c) for t, c in content(v).items() if t not in v.parts)}
    letters = [*word[:-2], word[-2:]]
    tokens = [single[c] for c in letters]
    while True:
        ranked = [(v.merges[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in v.merges]
        if not ranked:
            return tokens
        rank, i = min(ranked)
        merged = next(t for t, parts in v.parts.items() if v.rank[t] == rank and parts == tuple(tokens[i : i + 2]))
        tokens[i : i + 2] = [merged]


def content(v) -> dict[int, str]:
    found = {}
    for word, token in v.automaton.items():
        found[token] = word
    return found


def test_hard_words_against_plain_merging():
    codec, rng = Codec(WORDS), random.Random(2)
    for _ in range(60):
        word = "".join(rng.choices("aehinrst", k=rng.randint(1, 12))) + "Ā"
        assert codec.vocabulary.encode_word(word) == naive(codec, word), word


def test_a_cache_that_forgets_gives_the_same():
    calls = []
    cache = Generations(lambda w: calls.append(w) or w.upper(), size=3)
    assert [cache[w] for w in "abcabcdefgabc"] == list("ABCABCDEFGABC")
    assert len(cache) <= 3 and len(cache.old) <= 3
    assert cache["x" * 100] == "X" * 100 and "x" * 100 not in cache


def test_op3_query(spark, documents):
    whole, start, want = Tokenizer.from_file(BYTES), 0, []
    for doc_id, text in sorted(documents):
        ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
        want.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    got = bindings.QUERIES["op3_token_files"](spark, SF)
    assert sorted(map(tuple, got.select("doc_id", "start", "n_tokens", "ids_crc32").collect())) == want


def test_token_files(spark, odd, folder):
    write_token_files(odd, folder + "/f", BYTES, 2)
    whole = Tokenizer.from_file(BYTES)
    shards = read_manifest(spark, folder + "/f").orderBy("shard").collect()
    assert [s.docs_before for s in shards][0] == 0 and sum(s.docs for s in shards) == 11 and shards[0].width == 2
    flat = []
    for s in shards:
        ids, offsets, docs = map_shard(folder + "/f", s.shard, s.width)
        assert isinstance(ids, np.memmap) and len(offsets) == s.docs + 1 and len(docs) == s.docs
        assert s.tokens_before == len(flat)
        flat += ids.tolist()
    rows = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    assert flat == [t for r in rows for t in [*whole.encode(r.text or "", add_special_tokens=False).ids, 2]]
    back = read_token_files(spark, folder + "/f").collect()
    assert sorted(r.doc_id or 0 for r in back) == sorted(r.doc_id or 0 for r in rows)
    assert {r.doc_id: r.start for r in back}[None] == 0
    assert {r.n_tokens for r in back if r.doc_id in (2, 3, 10)} == {1}


def test_shards_are_bounded_and_a_hot_id_is_split(spark, folder, monkeypatch):
    monkeypatch.setattr(token_files, "READ_BYTES", 512)
    rng = random.Random(4)
    words = ["one", "two", "three", "four", "five", "six"]
    rows = [(7, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(300)]
    rows += [(None, "the same text")] * 300 + [(i, f"number {i}") for i in range(300)] + [(8, "long " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as tables of this size are one task else
    try:
        write_token_files(df, folder + "/s", BYTES, 2, shard_bytes=2000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    shards = read_manifest(spark, folder + "/s").orderBy("shard").collect()
    tasks: dict = {}
    flat, held = [], []
    for s in shards:
        ids, offsets, docs = map_shard(folder + "/s", s.shard, s.width)
        longest = int(np.diff(offsets).max())
        assert len(ids) * s.width < 2000 + longest * s.width and s.tokens_before == len(flat)
        flat += ids.tolist()
        named = [None] * s.null_docs + docs[s.null_docs :].tolist()
        held += named
        for name in set(named):
            tasks.setdefault(name, set()).add(s.shard.split("-")[0])
    whole = Tokenizer.from_file(BYTES)
    order = sorted(held, key=lambda i: (i is not None, i or 0))
    assert held == order and sorted(i or -1 for i in held) == sorted(-1 if i is None else i or -1 for i, _ in rows)
    assert len(tasks[None]) > 1 and len(tasks[7]) > 1
    want = sorted((-1 if i is None else i, crc([*whole.encode(t, add_special_tokens=False).ids, 2])) for i, t in rows)
    back = read_token_files(spark, folder + "/s").orderBy("start").collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32) for r in back) == want
    assert [r.start for r in back] == list(accumulate([r.n_tokens for r in back[:-1]], initial=0))
    for r in back:
        assert crc(flat[r.start : r.start + r.n_tokens]) == r.ids_crc32


def test_windows_of_documents():
    offsets = np.array([0, 3, 5, 5, 20, 21, 22])
    assert list(token_files._windows(offsets, 6)) == [(0, 3), (3, 4), (4, 6)]
    assert list(token_files._windows(np.array([0]), 6)) == []


def test_a_remote_store_is_read_by_range(tmp_path):
    np.arange(50, dtype="<u2").tofile(tmp_path / "a.bin")

    class Remote:
        def open_input_file(self, path):
            return pyarrow.fs.LocalFileSystem().open_input_file(path)

    slices = token_files._Slices(str(tmp_path), "a.bin", "<u2")
    assert isinstance(slices.mapped, np.memmap) and slices[3:6].tolist() == [3, 4, 5]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_files, "_store", lambda folder: (Remote(), folder))
        slices = token_files._Slices(str(tmp_path), "a.bin", "<u2")
        assert slices.mapped is None and slices[3:6].tolist() == [3, 4, 5] and slices[49:50].tolist() == [49]


def test_token_files_of_nothing(spark, empty):
    assert token_file_digests(empty, BYTES).count() == 0


def check_packing(rows, want: dict, capacity: int):
    """``want``: ids by document. Every id is in one piece, sequences are gapless and not over capacity."""
    seqs, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append(r)
    for pieces in seqs.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end and length > 0
            end += length
        assert end == capacity or (end < capacity and end & (end - 1) == 0)
    assert set(docs) == set(want)
    for doc_id, pieces in docs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want[doc_id])
            assert r.ids_crc32 == crc(want[doc_id][at : at + r.length])
            at += r.length
        assert at == len(want[doc_id])


def test_op10_query(spark, documents):
    whole = Tokenizer.from_file(BYTES)
    want = {d: [*whole.encode(t, add_special_tokens=False).ids, 1] for d, t in documents}
    check_packing(bindings.QUERIES["op10_packing"](spark, SF).collect(), want, 2048)


def test_packing_of_odd_rows_in_small_blocks(spark, odd, empty):
    whole = Tokenizer.from_file(BYTES)
    rows = pack_documents(odd.filter("doc_id <> 7"), BYTES, capacity=64, block_tokens=300).collect()
    want = {
        r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 1]
        for r in odd.filter("doc_id <> 7").collect()
    }
    check_packing(rows, want, 64)
    twice = pack_documents(odd.filter("doc_id = 7"), BYTES).collect()
    assert sum(r.length for r in twice) == 2 * twice[0].doc_tokens
    assert pack_documents(odd.filter("doc_id is null"), BYTES).first().doc_id is None
    assert pack_documents(empty, BYTES).count() == 0


def test_costs_are_balanced():
    rng = random.Random(1)
    lengths = [rng.randint(1, 900) for _ in range(3000)]
    pieces, room = pack(lengths, 2048, 1.0, 0.01)
    assert room == capacities(sum(lengths), 2048)
    cost = defaultdict(float)
    for _, _, n, seq, _ in pieces:
        cost[seq] += n + 0.01 * n * n
    full = [cost[s] for s, c in enumerate(room) if c == 2048]
    in_order = defaultdict(float)  # the same documents one after another
    at = 0
    for n in lengths:
        while n:
            take = min(n, 2048 - at % 2048)
            in_order[at // 2048] += take + 0.01 * take * take
            at, n = at + take, n - take
    assert np.std(full) < 0.6 * np.std([in_order[s] for s in range(len(full))])


@pytest.mark.parametrize("tokens,want", [(0, []), (1, [1]), (2048, [2048]), (2050, [2048, 2]), (4107, [2048, 2048, 8, 2, 1])])
def test_capacities(tokens, want):
    assert capacities(tokens) == want


def test_op8_query(spark, documents):
    import hashlib

    whole = Tokenizer.from_file(WORDS)
    want = {}
    for doc_id, text in documents:
        ids = whole.encode(text, add_special_tokens=False).ids
        decoded = whole.decode(ids, skip_special_tokens=False)
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), decoded)]
        want[doc_id] = (len(ids), *sha)
    got = bindings.QUERIES["op8_bpe_codec"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_codec_of_odd_rows(odd, empty):
    whole = Tokenizer.from_file(WORDS)
    for r in encode_and_decode(odd.filter("doc_id is not null"), WORDS).collect():
        text = next(x.text for x in odd.filter(f"doc_id = {r.doc_id}").collect()) or ""
        assert r.ids == whole.encode(text, add_special_tokens=False).ids
        assert r.decoded == whole.decode(r.ids, skip_special_tokens=False)
    assert encode_and_decode(odd, WORDS).count() == 11
    assert digests(encode_and_decode(empty, WORDS)).count() == 0

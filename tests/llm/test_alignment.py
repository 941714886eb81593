"""Token alignment against plain loops over both libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from silvermill.llm import bindings
from silvermill.llm.alignment import align, align_and_score, aligner
from tests.llm.conftest import SF

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
PARTS = list(" \n\t'sdtreaéßΣİＡ½漢😀\r\x85\xa0_-!?.,<>/\x00▁²") + [
    "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "   ", " \n", "th", "tion", " the", "aaaa", "....", "ﬁ", "  a",
]


def letters() -> dict[str, int]:
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Plain:
    """Both libraries on the whole text, one document at a time."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letters = letters()

    def a_bytes(self, i: int) -> bytes:
        return bytes(self.letters[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def document(self, text: str | None):
        """(A ids, B ids, groups, links) with links as positions in both."""
        if not text:
            return [], [], [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_parts, b_parts = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if not b"".join(a_parts) == b"".join(b_parts) == (" " + text).encode():
            return [], [], [], []
        spans = []
        for parts in (a_parts, b_parts):
            at, own = 0, []
            for part in parts:
                own.append((at, at + len(part)))
                at += len(part)
            spans.append(own)
        links = []
        j = 0
        for i, (start, end) in enumerate(spans[0]):
            while spans[1][j][1] <= start:
                j += 1
            k = j
            while k < len(b) and spans[1][k][0] < end:
                links.append((i, k))
                k += 1
        shared = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, i, j = [], 0, 0
        for end in shared:
            left, right = [], []
            while i < len(a) and spans[0][i][1] <= end:
                left.append(a[i])
                i += 1
            while j < len(b) and spans[1][j][1] <= end:
                right.append(b[j])
                j += 1
            groups.append((left, right))
        return a, b, groups, links


def brute_force(rows):
    plain = Plain()
    found = [(doc_id, *plain.document(text)) for doc_id, text in rows]
    docs = Counter()
    for _, a, b, _, links in found:
        docs.update({(a[i], b[j]) for i, j in links})
    top = defaultdict(int)
    for (i, _), n in docs.items():
        top[i] = max(top[i], n)
    out = []
    for doc_id, a, b, groups, links in found:
        counts = [(a[i], docs[a[i], b[j]]) for i, j in links]
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        out.append(
            (doc_id, len(a), len(b), len(groups), len(links), sum(n == top[i] for i, n in counts), sum(n for _, n in counts), digest)
        )
    return sorted(out, key=str)


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_ids_are_those_of_the_whole_text(documents):
    both, plain, rng = aligner(A, B), Plain(), random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(1, 14))) for _ in range(6000)]
    for text in [*texts, *(t for _, t in documents if t)]:
        a, b = both.ids(text)
        assert a.tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert b.tolist() == plain.b.encode(text), repr(text)


def test_op11_query(spark, documents):
    assert rows_of(bindings.QUERIES["op11_token_alignment"](spark, SF)) == brute_force(documents)


@pytest.mark.parametrize("hot_pairs", [0, 3, 200])
def test_rare_pairs_are_joined(spark, hot_pairs):
    rng = random.Random(11)
    rows = [(i, "".join(rng.choices(PARTS, k=rng.randint(0, 30)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(align_and_score(docs, A, B, hot_pairs)) == brute_force(rows)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = rows_of(align_and_score(odd, A, B))
    assert got == brute_force(rows)
    assert (2, 0, 0, 0, 0, 0, 0, "") in got and (3, 0, 0, 0, 0, 0, 0, "") in got
    assert rows_of(align_and_score(empty, A, B)) == []


def test_a_mark_in_the_text_leaves_it_without_tokens(spark):
    docs = spark.createDataFrame([(1, "one ▁ two"), (2, "one two")], "doc_id long, text string")
    assert [r[1] > 0 for r in rows_of(align_and_score(docs, A, B))] == [False, True]


def test_groups_cover_the_text(spark):
    text = "Strange tokenisation, naïve café  x"
    row = align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    both = aligner(A, B)
    for side, content in enumerate((both.a_words, both.b_words)):
        ids = [int(i) for group in row.groups.split(";") for i in group.split("|")[side].split(",")]
        joined = b"".join(content.data[content.start[i] : content.start[i] + content.length[i]].tobytes() for i in ids)
        assert joined == (" " + text).encode()

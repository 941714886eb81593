"""Exact byte-pair encoding by backtracking over longest matches, and decoding from an offset table.

The usual encoder merges the best pair again and again. Here an Aho-Corasick automaton over the
vocabulary finds every token at every position of a word in one pass. From the left the longest
token is taken that may stand behind the one before it; where none may, the last one is taken back
and its place tried with the next shorter token. A position that was given up is never tried again,
so a word takes time in proportion to its length. Which token may follow which is looked up in a
table of pairs that is filled as pairs occur.

Two tokens may stand side by side exactly if merging their joint bytes would never have merged across
their border. Undoing the later of the two tokens' last merges, again and again, shows all pairs that
ever touched at the border; such a pair must not have a merge that would have come before the
merge that was undone. A token which merging would never reach is left out of the automaton.

The vocabulary file is one of the tokenizers library: words with an end mark, lower case, white space
dropped. Defined cases: a null text counts as empty; a text without tokens gives an empty list and
the empty text; null ids and repeated rows stay as they are; an empty table gives no rows. Other
columns are not read. Texts are read whole, of any length.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text
from silvermill.llm.tokens import _BYTE_LETTERS, Generations

_END = "Ā"  # stands for the end mark of a word behind its bytes, written as 256 letters
_NEVER = 1 << 62
_BLOCK_CHARS = 1 << 22
_PAIRS = 2_000_000

# The word pattern of the vocabulary file, and the same for plain characters.
_WORD = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+""")
_PLAIN_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[A-Za-zÀ-ÖØ-öø-įıĲ-ž]+|[0-9]|[!-/:-@\[-`{-~]+")
# Characters that stay among these when lowered and need no composition.
_PLAIN = re.compile("[\n\t !-~À-ÖØ-öø-įıĲ-ž]*")
_SPACE = regex.compile(r"\s+")


class Vocabulary:
    """Tokens, merges and the automaton of a vocabulary file."""

    def __init__(self, spec: dict):
        model = spec["model"]
        end = model["end_of_word_suffix"]
        byte_of = {chr(letter): chr(b) for b, letter in _BYTE_LETTERS.items()}
        ids: dict[str, int] = model["vocab"]
        content: dict[int, str] = {}
        for letter, b in byte_of.items():
            content[ids[letter]], content[ids[letter + end]] = b, b + _END
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = dict.fromkeys(content, -1)
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, merged = ids[left], ids[right], ids[left + right]
            self.merges[a, b], self.parts[merged], self.rank[merged] = rank, (a, b), rank
            content[merged] = content[a] + content[b]
        self.length = {t: len(c) for t, c in content.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        reached = [t for t in content if t not in self.parts]
        for token, (a, b) in self.parts.items():  # in order of rank, parts before wholes
            if self.apart(a, b, self.rank[token]):
                reached.append(token)
        self.automaton = ahocorasick.Automaton()
        for token in reached:
            self.automaton.add_word(content[token], token)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        written = {t: s for s, t in [*ids.items(), *self.added.items()]}
        # The offset table: all tokens as written, each with a space behind it, one after another.
        spelled = [(written.get(t, "") + " ").encode() for t in range(max(written) + 1)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.offsets = np.array(list(accumulate(map(len, spelled), initial=0)))

    def apart(self, left: int, right: int, before: int = _NEVER) -> bool:
        """True if no merge that ranks before ``before`` crosses the border of two tokens."""
        while True:
            if self.merges.get((left, right), _NEVER) < before:
                return False
            undo_left = self.rank[left] > self.rank[right]
            token = left if undo_left else right
            if token not in self.parts:
                return True
            # Equal merges run from the left, so one at the border comes before the right one's.
            before = self.rank[token] + (not undo_left)
            if undo_left:
                left = self.parts[left][1]
            else:
                right = self.parts[right][0]

    def may_follow(self, left: int, right: int) -> bool:
        allowed = self.pairs.get((left, right))
        if allowed is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            allowed = self.pairs[left, right] = self.apart(left, right)
        return allowed

    def encode_word(self, word: str) -> list[int]:
        """Tokens of one word, given as its bytes in 256 letters and the end mark."""
        length = self.length
        found: list[list[int]] = [[] for _ in word]  # tokens by start, shorter ones first
        for last, token in self.automaton.iter(word):
            found[last + 1 - length[token]].append(token)
        size = len(word)
        alive = [True] * (size + 1)
        tokens: list[int] = []
        tried: list[int] = []  # index into found for each token taken
        at, k = 0, len(found[0]) - 1
        while at < size:
            options = found[at]
            while k >= 0:
                token = options[k]
                if alive[at + length[token]] and (not tokens or self.may_follow(tokens[-1], token)):
                    break
                k -= 1
            if k >= 0:
                tokens.append(token)
                tried.append(k)
                at += length[token]
                k = len(found[at]) - 1 if at < size else -1
            else:
                alive[at] = False
                token = tokens.pop()
                at -= length[token]
                k = tried.pop() - 1
        return tokens

    def decode(self, ids: np.ndarray) -> str:
        """Tokens as written, joined by spaces."""
        starts = self.offsets[ids]
        sizes = self.offsets[ids + 1] - starts
        ends = np.cumsum(sizes)
        if not len(ids):
            return ""
        places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.spelled[places].tobytes()[:-1].decode()


class Codec:
    """Encoder of whole texts: added tokens cut out first, then normalized, cut into words."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.vocabulary = Vocabulary(json.load(f))
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile(f"({'|'.join(map(re.escape, added))})") if added else None
        self.words = Generations(self._word)

    def _word(self, word: str) -> bytes:
        letters = word.encode("utf-8", "surrogatepass").decode("latin-1") + _END
        return np.array(self.vocabulary.encode_word(letters), "<u4").tobytes()

    def _plain_or_not(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text):
            words = _PLAIN_WORD.findall(text.lower())
        else:
            # Every letter is lowered by itself, so a final sigma is none.
            text = _SPACE.sub(" ", unicodedata.normalize("NFC", text)).replace("Σ", "σ").lower()
            words = _WORD.findall(text)
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        if self.added is None or not self.added.search(text):
            return np.frombuffer(self._plain_or_not(text), "<u4")
        out = []
        for i, part in enumerate(self.added.split(text)):
            added = i % 2 == 1
            out.append(np.array([self.vocabulary.added[part]], "<u4").tobytes() if added else self._plain_or_not(part))
        return np.frombuffer(b"".join(out), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids.astype("i8"))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process, so its tables outlive a task."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_and_decode(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int) and decoded (the ids turned back into text) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)

        def block() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype("i4")
            values = np.concatenate(ids).astype("i4")
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            decoded = [own.decode(i) for i in ids]
            return pa.RecordBatch.from_arrays(
                [pa.array(docs_, pa.int64()), lists, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"]
            )

        docs_, ids, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                docs_.append(doc_id)
                ids.append(own.encode(text))
                size += len(text)
                if size >= _BLOCK_CHARS:
                    yield block()
                    docs_, ids, size = [], [], 0
        if docs_:
            yield block()

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

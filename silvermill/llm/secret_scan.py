"""Secrets in texts: three plain patterns, and encoded keys and signed tokens whose structure confirms them.

Plain patterns (kinds ``assign``, ``access``, ``hex``) report what they match. The other kinds are reported only
if the decoded bytes parse to the end:

- ``key``: base64 or hex of a private key. ASN.1: every element's length must fill its parent, and the members be
  those of PKCS#1, DSA, SEC1, PKCS#8 or encrypted PKCS#8; public keys and certificates are not reported. OpenSSH's
  own format: its magic, then strings with lengths that fill the data. The outermost length says how many
  characters belong to the key; line breaks between them, also written as backslash and n, are passed over.
- ``token``: three (signed) or five (encrypted) base64url parts: a JSON header that names an algorithm other than
  none, and for signed ones JSON claims and a signature.
- A run of base64 or hex that decodes to ASCII text is searched again, up to three encodings deep; what is
  found there is reported for the whole run.

Positions are code points, ends exclusive. Defined cases: a null text counts as empty and has no spans; null
ids and repeated rows are documents like others; spans are ordered by start, then kind as listed, then end. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silvermill.llm.common import id_and_text

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "key", "token")
DEPTH = 3  # encodings inside one another

SPANS = "array<struct<kind:string,start:long,end:long>>"

# The plain patterns and their least lengths, and the words without which the first cannot match.
_ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGNED = 6
LEAST_ACCESS = 20

# Characters of base64 and hex, the base64 text of OpenSSH's magic, what a JSON object begins with.
_DER_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])M[A-I][A-Za-z0-9+/_-]{6}")
_SSH_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])b3BlbnNzaC1rZXktdjEA")
_SSH_MAGIC = b"openssh-key-v1\0"
_HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9a-f]{2}){16,}(?![0-9A-Fa-f])|(?<![0-9A-Fa-f])(?:[0-9A-F]{2}){16,}(?![0-9A-Fa-f])")
_BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[wy][A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*){2,4}")
_BREAK = re.compile(r"(?:\r|\n|\\r|\\n)+[ \t]*")
_LINE = re.compile(r"[A-Za-z0-9+/_-]+")

# ASN.1 tags.
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE, SET = 0x02, 0x03, 0x04, 0x06, 0x30, 0x31
FIRST, SECOND = 0xA0, 0xA1


def der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(length, place of the content) of the element that begins at ``at``; None where none can."""
    if at + 2 > len(data):
        return None
    first = data[at + 1]
    if first < 0x80:
        return first, at + 2
    n = first - 0x80
    if not 1 <= n <= 4 or at + 2 + n > len(data):
        return None
    length = int.from_bytes(data[at + 2 : at + 2 + n])
    if length < 0x80 or length.bit_length() <= 8 * (n - 1):  # a shorter form would have done
        return None
    return length, at + 2 + n


def der_members(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of elements that fill ``data`` exactly, else None."""
    members, at = [], 0
    while at < len(data):
        found = der_length(data, at)
        if found is None or found[1] + found[0] > len(data):
            return None
        members.append((data[at], data[found[1] : found[1] + found[0]]))
        at = found[1] + found[0]
    return members


def is_private_der(data: bytes) -> bool:
    """One sequence with the members of a private key, all lengths fitting."""
    outer = der_members(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    members = der_members(outer[0][1])
    if not members:
        return False
    tags = [tag for tag, _ in members]
    if tags[0] == INTEGER:
        version = int.from_bytes(members[0][1])
        if tags == [INTEGER] * 9 and version == 0 or tags == [INTEGER] * 9 + [SEQUENCE] and version == 1:
            return all(content for _, content in members[1:9])
        if tags == [INTEGER] * 6 and version == 0:
            return all(content for _, content in members[1:])
        if tags[:2] == [INTEGER, OCTETS] and version == 1 and set(tags[2:]) <= {FIRST, SECOND} and len(members[1][1]) >= 16:
            return all(der_members(content) for _, content in members[2:])
        if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and version in (0, 1) and set(tags[3:]) <= {FIRST, SECOND, 0x81}:
            return _names_algorithm(members[1][1]) and len(members[2][1]) >= 16
        return False
    # Encrypted: the way it was encrypted, and octets.
    return tags == [SEQUENCE, OCTETS] and _names_algorithm(members[0][1]) and len(members[1][1]) >= 16


def _names_algorithm(data: bytes) -> bool:
    members = der_members(data)
    return bool(members) and members[0][0] == OBJECT and len(members[0][1]) >= 3


def ssh_length(data: bytes) -> int | None:
    """How many bytes an OpenSSH private key at the beginning of ``data`` takes, by its nested lengths."""
    if not data.startswith(_SSH_MAGIC):
        return None
    at = len(_SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        n = int.from_bytes(data[at : at + 4])
        content = data[at + 4 : at + 4 + n]
        at += 4 + n
        return content if len(content) == n else None

    if not string() or not string() or string() is None:  # cipher, derivation and its options
        return None
    keys = int.from_bytes(data[at : at + 4])
    at += 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys):
        if not _public_ssh(string()):
            return None
    return at if string() else None


def _public_ssh(data: bytes | None) -> bool:
    """A key type's name and further strings that fill the data."""
    at, strings = 0, 0
    while data and at + 4 <= len(data):
        at += 4 + int.from_bytes(data[at : at + 4])
        strings += 1
    return bool(data) and at == len(data) and strings >= 2


def from_base64(text: str) -> bytes | None:
    text = text.rstrip("=").translate({45: "+", 95: "/"})
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except binascii.Error:
        return None


def _gather(text: str, start: int, characters: int | None) -> tuple[str, int]:
    """Up to so many base64 characters from ``start`` on, over line breaks, and where they end."""
    parts, at, size = [], start, 0
    while characters is None or size < characters:
        line = _LINE.match(text, at)
        if line is None:
            break
        stop = line.end() if characters is None else min(line.end(), at + characters - size)
        parts.append(text[at:stop])
        size += stop - at
        end = at = stop
        gap = _BREAK.match(text, at)
        if gap is None:
            break
        at = gap.end()
    if not parts:
        return "", start
    return "".join(parts), end


def _base64_end(text: str, end: int) -> int:
    """Behind the padding."""
    while end < len(text) and text[end] == "=":
        end += 1
    return end


def keys_in_base64(text: str) -> Iterator[tuple[int, int]]:
    for match in _DER_BASE64.finditer(text):
        start = match.start()
        found = der_length(from_base64(match.group()), 0)
        if found is None:
            continue
        size = found[0] + found[1]
        body, end = _gather(text, start, (size * 4 + 2) // 3)
        data = from_base64(body)
        if data is not None and len(data) == size and not _LINE.match(text, end) and is_private_der(data):
            yield start, _base64_end(text, end)
    for match in _SSH_BASE64.finditer(text):
        at = match.start()
        body, end = _gather(text, at, None)
        data = from_base64(body[: len(body) // 4 * 4] if len(body) % 4 == 1 else body)
        size = ssh_length(data) if data is not None else None
        if size is not None:
            _, end = _gather(text, at, (size * 4 + 2) // 3)
            yield at, _base64_end(text, end)


def _json_object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def tokens_in(text: str) -> Iterator[tuple[int, int]]:
    for match in _TOKEN.finditer(text):
        parts = match.group().split(".")
        header = _json_object(parts[0])
        if not header or not isinstance(header.get("alg"), str) or header["alg"].lower() == "none":
            continue
        if len(parts) == 5 and isinstance(header.get("enc"), str):
            if all(from_base64(part) is not None for part in parts[1:]) and parts[3]:
                yield match.start(), match.end()
        elif _json_object(parts[1]) is not None and parts[2] and from_base64(parts[2]) is not None:
            yield match.start(), match.start() + len(".".join(parts[:3]))


def _readable(data: bytes | None) -> str | None:
    """ASCII text, else None."""
    if data and len(data) >= 16 and data.isascii() and not data.translate(None, _PRINTED):
        return data.decode("ascii")
    return None


_PRINTED = bytes([9, 10, 13, *range(32, 127)])


def confirmed(text: str, depth: int = DEPTH) -> list[tuple[str, int, int]]:
    """(kind, start, end) of keys and tokens, each once."""
    found = {("key", *span) for span in keys_in_base64(text)}
    if "." in text:
        found |= {("token", *span) for span in tokens_in(text)}
    for pattern, decode in _RUNS:
        for match in pattern.finditer(text):
            data = decode(match.group())
            if data is None:
                continue
            if is_private_der(data) or ssh_length(data) == len(data):
                found.add(("key", *match.span()))
            elif depth > 1 and (inner := _readable(data)):
                found |= {(kind, *match.span()) for kind, _, _ in confirmed(inner, depth - 1)}
    return sorted(found)


_RUNS: tuple[tuple[re.Pattern, Callable], ...] = ((_HEX_RUN, bytes.fromhex), (_BASE64_RUN, from_base64))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the plain patterns' matches that are long enough."""
    found = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m.group()) >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


# A text in which no so many characters of base64 and breaks stand together holds nothing to decode.
_LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{16}")


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans, by start, kind and end."""
    found = base_spans(text)
    if _LONG_RUN.search(text):
        found += confirmed(text)
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: the kind and place of every secret in it."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in spans_of(text.as_py())] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, spans {SPANS}")


def digests(found: DataFrame) -> DataFrame:
    """A row per document of ``find_secrets``: counts of the plain kinds, the digest of their spans, all spans."""

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS]
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )

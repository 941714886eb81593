"""Hash buckets that split as they grow (extendible hashing).

A bucket is the rows whose key hash ends in certain bits. Its code is a one followed by those bits, so
that the code alone says how many there are: 1 holds everything, 2 and 3 a half each, 16 to 31 a
sixteenth each. A directory is the set of buckets of one partition of a table; together they cover all
hashes. A bucket above the target size is replaced by those of its next bits, the others stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silvermill.functions.columns import all_present
from silvermill.operators.latest import row_hash

MAX_DEPTH = 20  # bits, which bounds a directory to a million places
ROOT = 1


def depth(code: int) -> int:
    return code.bit_length() - 1


def bits(code: int) -> int:
    return code - (1 << depth(code))


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Hash of the key. Rows with a null in their key match nothing, so theirs is that of the whole row, which spreads
    them over all buckets."""
    return F.when(all_present(keys), F.xxhash64(*keys)).otherwise(row_hash(df))


@dataclass(frozen=True)
class Directory:
    """The codes of the buckets of one partition."""

    codes: tuple[int, ...] = (ROOT,)

    @classmethod
    def of_depth(cls, n: int) -> Directory:
        return cls(tuple(range(1 << n, 2 << n)))

    @classmethod
    def at_least(cls, buckets: int) -> Directory:
        """With so many buckets, rounded up to a power of two."""
        return cls.of_depth(min(MAX_DEPTH, max(0, math.ceil(math.log2(max(1, buckets))))))

    @property
    def depth(self) -> int:
        return max(map(depth, self.codes))

    def places(self) -> list[int]:
        """The bucket's code for every value of the last ``depth`` bits."""
        found = [0] * (1 << self.depth)
        for code in self.codes:
            for place in range(bits(code), len(found), 1 << depth(code)):
                found[place] = code
        return found

    def split(self, code: int, more: int) -> Directory:
        """Without a bucket, with those of its next ``more`` bits."""
        d, b = depth(code), bits(code)
        children = ((1 << d + more) + (x << d | b) for x in range(1 << more))
        return Directory(tuple(sorted({*self.codes} - {code} | {*children})))

    def code(self, hashed: Column) -> Column:
        if self.codes == (ROOT,):
            return F.lit(ROOT)
        # One literal, whatever the number of places: the optimizer folds the text to an array.
        places = F.split(F.lit(",".join(map(str, self.places()))), ",").cast("array<int>")
        return F.element_at(places, _low_bits(hashed, self.depth) + 1)

    def holding(self, low_bits: Iterable[int], of: int) -> set[int]:
        """Codes of the buckets that hold one of these values of the last ``of`` bits, which are no fewer than its own."""
        seen = set(low_bits)
        by_depth = {d: {b & (1 << d) - 1 for b in seen} for d in {depth(c) for c in self.codes} if d <= of}
        return {c for c in self.codes if bits(c) in by_depth[depth(c)]}


def _low_bits(hashed: Column, n: int) -> Column:
    return hashed.bitwiseAND(F.lit((1 << n) - 1).cast("long")).cast("int")


def low_bits_of(hashes: DataFrame, hashed: Column, n: int) -> list[int]:
    """The values of the last ``n`` bits that occur: a bitmap of at most 2**n bits reaches the driver."""
    if n == 0:
        return [0] if not hashes.isEmpty() else []
    place = _low_bits(hashed, n).cast("long") + 1  # Spark's bitmaps count from one
    rows = (
        hashes.select(place.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("set"))
        .collect()
    )
    found = []
    for row in rows:
        first = (row["number"] - 1) * 8 * len(row["set"])
        for at, byte in enumerate(row["set"]):
            while byte:
                found.append(first + 8 * at + (byte & -byte).bit_length() - 1)
                byte &= byte - 1
    return found


def bits_to_split(size: int, target: int, code: int) -> int:
    """By how many bits a bucket of ``size`` bytes must be split so that its parts are about ``target`` at most."""
    if size <= target:
        return 0
    return min(MAX_DEPTH - depth(code), math.ceil(math.log2(size / target)))

"""Joins of rows with the keys of a batch: a filter ahead of them, and which of them may send the keys to every task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS = 1 << 15  # one row of a bitmap
MOST_BITS = 1 << 26  # 8 MB, the most that is broadcast
BITS_PER_KEY = 16
MOST_SENT = 1 << 18  # keys that a join may broadcast


def may_match(rows: DataFrame, keys: DataFrame, on: Sequence[str], count: int) -> DataFrame:
    """Rows of ``rows`` without most of those whose ``on`` is not among ``keys``; a join has to follow.

    A bitmap over the hashes of the ``count`` keys is broadcast, 16 bits a key and 8 MB at most. Where that would
    leave fewer than two bits a key it would pass most rows, and all rows are returned instead.
    """
    if count > MOST_BITS // 2:
        return rows
    size = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, count * BITS_PER_KEY)))))
    at = F.pmod(F.xxhash64(*on), F.lit(size))
    bitmap = (
        keys.select(at.alias("_at"))
        .groupBy(F.bitmap_bucket_number("_at").alias("_number"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits"))
    )
    # At most MOST_BITS / 32768 rows of 4 KB.
    near = rows.withColumn("_number", F.bitmap_bucket_number(at)).join(F.broadcast(bitmap), "_number")
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return near.filter(F.getbit(byte, (position % 8).cast("int")) == 1).select(*[f"`{c}`" for c in rows.columns])


def join_side(keys: DataFrame, count: int) -> DataFrame:
    """``count`` keys, as the right side of a join that broadcasts them only if they are few.

    Spark decides by the bytes of compressed files, and ids compress well: 9 million in files of 10 MB become a table of
    340 MB, which the driver builds. By their number, what it holds is bounded, and more of them are shuffled.
    """
    return keys.hint("shuffle_merge") if count > MOST_SENT else keys

"""Fixed-size bitmaps of hashed values, for broadcasts whose size does not grow.

A bitmap holds one bit for every value of a 64-bit hash modulo its size: a value that is
in the set always finds its bit, another one may find it by chance. It thus prunes with a
superset, whatever the size of the set, and the step after it checks exactly. The bits are
set by Spark's bitmap aggregate, 4 KB a row; the driver holds the bitmap itself, no
list of values.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 32_768           # bits of one row of Spark's bitmap aggregate
LEAST, MOST = 20, 27     # bits: 128 KB for few values, 16 MB at most
BITS_A_VALUE = 16


def bits_for(n: int) -> int:
    """Binary logarithm of the bitmap's size for about ``n`` values."""
    return max(LEAST, min(MOST, (max(1, n) * BITS_A_VALUE - 1).bit_length()))


def collect_bitmap(values: DataFrame, hash64: Column, bits: int) -> np.ndarray:
    """The bitmap (bytes) of a column of 64-bit hashes: its upper ``bits`` are the place."""
    at = values.select(F.shiftrightunsigned(hash64, 64 - bits).alias("at"))
    # Spark numbers the bits of block b from (b - 1) * BLOCK + 1
    rows = at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("m")).collect()
    out = np.zeros(1 << bits >> 3, np.uint8)
    for r in rows:
        out[(r.b - 1) * (BLOCK >> 3):r.b * (BLOCK >> 3)] = np.frombuffer(r.m, np.uint8)
    return out


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes find their bit set."""
    at = hashes >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

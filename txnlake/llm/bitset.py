"""A bitmap of fixed size over hashed keys, the one-sided filter of the counting operators.

A set bit says that some key of the table may hash there, a clear bit that none does.
Its size is a parameter and does not grow with the data: with more keys it filters
less, but it never loses one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 4096 * 8  # the size of the bitmaps that bitmap_construct_agg builds


def spots(hashes: np.ndarray, log2_bits: int) -> np.ndarray:
    """The bit of each 64-bit hash: its leading bits after a last mixing step."""
    mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - log2_bits)).astype(np.int64)


def collect_bitset(rows: DataFrame, spot: str, log2_bits: int) -> bytes:
    """The bitmap of the spots in column ``spot``. Built as blocks in the
    executors; the driver gets at most 2 ** log2_bits / 8 bytes."""
    blocks = rows.groupBy(F.expr(f"{spot} div {BLOCK_BITS}").alias("block")).agg(
        F.bitmap_construct_agg(F.col(spot) % BLOCK_BITS).alias("bits")
    )
    out = bytearray(max((1 << log2_bits) // 8, BLOCK_BITS // 8))
    for block, bits in blocks.toLocalIterator():
        at = block * BLOCK_BITS // 8
        out[at : at + len(bits)] = bits
    return bytes(out)


def holds(bitset: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Whether the bits at ``spot`` are set; ``bitset`` is an array of bytes."""
    return (bitset[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)

"""A bitmap of bounded size that tells tasks which 64-bit keys may have passed a threshold.

A key whose bit is not set has not passed. A key whose bit is set may not have passed either,
since keys share bits; whoever asks must count such keys and decide by the count. So the
bitmap only saves work, and it has the same size whatever the number of keys.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_LOG2 = 26
_PAGE = (1 << 15) // 8


def empty() -> np.ndarray:
    return np.zeros((1 << BITS_LOG2) // 8, np.uint8)


def bitmap(keys: DataFrame) -> np.ndarray:
    """The bitmap of the only column of ``keys``, a long whose high bits are well mixed: 8 MB at most on the driver."""
    slot = F.shiftrightunsigned(F.col(keys.columns[0]), 64 - BITS_LOG2) + F.lit(1)
    pages = (
        keys.select(slot.alias("slot"))
        .groupBy(F.bitmap_bucket_number("slot").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    )
    made = empty()
    for page, bits in pages.collect():
        made[(page - 1) * _PAGE : page * _PAGE] = np.frombuffer(bits, np.uint8)
    return made


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys have their bit set."""
    slot = keys >> np.uint64(64 - BITS_LOG2)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

"""A bitmap of hashes that is broadcast to pass by what cannot match.

It holds BITS bits for each hash, rounded up to a power of two, and at most MOST bits (16 MB),
so its size is bounded whatever the number of hashes. A hash that was put in is always found;
others pass by chance, and more of them once MOST is reached. Operators verify what passes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

BITS = 32
LEAST, MOST = 1 << 16, 1 << 27


class Screen:
    """The bits and the test of an array of hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.shift = T.U(64 - (len(words) * 64).bit_length() + 1)

    def test(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.words[at >> T.U(6)] >> (at & T.U(63)) & T.U(1)).astype(bool)


def build(hashes: DataFrame, column: str = "h") -> Screen:
    """The screen of a column of hashes: tasks send set bits as 64-bit words, never the hashes."""
    n = hashes.count()
    bits = min(MOST, max(LEAST, 1 << max(0, (n * BITS - 1).bit_length())))
    places = hashes.select(F.shiftrightunsigned(F.col(column), 64 - bits.bit_length() + 1).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, dtype=np.int64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return Screen(words.view(T.U))

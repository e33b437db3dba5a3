"""Bloom filters of bounded size, built by aggregation: they spare shuffles, and what they let through is joined exactly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MAX_LOG2 = 27     # of the bits: 16 MB at most; beyond some ten million keys more and more others pass as well
SHIFTS = (0, 19, 37)


class Bloom:
    def __init__(self, log2: int, words: np.ndarray):
        self.log2, self.words = log2, words

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each 64-bit hash may be in the set; never false for one that is."""
        keys, out = keys.astype("i8").view("u8"), np.ones(len(keys), bool)
        for s in SHIFTS:
            bit = (keys >> np.uint64(s)) & np.uint64((1 << self.log2) - 1)
            out &= (self.words[(bit >> np.uint64(6)).astype("i8")] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return out


def bloom_of(rows: DataFrame, key: str) -> Bloom:
    """The filter of a column of well-mixed 64-bit hashes. Bits are joined by word in the tasks; only words that have a
    bit, at most 2^21 of them, come to the driver."""
    n = max(1, rows.count())
    log2 = min(MAX_LOG2, max(10, (n * BITS_PER_KEY - 1).bit_length()))

    def bit(s: int) -> Column:
        return F.shiftrightunsigned(key, s).bitwiseAND((1 << log2) - 1)

    bits = rows.select(F.explode(F.array(*[bit(s) for s in SHIFTS])).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("word")).toPandas()
    out = np.zeros(1 << (log2 - 6), "u8")
    out[words["at"].to_numpy("i8")] = words["word"].to_numpy("i8").view("u8")
    return Bloom(log2, out)

"""A set of 64-bit hashes in a bit map of bounded size, to leave out rows before a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_BITS = 26


class KeySet:
    """May say yes for a hash that is not in the set, never no for one that is."""

    def __init__(self, words: np.ndarray, bits: int) -> None:
        self.words, self.bits = words, bits

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & ((1 << self.bits) - 1)
        return (self.words[at >> 6] >> (at & 63)) & 1 == 1


def key_set(hashes: DataFrame, most_bits: int = MOST_BITS, each: int = 16) -> KeySet:
    """The set of the hashes in column ``h``: ``each`` bits or more for one, and never more than 2^``most_bits`` bits (8 MB).

    Beyond that size more rows pass the test than need to, which the join behind it sorts out.
    """
    bits = min(most_bits, max(10, int(hashes.count() * each).bit_length()))
    at = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    flag = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = hashes.select(at.alias("at")).select(F.shiftright("at", 6).alias("word"), flag.alias("flag"))
    words = words.groupBy("word").agg(F.bit_or("flag").alias("flags"))
    out = np.zeros(1 << (bits - 6), np.int64)
    cells = words.toPandas()
    out[cells["word"].to_numpy(np.int64)] = cells["flags"].to_numpy(np.int64)
    return KeySet(out, bits)

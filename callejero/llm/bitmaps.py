"""Bitmaps of fixed size over hashes, which drop rows that can't match and lose none that do."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def bitmap(rows: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Which values of the upper ``bits`` bits of a long column occur.

    At most ``2 ** (bits - 6)`` rows reach the driver, whatever ``rows`` holds.
    """
    slot = F.shiftrightunsigned(column, 64 - bits)
    words = rows.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("set"))
    found = words.toPandas()
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    out[found["word"].to_numpy(dtype=np.int64)] = found["set"].to_numpy(dtype=np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").view(bool)


def holds(seen: np.ndarray, hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Whether each 64-bit hash may be among those of the bitmap."""
    if not len(hashes):
        return np.zeros(0, dtype=bool)
    return seen[(hashes.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)]

"""A key filter of fixed size: tells which 64-bit keys may be in a set. No key of the set is ever missed.

Its size does not grow with the set (4 MB), so it may be sent to every task; a set too large for it lets
more keys through, which costs work in the exact step that follows, never results.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

LOG_BITS = 25


def build_filter(keys: DataFrame, column: str):
    """Broadcast variable with the filter of a column of (well mixed) long keys."""
    low = (1 << LOG_BITS) - 1
    at = keys.select(F.explode(F.array(F.expr(f"shiftrightunsigned({column}, {64 - LOG_BITS})"),
                                       F.expr(f"{column} & {low}L"))).alias("p"))
    words = at.groupBy(F.expr("cast(p div 64 as int)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("bits")).toArrow()     # at most 2**19 rows
    table = np.zeros(1 << (LOG_BITS - 6), np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each 64-bit key, whether it may be in the set."""
    found = np.zeros(len(keys), bool)
    p = keys >> np.uint64(64 - LOG_BITS)
    first = np.flatnonzero((table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1))
    p = keys[first] & np.uint64((1 << LOG_BITS) - 1)
    found[first] = ((table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found

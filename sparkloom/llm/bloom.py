"""A bit filter of fixed size over 64-bit hashes, gathered by Spark; it may let strangers pass, never turns a member away."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import to_arrays

WORDS = 1 << 20


def _bits(h: np.ndarray) -> np.ndarray:
    one = np.uint64(1)
    out = np.zeros(len(h), np.uint64)
    for shift in (24, 30, 36, 42):
        out |= one << ((h >> np.uint64(shift)) & np.uint64(63))
    return out


def gather(hashes: DataFrame, column: str, words: int = WORDS) -> np.ndarray:
    """Filter of all hashes in a long column: at most ``words`` partial results, however many rows there are."""
    h = F.col(column)
    mask = F.lit(0).cast("long")
    for shift in (24, 30, 36, 42):
        mask = mask.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftright({column}, {shift}) & 63 as int))"))
    parts = hashes.select(h.bitwiseAND(F.lit(words - 1)).cast("int").alias("at"), mask.alias("mask")).groupBy("at").agg(F.bit_or("mask").alias("mask"))

    rows = to_arrays(parts)
    table = np.zeros(words, np.uint64)
    table[rows["at"]] = rows["mask"].view(np.uint64)
    return table


def may_hold(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = _bits(h)
    return (table[(h & np.uint64(len(table) - 1)).astype(np.int64)] & bits) == bits

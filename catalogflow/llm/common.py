"""Helpers that several operators share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBER_OF_ROUNDS = 2  # bits that each key sets in a bitmap


def key_bitmap(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """A Bloom filter of fixed size over a long column, put together on the executors.

    The driver receives ``bits`` / 8 bytes whatever the number of keys. The filter only spares
    shuffled rows: a key that passes by chance is dropped by the join behind it.
    """
    key = F.col(column)
    slots = [F.pmod(F.shiftrightunsigned(key, 20 * r), F.lit(bits)) for r in range(NUMBER_OF_ROUNDS)]
    words = (
        keys.select(F.explode(F.array(*slots)).alias("bit"))
        .groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    )
    out = np.zeros(bits // 64, dtype=np.uint64)
    table = words.toArrow()
    out[table["word"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return out


def in_bitmap(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (64 bits, unsigned) the filter may hold."""
    bits = np.uint64(len(bitmap) * 64)
    found = np.ones(len(keys), dtype=bool)
    for r in range(NUMBER_OF_ROUNDS):
        # Spark's pmod of a signed long: shift first, then the remainder of the signed value.
        shifted = keys >> np.uint64(20 * r) if r else keys
        slot = (shifted.view(np.int64) % np.int64(bits)).astype(np.uint64)
        found &= (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return found


def whole_text(column: str | Column = "text") -> Column:
    """The text with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))

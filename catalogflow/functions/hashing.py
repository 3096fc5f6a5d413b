"""Deterministic hashes: gold membership and the order used by every split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GOLD_MODULO = 10


def _hex_long(text: Column) -> Column:
    return F.conv(text, 16, 10).cast("long")


def gold_bucket(key: Column, modulo: int = GOLD_MODULO) -> Column:
    """First 8 bytes of md5(key) as an unsigned big-endian number, modulo ``modulo``.

    The 64-bit number does not fit a signed long, so the two 32-bit halves are reduced
    separately.
    """
    digest = F.md5(key.cast("string"))
    high = _hex_long(F.substring(digest, 1, 8)) % modulo
    low = _hex_long(F.substring(digest, 9, 8)) % modulo
    return (high * (2**32 % modulo) + low) % modulo


def is_gold(key: Column) -> Column:
    return gold_bucket(key) == 0


def split_hash(key: Column, seed: int) -> Column:
    """Pseudo-random but repeatable order of keys for one seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))

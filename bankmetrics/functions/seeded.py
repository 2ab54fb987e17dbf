"""Repeatable random draws from a hash of (seed, purpose, row key).

The value depends on nothing else, so any partitioning, retry or executor
loss reproduces the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, purpose: str, key: Column) -> Column:
    """Uniform DOUBLE in [0, 1) from the upper 53 bits of a 64-bit hash."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(purpose), key), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def portable_pick(seed: int, purpose: str, key: Column, count: int) -> Column:
    """Uniform INT in 0 to count - 1 from 60 bits of an MD5 hash, which any engine can compute again.

    A NULL key draws like the empty one.
    """
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), F.coalesce(key.cast("string"), F.lit("")))
    return (F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % count).cast("int")


def uniform_money(seed: int, purpose: str, key: Column, low: int, high: int) -> Column:
    """Uniform amount in [low, high], rounded to cents."""
    return F.round(F.lit(float(low)) + draw(seed, purpose, key) * F.lit(float(high - low)), 2).cast("decimal(18,2)")


def pick(seed: int, purpose: str, key: Column, count: int) -> Column:
    """Uniform INT in 0 to count - 1."""
    return F.floor(draw(seed, purpose, key) * count).cast("int")


def hash_uuid(seed: int, purpose: str, key: Column) -> Column:
    """A 128-bit identifier in UUID layout."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), key.cast("string")))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in parts])

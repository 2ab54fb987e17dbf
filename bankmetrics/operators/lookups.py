"""Sums per key of a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bankmetrics.operators.positions import balances_by


def positions_through(rows: DataFrame, lookup: DataFrame, key: str, *traits: str) -> DataFrame:
    """Balances and ``positions`` (row counts) per key and trait, with the lookup's columns in place of ``key``.

    A key that the lookup does not know keeps its balance, with NULLs. Rows are summed before the join, whatever the
    size of the lookup: a key that holds a third of them comes to the join with one row per trait, and the join is left
    to Catalyst. Meant for keys with many rows each; with a few rows per key and trait a plain join is cheaper.
    """
    return balances_by(rows, key, *traits).join(lookup, key, "left").drop(key)

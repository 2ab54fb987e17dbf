"""Data checks: rows that would otherwise be lost or doubled in silence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.operators.positions import balances_by


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def null_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Number of NULLs in each column that must have none."""
    counted = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counted.unpivot([], list(columns), "column_name", "null_rows")


def null_keys_through(rows: DataFrame, lookup: DataFrame, key: str, found: str, tests: dict[str, Column]) -> DataFrame:
    """``null_keys`` for rows that get the column ``found`` from a lookup by ``key``.

    ``tests`` has, for each column name, whether a row has no value. Rows are counted per key before the join.
    """
    counts = [F.count_if(test).alias(name) for name, test in tests.items()]
    per_key = rows.groupBy(key).agg(*counts, F.count(F.lit(1)).alias("_rows")).join(lookup, key, "left")
    sums = {name: F.sum(name) for name in tests}
    sums[found] = F.sum(F.when(F.col(found).isNull(), F.col("_rows")))
    totals = per_key.agg(*[F.coalesce(total, F.lit(0)).alias(name) for name, total in sums.items()])
    return totals.unpivot([], [*tests, found], "column_name", "null_rows")


def unmapped_types(assets: DataFrame, risk_config: DataFrame) -> DataFrame:
    """Asset types without a risk weight and the balance they hold.

    These balances add nothing to risk-weighted assets, which overstates CAR.
    """
    return balances_by(assets, "asset_type").join(risk_config, "asset_type", "left_anti")

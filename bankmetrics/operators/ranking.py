"""Top rows and latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, measure: str, tie: str, count: int) -> DataFrame:
    """The ``count`` largest rows; each task keeps only its own best ``count``."""
    return df.orderBy(F.col(measure).desc_nulls_last(), F.col(tie).asc_nulls_last()).limit(count)


def latest_run(metrics: DataFrame) -> DataFrame:
    """Rows of the run with the newest timestamp; the larger run_id wins a tie.

    The run is found by a scalar subquery, so the outer filter is an equality
    on run_id: it prunes the partitions of a stored table and moves below the
    aggregation of a derived one.
    """
    newest = (
        metrics.select("run_id", "computation_date")
        .orderBy(F.col("computation_date").desc_nulls_last(), F.col("run_id").desc())
        .limit(1)
        .select("run_id")
    )
    return metrics.where(F.col("run_id") == newest.scalar())


def latest_period(rows: DataFrame, period: str = "report_period") -> DataFrame:
    """Rows of the largest report period, for stored benchmarks; ``newest_period`` reads a derived table once."""
    newest = rows.agg(F.max(period))
    return rows.where(F.col(period) == newest.scalar())


def newest_period(totals: DataFrame, period: str = "report_period") -> DataFrame:
    """The row of the largest report period, from one row per period; each task keeps only its own best."""
    return totals.where(F.col(period).isNotNull()).orderBy(F.col(period).desc()).limit(1)

"""Wide rows to metric rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack(wide: DataFrame, ids: list[str], names, value: str) -> DataFrame:
    """One row per id and metric."""
    return wide.unpivot(ids, list(names), "metric_name", value)


def to_metric_rows(wide: DataFrame, ids: list[str], names) -> DataFrame:
    """One row per id and metric; a metric that could not be computed gives no row."""
    return stack(wide, ids, names, "metric_value").where(F.col("metric_value").isNotNull())


def one_metric(df: DataFrame, name: str) -> DataFrame:
    """``(metric_name, metric_value)`` from a one-row frame with a column ``name``."""
    return df.select(F.lit(name).alias("metric_name"), F.col(name).cast("double").alias("metric_value"))

"""File outputs: generated inputs, staged metrics, the benchmark copy."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_inputs(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    """One folder of part files per table, written in parallel; ``read_input`` reads it back."""
    for name, df in tables.items():
        if fmt == "csv":
            df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}.csv")
        else:
            df.write.mode("overwrite").format(fmt).save(f"{folder}/{name}")


def write_small_csv(df: DataFrame, path: str) -> None:
    """A single CSV file with header, for results of a few rows."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def stage_metric(one_row: DataFrame, folder: str, name: str) -> None:
    """Stages a (metric_name, metric_value) row where ``read_staged_metrics`` finds it."""
    write_small_csv(one_row, f"{folder}/{name.lower()}_result")

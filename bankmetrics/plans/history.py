"""Metric snapshots of one run, and of many runs held in the same tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmetrics.functions import measures, rules
from bankmetrics.operators import funding, positions
from bankmetrics.operators.reshape import to_metric_rows
from bankmetrics.plans import ratios
from bankmetrics.schemas import STORED_METRIC


def snapshot(wide: DataFrame, run_id: str, computed_at: dt.datetime | None = None) -> DataFrame:
    """The three metrics of one run as rows that share run_id and timestamp."""
    stamped = wide.select(
        F.lit(run_id).alias("run_id"),
        (F.current_timestamp() if computed_at is None else F.lit(computed_at)).alias("computation_date"),
        *[F.col(name).cast(STORED_METRIC).alias(name) for name in rules.METRICS],
    )
    return run_metrics(stamped)


def staged_snapshot(
    staged: DataFrame, run_id: str, computed_at: dt.datetime | None = None, missing: float | None = None
) -> DataFrame:
    """The same rows from staged (metric_name, metric_value) results.

    A metric that was not staged gives no row, or ``missing`` as its value.
    """
    values = [
        F.max(F.when(F.col("metric_name") == name, F.col("metric_value"))).alias(name) for name in rules.METRICS
    ]
    wide = staged.agg(*values)
    return snapshot(wide if missing is None else wide.fillna(missing), run_id, computed_at)


def runs(assets: DataFrame, liabilities: DataFrame, capital: DataFrame, risk_config: DataFrame) -> DataFrame:
    """One row per run with its ratios, where assets and liabilities carry run_id and as_of.

    Each table is read once and reduced to one row per run; the rows then meet
    in a union and a group by run, so a run found in one table only is kept
    with the metrics that table gives, and a filter on run_id reaches both.
    """
    asset_side = positions.asset_measures(assets, risk_config, "run_id", newest="as_of")
    due = measures.within_horizon(F.col("maturity_days"))
    funding_side = (
        funding.with_outflow(liabilities)
        .groupBy("run_id")
        .agg(F.sum(F.when(due, F.col("projected_outflow"))).alias("net_outflow"), F.max("as_of").alias("as_of"))
    )
    both = asset_side.unionByName(funding_side, allowMissingColumns=True)
    parts = [name for name in both.columns if name != "run_id"]
    # One row per run and side, so max only passes the single value through.
    joined = both.groupBy("run_id").agg(*[F.max(name).alias(name) for name in parts])
    wide = ratios.with_ratios(joined.withColumn("tier1_capital", ratios.tier1_capital(capital).scalar()))
    return wide.select(
        "run_id",
        F.col("as_of").alias("computation_date"),
        *[F.col(name).cast(STORED_METRIC).alias(name) for name in rules.METRICS],
    )


def run_metrics(wide: DataFrame) -> DataFrame:
    """Metric rows of ``runs``."""
    return to_metric_rows(wide, ["run_id", "computation_date"], rules.METRICS)


def newest_run(wide: DataFrame) -> DataFrame:
    """The newest of ``runs``, for a history that is being computed.

    Taken before the metrics are stacked, from one row per run, so the tables
    behind the history are read once. A stored history is better served by
    ``ranking.latest_run``.
    """
    computed = wide.where(F.coalesce(*rules.METRICS).isNotNull())
    return computed.orderBy(F.col("computation_date").desc_nulls_last(), F.col("run_id").desc()).limit(1)

"""Industry benchmarks and the bank's distance from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.functions import measures, rules
from bankmetrics.operators import ranking
from bankmetrics.operators.reshape import stack
from bankmetrics.schemas import STORED_METRIC

# The report date and asset threshold of the benchmark query.
REPORT_DATE = "20231231"
MIN_ASSETS = 100_000_000


def observations(
    financials: DataFrame,
    report_date: str | None = REPORT_DATE,
    min_assets: float = MIN_ASSETS,
) -> DataFrame:
    """All institutions of at least ``min_assets``, of one report date or of all."""
    kept = financials.where(F.col("ASSET") >= min_assets)
    if report_date is not None:
        kept = kept.where(F.col("REPDTE") == report_date)
    return kept.select("REPDTE", "CERT", *[name for name in ("NAME",) if name in kept.columns], "EQVWCOR")


def _average() -> Column:
    return F.round(F.coalesce(F.avg("EQVWCOR"), F.lit(0.0)), 2)


def average_by_period(observed: DataFrame) -> DataFrame:
    """Average capital ratio and number of values per report date."""
    return observed.groupBy(F.col("REPDTE").alias("report_period")).agg(
        _average().alias("CAR"), F.count("EQVWCOR").alias("institutions")
    )


def average_of(observed: DataFrame, report_period: str = REPORT_DATE) -> DataFrame:
    """One row for one period, 0.0 when nothing was observed."""
    return observed.agg(_average().alias("CAR"), F.count("EQVWCOR").alias("institutions")).select(
        F.lit(report_period).alias("report_period"), "CAR", "institutions"
    )


def benchmark_table(averages: DataFrame, fetched_at: dt.datetime | None = None) -> DataFrame:
    """The averages stacked with the fixed LCR and NPL benchmarks."""
    fixed = [F.lit(value).cast(STORED_METRIC).alias(name) for name, value in rules.FIXED_BENCHMARKS]
    wide = averages.select(
        "report_period",
        F.col("CAR").cast(STORED_METRIC).alias("CAR"),
        *fixed,
        (F.current_timestamp() if fetched_at is None else F.lit(fetched_at)).alias("fetched_at"),
    )
    return stack(wide, ["report_period", "fetched_at"], rules.METRICS, "industry_average")


def compare(bank: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """Bank metric next to its benchmark, for metrics that have both."""
    left = bank.select("metric_name", F.col("metric_value").alias("bank_metric"))
    right = benchmarks.select("metric_name", F.col("industry_average").alias("benchmark"))
    return left.join(right, "metric_name")


def compare_latest(metrics: DataFrame, benchmarks: DataFrame) -> DataFrame:
    """The stored metrics of the latest run against the stored benchmarks of the latest period."""
    return compare(ranking.latest_run(metrics), ranking.latest_period(benchmarks))


def with_delta(compared: DataFrame) -> DataFrame:
    """Adds the difference to the benchmark and whether the bank is above it."""
    difference = measures.delta(F.col("bank_metric"), F.col("benchmark"))
    return compared.withColumns({"delta": difference, "status": measures.benchmark_status(difference)})

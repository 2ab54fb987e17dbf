"""Aggregation of assets.

Every asset measure is a balance times a factor that depends on a few coded
columns. Balances are therefore summed per code combination first, in one scan
with a map-side partial aggregate, and the rule table is joined to the small
result. A branch or type holding a large share of the rows reaches the shuffle
as one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bankmetrics.functions import measures

TRAITS = ("asset_type", "hqla_level", "loan_status")


def balances_by(rows: DataFrame, *keys: str, newest: str | None = None, counts: str | None = None) -> DataFrame:
    """Total balance and row count per key combination, and the newest value of a date column.

    ``rows`` may be such totals themselves, for finer keys: sums of sums are
    exact. ``counts`` then names their column of row counts.
    """
    dated = [F.max(newest).alias(newest)] if newest else []
    counted = F.sum(counts) if counts else F.count(F.lit(1))
    return rows.groupBy(*keys).agg(F.sum("balance").alias("balance"), counted.alias("positions"), *dated)


def with_rule_weight(rows: DataFrame, risk_config: DataFrame) -> DataFrame:
    """Adds ``rule_weight`` by asset type, NULL for a type without a rule.

    ``risk_config`` holds one row per type.
    """
    return rows.join(risk_config, "asset_type", "left")


def with_rwa(rows: DataFrame, risk_config: DataFrame) -> DataFrame:
    """Adds ``risk_weighted_balance`` from the rule table."""
    return with_rule_weight(rows, risk_config).withColumn(
        "risk_weighted_balance", measures.risk_weighted(F.col("balance"), F.col("rule_weight"))
    )


def with_own_rwa(rows: DataFrame) -> DataFrame:
    """Adds ``risk_weighted_balance`` from each row's own ``risk_weight``."""
    return rows.withColumn(
        "risk_weighted_balance", measures.risk_weighted(F.col("balance"), F.col("risk_weight"))
    )


def with_hqla(rows: DataFrame) -> DataFrame:
    """Adds ``hqla_value``."""
    return rows.withColumn("hqla_value", measures.hqla_value(F.col("hqla_level"), F.col("balance")))


def asset_measures(
    assets: DataFrame, risk_config: DataFrame, *keys: str, newest: str | None = None, counts: str | None = None
) -> DataFrame:
    """Risk-weighted assets, HQLA and loan totals from one scan of the assets.

    One row per key combination, or exactly one row without keys. ``loans``
    counts the loan rows behind the loan totals. ``newest`` names a date
    column whose maximum is carried along, ``counts`` the row counts of assets
    that are sums already.
    """
    dated = [F.max(newest).alias(newest)] if newest else []
    positions = with_hqla(with_rwa(balances_by(assets, *keys, *TRAITS, newest=newest, counts=counts), risk_config))
    loan = measures.is_loan(F.col("loan_status"))
    bad = measures.non_performing(F.col("loan_status"), F.col("balance"))
    return positions.groupBy(*keys).agg(
        F.sum("risk_weighted_balance").alias("total_rwa"),
        F.sum("hqla_value").alias("total_hqla"),
        F.sum(F.when(loan, F.col("balance"))).alias("total_loan_balance"),
        F.sum(F.when(loan, bad)).alias("npl_balance"),
        F.coalesce(F.sum(F.when(loan, F.col("positions"))), F.lit(0)).alias("loans"),
        *dated,
    )


def roll_up(measured: DataFrame) -> DataFrame:
    """Bank totals, one row, from per-branch measures. Exact, as all sums are decimal."""
    return measured.agg(
        *[
            F.sum(name).alias(name)
            for name in ("total_rwa", "total_hqla", "total_loan_balance", "npl_balance", "loans")
        ]
    )


def newest_run_balances(rows: DataFrame, *keys: str) -> DataFrame:
    """Balances by key of the run with the newest ``as_of``; the larger run_id wins a tie.

    The rows are read once: they are summed per run and key, a run's few sums are put into one row, and one row is
    taken. ``keys`` are codes, so a run has few of them.
    """
    summed = balances_by(rows.where(F.col("run_id").isNotNull()), "run_id", *keys, newest="as_of")
    entry = F.struct(*keys, "balance", "positions")
    runs = summed.groupBy("run_id").agg(F.max("as_of").alias("as_of"), F.collect_list(entry).alias("entries"))
    newest = runs.orderBy(F.col("as_of").desc_nulls_last(), F.col("run_id").desc()).limit(1)
    return newest.select("run_id", F.inline("entries"))

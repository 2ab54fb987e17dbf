"""The three ratios, alone and together.

A bank-wide total of another table enters as a scalar subquery: one value, no
join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.functions import measures, rules
from bankmetrics.operators import funding, positions, ranking


def tier1_capital(capital: DataFrame) -> DataFrame:
    """Total Tier 1 capital, one row."""
    counted = capital.where(F.col("capital_type") == rules.TIER_1)
    return counted.agg(F.sum("balance").alias("tier1_capital"))


def rwa_by_type(assets: DataFrame, risk_config: DataFrame) -> DataFrame:
    """Balance, rule weight and risk-weighted balance per asset type."""
    return positions.with_rwa(positions.balances_by(assets, "asset_type"), risk_config)


def total_rwa(assets: DataFrame, risk_config: DataFrame) -> DataFrame:
    return rwa_by_type(assets, risk_config).agg(F.sum("risk_weighted_balance").alias("total_rwa"))


def own_weight_rwa(assets: DataFrame) -> DataFrame:
    """Risk-weighted assets from the weights stored on the rows."""
    weighted = positions.with_own_rwa(positions.balances_by(assets, "risk_weight"))
    return weighted.agg(F.sum("risk_weighted_balance").alias("total_rwa"))


def hqla_by_level(assets: DataFrame) -> DataFrame:
    return positions.with_hqla(positions.balances_by(assets, "hqla_level"))


def total_hqla(assets: DataFrame) -> DataFrame:
    return hqla_by_level(assets).agg(F.sum("hqla_value").alias("total_hqla"))


def car(assets: DataFrame, capital: DataFrame, risk_config: DataFrame) -> DataFrame:
    """Capital adequacy: Tier 1 capital over risk-weighted assets, in percent."""
    sides = total_rwa(assets, risk_config).withColumn("tier1_capital", tier1_capital(capital).scalar())
    return sides.withColumn("CAR", measures.percent(F.col("tier1_capital"), F.col("total_rwa")))


def lcr(assets: DataFrame, liabilities: DataFrame) -> DataFrame:
    """Liquidity coverage: liquid assets over the outflow of the next 30 days, in percent.

    There is no cap on Level 2 assets and no offset for inflows.
    """
    sides = total_hqla(assets).withColumn("net_outflow", funding.horizon_outflow(liabilities).scalar())
    return sides.withColumn("LCR", measures.percent(F.col("total_hqla"), F.col("net_outflow")))


def _npl_ratio() -> Column:
    return F.round(measures.percent(F.col("npl_balance"), F.col("total_loan_balance")), 2)


def _npl(assets: DataFrame, *keys: str) -> DataFrame:
    loans = assets.where(measures.is_loan(F.col("loan_status")))
    bad = measures.non_performing(F.col("loan_status"), F.col("balance"))
    totals = loans.groupBy(*keys).agg(F.sum("balance").alias("total_loan_balance"), F.sum(bad).alias("npl_balance"))
    return totals.withColumn("npl_ratio_percent", _npl_ratio())


def npl_by_branch(assets: DataFrame) -> DataFrame:
    """Non-performing share of the loan balance per branch, in percent."""
    return _npl(assets, "branch_id")


def npl_bank(assets: DataFrame) -> DataFrame:
    """The same for the whole bank; ``entity`` is the constant display key."""
    totals = _npl(assets)
    return totals.withColumn("entity", F.when(F.col("total_loan_balance").isNotNull(), F.lit(1)))


def worst_branches(by_branch: DataFrame, count: int = 5) -> DataFrame:
    return ranking.top(by_branch, "npl_ratio_percent", "branch_id", count)


def branch_measures(assets: DataFrame, risk_config: DataFrame, counts: str | None = None) -> DataFrame:
    """All asset measures per branch from one scan; ``counts`` as in ``asset_measures``."""
    measured = positions.asset_measures(assets, risk_config, "branch_id", counts=counts)
    return measured.withColumn("npl_ratio_percent", _npl_ratio())


def bank_ratios(measured: DataFrame, outflow: DataFrame, capital: DataFrame) -> DataFrame:
    """CAR, LCR and NPL with their parts in one row.

    ``measured`` is one row of asset measures and ``outflow`` the horizon
    outflow, so each large table is read once for all three ratios.
    """
    return with_ratios(
        measured.withColumns({"net_outflow": outflow.scalar(), "tier1_capital": tier1_capital(capital).scalar()})
    )


def with_ratios(sides: DataFrame) -> DataFrame:
    """Adds CAR, LCR and NPL to rows that hold their parts."""
    return sides.withColumns(
        {
            "CAR": measures.percent(F.col("tier1_capital"), F.col("total_rwa")),
            "LCR": measures.percent(F.col("total_hqla"), F.col("net_outflow")),
            "NPL": _npl_ratio(),
        }
    )


def ratios_of(
    assets: DataFrame, liabilities: DataFrame, capital: DataFrame, risk_config: DataFrame
) -> DataFrame:
    """``bank_ratios`` straight from the input tables."""
    return bank_ratios(
        positions.asset_measures(assets, risk_config), funding.horizon_outflow(liabilities), capital
    )


def due_within(liabilities: DataFrame, due: str, as_of, days: int = rules.HORIZON_DAYS) -> DataFrame:
    """Rows due no later than ``days`` after ``as_of``, overdue ones included."""
    return liabilities.where(measures.due_by(liabilities, due, as_of, days))

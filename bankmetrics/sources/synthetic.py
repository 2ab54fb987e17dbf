"""Seeded synthetic balance sheets, generated in parallel from row numbers.

Branch identifiers follow from the branch number, so assets and liabilities
name their branch without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.functions import rules
from bankmetrics.functions.measures import is_loan_type, listed
from bankmetrics.functions.seeded import draw, hash_uuid, pick, uniform_money
from bankmetrics.schemas import RATE

# Default row counts, amount ranges, the share of bad loans.
BRANCHES = 50
ASSETS = 500_000
LIABILITIES = 500_000
ASSET_BALANCE = (10_000, 5_000_000)
LIABILITY_BALANCE = (5_000, 10_000_000)
CAPITAL_BALANCE = (500_000_000, 1_000_000_000)
NON_PERFORMING_SHARE = 0.03

# Rows per task, so that generating any number of rows stays in short tasks.
ROWS_PER_TASK = 2_000_000

# Region names are made up from a rule: five areas.
AREAS = ("North", "South", "East", "West", "Central")


def _numbers(spark: SparkSession, count: int) -> DataFrame:
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // ROWS_PER_TASK))
    return spark.range(0, count, 1, tasks)


def _branch_id(seed: int, number: Column) -> Column:
    return hash_uuid(seed, "branch", number)


def branches(spark: SparkSession, count: int = BRANCHES, seed: int = 0) -> DataFrame:
    number = F.col("id")
    return _numbers(spark, count).select(
        _branch_id(seed, number).alias("branch_id"),
        F.format_string("Office %05d Branch", number).alias("branch_name"),
        listed(AREAS, pick(seed, "region", number, len(AREAS))).alias("region"),
    )


def assets(spark: SparkSession, count: int = ASSETS, branch_count: int = BRANCHES, seed: int = 0) -> DataFrame:
    number = F.col("id")
    rule = pick(seed, "asset_rule", number, len(rules.ASSET_RULES))
    kinds, weights, levels = zip(*rules.ASSET_RULES)
    status = (
        F.when(~is_loan_type(F.col("asset_type")), rules.NOT_A_LOAN)
        .when(draw(seed, "status", number) < NON_PERFORMING_SHARE, rules.NON_PERFORMING)
        .otherwise(rules.PERFORMING)
    )
    return (
        _numbers(spark, count)
        .withColumn("rule", rule)
        .withColumn("asset_type", listed(kinds, F.col("rule")))
        .select(
            hash_uuid(seed, "asset", number).alias("asset_id"),
            _branch_id(seed, pick(seed, "asset_branch", number, branch_count)).alias("branch_id"),
            "asset_type",
            uniform_money(seed, "asset_balance", number, *ASSET_BALANCE).alias("balance"),
            listed(weights, F.col("rule")).cast(RATE).alias("risk_weight"),
            listed(levels, F.col("rule")).alias("hqla_level"),
            status.alias("loan_status"),
        )
    )


def liabilities(
    spark: SparkSession, count: int = LIABILITIES, branch_count: int = BRANCHES, seed: int = 0
) -> DataFrame:
    number = F.col("id")
    kinds, rates = zip(*rules.LIABILITY_RULES)
    return (
        _numbers(spark, count)
        .withColumn("rule", pick(seed, "liability_rule", number, len(rules.LIABILITY_RULES)))
        .select(
            hash_uuid(seed, "liability", number).alias("liability_id"),
            _branch_id(seed, pick(seed, "liability_branch", number, branch_count)).alias("branch_id"),
            listed(kinds, F.col("rule")).alias("liability_type"),
            uniform_money(seed, "liability_balance", number, *LIABILITY_BALANCE).alias("balance"),
            listed(rates, F.col("rule")).cast(RATE).alias("outflow_rate"),
        )
    )


def capital(spark: SparkSession, seed: int = 0) -> DataFrame:
    number = F.col("id")
    return spark.range(1).select(
        hash_uuid(seed, "capital", number).alias("capital_id"),
        F.lit(rules.TIER_1).alias("capital_type"),
        uniform_money(seed, "capital_balance", number, *CAPITAL_BALANCE).alias("balance"),
    )


def balance_sheet(
    spark: SparkSession,
    asset_count: int = ASSETS,
    liability_count: int = LIABILITIES,
    branch_count: int = BRANCHES,
    seed: int = 0,
) -> dict[str, DataFrame]:
    return {
        "branches": branches(spark, branch_count, seed),
        "assets": assets(spark, asset_count, branch_count, seed),
        "liabilities": liabilities(spark, liability_count, branch_count, seed),
        "capital": capital(spark, seed),
    }

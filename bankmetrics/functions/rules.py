"""The regulatory code lists."""

from __future__ import annotations

from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Asset type, risk weight, HQLA level.
ASSET_RULES = (
    ("Cash", "0.00", "Level 1"),
    ("Government Bonds", "0.00", "Level 1"),
    ("Corporate Bonds", "0.50", "Level 2A"),
    ("Residential Mortgage", "0.35", "Non-HQLA"),
    ("Commercial Real Estate", "1.00", "Non-HQLA"),
    ("Corporate Loan", "1.00", "Non-HQLA"),
    ("Consumer Loan", "0.75", "Non-HQLA"),
)

# Liability type, 30-day outflow rate.
LIABILITY_RULES = (
    ("Retail Checking", "0.05"),
    ("Retail Savings", "0.05"),
    ("Corporate Deposit", "0.40"),
    ("Wholesale Funding", "1.00"),
)

# Share of the balance that counts as liquid, by HQLA level.
# Any other level counts for nothing.
HQLA_FACTORS = (
    ("Level 1", "1.00"),
    ("Level 2A", "0.85"),
)

# Loan status codes, and the words that make a type a loan.
PERFORMING = "Performing"
NON_PERFORMING = "Non-Performing"
NOT_A_LOAN = "N/A"
LOAN_WORDS = ("Loan", "Mortgage")

# The capital counted in CAR, the LCR horizon, and the two
# benchmarks that are constants rather than industry averages.
TIER_1 = "Tier 1 Capital"
HORIZON_DAYS = 30
MATURITY_SPAN_DAYS = 60
FIXED_BENCHMARKS = (
    ("LCR", "100.00"),
    ("NPL", "1.50"),
)

METRICS = ("CAR", "LCR", "NPL")

#: Pairs of a risk-weight table that is broadcast without a look at the session's threshold.
MOST_RULES = 10_000


def risk_config(spark: SparkSession, rows=None) -> DataFrame:
    """The risk-weight table, one row per asset type.

    ``rows`` replaces the standard list with other (type, weight) pairs. The
    rows travel as an Arrow table, so the plan holds a local relation. It is
    broadcast whatever the session's threshold, as a list of codes is small: a
    shuffled join on asset type would put all rows into a handful of tasks.
    More than MOST_RULES pairs carry no hint, and Catalyst decides by size.
    """
    pairs = list(rows) if rows is not None else [(kind, weight) for kind, weight, _ in ASSET_RULES]
    weights = pa.table(
        {
            "asset_type": pa.array([kind for kind, _ in pairs], pa.string()),
            "rule_weight": pa.array([Decimal(str(weight)) for _, weight in pairs], pa.decimal128(5, 2)),
        }
    )
    config = spark.createDataFrame(weights)
    return F.broadcast(config) if len(pairs) <= MOST_RULES else config

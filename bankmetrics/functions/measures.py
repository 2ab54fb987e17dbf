"""Per-row measures as column expressions: built-in functions only, no UDF."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankmetrics.functions import rules
from bankmetrics.functions.seeded import portable_pick
from bankmetrics.schemas import RATE


def decimal_rate(value: str) -> Column:
    return F.lit(value).cast(RATE)


def listed(values, position: Column) -> Column:
    """The value at a position counted from 0; NULL for a NULL position.

    ``get`` and not ``element_at``: in ANSI mode the latter is taken as never
    NULL on an array without NULLs, whatever the position.
    """
    return F.get(F.array(*[F.lit(value) for value in values]), position.cast("int"))


def risk_weighted(balance: Column, weight: Column) -> Column:
    """Balance times weight; NULL where the weight is unknown."""
    return balance * weight


def hqla_value(level: Column, balance: Column) -> Column:
    """The part of a balance that counts as a high-quality liquid asset.

    An unlisted or NULL level counts for 0, whatever the balance.
    """
    chain = F
    for name, factor in rules.HQLA_FACTORS:
        chain = chain.when(level == name, balance * decimal_rate(factor))
    return chain.otherwise(F.lit(0))


def projected_outflow(balance: Column, rate: Column) -> Column:
    return balance * rate


def hashed_maturity(key: Column, seed: int, span: int = rules.MATURITY_SPAN_DAYS) -> Column:
    """Days to maturity, 0 to span - 1, for liabilities that carry none.

    The day follows from the key and the seed, so a recomputed task or a
    second run gives the same ratio, and another engine can check it.
    """
    return portable_pick(seed, "maturity", key, span)


def within_horizon(maturity: Column, days: int = rules.HORIZON_DAYS) -> Column:
    """Due within the horizon, its last day included."""
    return maturity <= days


def is_loan(status: Column) -> Column:
    """True for loans; NULL, hence dropped by a filter, for a NULL status."""
    return status != rules.NOT_A_LOAN


def non_performing(status: Column, amount: Column) -> Column:
    return F.when(status == rules.NON_PERFORMING, amount).otherwise(F.lit(0))


def is_loan_type(asset_type: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(asset_type, F.lit(word)) for word in rules.LOAN_WORDS])


def percent(numerator: Column, denominator: Column) -> Column:
    """Ratio in percent as DOUBLE; NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * 100


def delta(bank: Column, benchmark: Column) -> Column:
    return bank - benchmark


def benchmark_status(difference: Column) -> Column:
    return (
        F.when(difference > 0, F.lit("Above Benchmark"))
        .when(difference <= 0, F.lit("Not Above Benchmark"))
    )


def due_by(df: DataFrame, due: str, as_of: dt.datetime, days: int) -> Column:
    """Due no later than ``days`` after ``as_of``; overdue rows stay in.

    The bound is one literal of the column's own type, so it reaches the scan.
    """
    end = F.lit((as_of + dt.timedelta(days=days)).isoformat(sep=" "))
    return df[due] <= end.cast(df.schema[due].dataType)

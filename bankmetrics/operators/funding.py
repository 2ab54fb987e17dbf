"""Aggregation of liabilities: outflows, the maturity ladder, rolling sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bankmetrics.functions import measures, rules

# Parts that the rows of one branch and day are dealt to when they meet the ladder.
PARTS = 16


def with_maturity(liabilities: DataFrame, seed: int = 0) -> DataFrame:
    """Adds ``maturity_days`` where the table has none (see ``hashed_maturity``)."""
    if "maturity_days" in liabilities.columns:
        return liabilities
    return liabilities.withColumn("maturity_days", measures.hashed_maturity(F.col("liability_id"), seed))


def with_outflow(liabilities: DataFrame) -> DataFrame:
    """Adds ``projected_outflow``."""
    return liabilities.withColumn(
        "projected_outflow", measures.projected_outflow(F.col("balance"), F.col("outflow_rate"))
    )


def horizon_outflow(liabilities: DataFrame, *keys: str, days: int = rules.HORIZON_DAYS) -> DataFrame:
    """Outflow due within the horizon, per key or as one row for the bank."""
    due = with_outflow(liabilities).where(measures.within_horizon(F.col("maturity_days"), days))
    return due.groupBy(*keys).agg(F.sum("projected_outflow").alias("net_outflow"))


def outflow_ladder(liabilities: DataFrame) -> DataFrame:
    """Outflow per branch and maturity day: at most one row per day and branch."""
    return (
        with_outflow(liabilities)
        .groupBy("branch_id", "maturity_days")
        .agg(F.sum("projected_outflow").alias("projected_outflow"))
    )


def rolling_ladder(ladder: DataFrame, days: int = rules.HORIZON_DAYS) -> DataFrame:
    """Adds the outflow from each maturity day to ``days`` later, both included."""
    ahead = Window.partitionBy("branch_id").orderBy("maturity_days").rangeBetween(0, days)
    return ladder.withColumn("rolling_30d_outflow", F.sum("projected_outflow").over(ahead))


def branch_ladders(rolling: DataFrame) -> DataFrame:
    """One row per branch of a rolling ladder: a map of its days to rolling outflow, and that of rows without a day.

    A branch has at most one entry per maturity day, 60 with the days of this library.
    """
    day, value = F.col("maturity_days"), F.col("rolling_30d_outflow")
    entries = F.collect_list(F.when(day.isNotNull(), F.struct(day, value)))
    return rolling.groupBy("branch_id").agg(
        F.map_from_entries(entries).alias("by_day"), F.max(F.when(day.isNull(), value)).alias("undated")
    )


def with_rolling(liabilities: DataFrame, ladders: DataFrame) -> DataFrame:
    """``rolling_outflow`` from stored ``branch_ladders``: one read of the liabilities and a join on branch alone.

    A stored table's size is known, so Spark broadcasts it while it is under the session's threshold and the rows do not
    move. Beyond it both sides are shuffled by branch, and adaptive execution splits a hot branch.
    """
    branch = ladders.select(F.col("branch_id").alias("_branch"), "by_day", "undated")
    joined = with_outflow(liabilities).join(branch, F.col("branch_id").eqNullSafe(F.col("_branch")), "left")
    day = F.col("maturity_days")
    rolled = F.when(day.isNull(), F.col("undated")).otherwise(F.try_element_at("by_day", day))
    return joined.withColumn("rolling_30d_outflow", rolled).drop("_branch", "by_day", "undated")


def rolling_outflow(
    liabilities: DataFrame, days: int = rules.HORIZON_DAYS, ladder: DataFrame | None = None
) -> DataFrame:
    """Adds ``projected_outflow`` and ``rolling_30d_outflow`` to every liability.

    The window runs on the ladder, never on the rows, so no task holds a whole
    branch. The result returns to the rows by a join on branch and day. As one
    day of one branch may hold a large share of the rows, they are dealt to
    PARTS parts by a hash of their id, and the ladder, at most one row per day
    and branch, is repeated for each part. ``ladder`` passes a rolling ladder
    that is stored already.
    """
    rolled = (rolling_ladder(outflow_ladder(liabilities), days) if ladder is None else ladder).select(
        F.col("branch_id").alias("_branch"),
        F.col("maturity_days").alias("_day"),
        F.explode(F.sequence(*(F.lit(i).cast("long") for i in (0, PARTS - 1)))).alias("_part"),
        "rolling_30d_outflow",
    )
    part = F.pmod(F.xxhash64("liability_id"), F.lit(PARTS))
    same_branch = F.col("branch_id").eqNullSafe(F.col("_branch"))
    same_day = F.col("maturity_days").eqNullSafe(F.col("_day"))
    rows = with_outflow(liabilities).withColumn("_own_part", part)
    joined = rows.join(rolled, same_branch & same_day & (F.col("_own_part") == F.col("_part")), "left")
    return joined.drop("_branch", "_day", "_part", "_own_part")

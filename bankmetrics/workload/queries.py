"""Every query over the star-schema tables, by name.

Each takes (spark, folder) and returns a DataFrame. Sums are exact decimals
inside the queries and leave them as DOUBLE, so they compare value for value
with another engine whatever its decimal result types.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bankmetrics.functions import measures, rules
from bankmetrics.operators import checks, funding, keys, limits, positions, ranking
from bankmetrics.operators.reshape import one_metric
from bankmetrics.plans import benchmarks, history, ratios, reports
from bankmetrics.sinks import tables
from bankmetrics.sinks.work import kept, work_folder
from bankmetrics.sources import quarantine, star

# Parameters of the registered queries.
RATIO_DIGITS = 6
MIN_OBSERVED_ASSETS = 10
DUE_AS_OF = dt.datetime(1998, 1, 1)
OBSERVED_DAY = dt.date(2024, 1, 15)
SNAPSHOT_RUN = "run-0001"
SNAPSHOT_TIME = dt.datetime(2024, 2, 1, 12)
UNRULED_TYPE = "Consumer Loan"
MATURITY_SEED = 7
RATE_LIMIT = "DECIMAL(5,2)"
ASSET_LIMITS = {
    "asset_id": "VARCHAR(6) NOT NULL",
    "asset_type": "VARCHAR(14)",
    "balance": "DECIMAL(6,1)",
    "loan_status": "VARCHAR(10)",
}

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Registers a query under its function name, with portable output types."""
    _QUERIES[function.__name__] = lambda spark, folder: _portable(function(spark, folder))
    return function


def _portable(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, RATIO_DIGITS) for name in names})


# Non-performing loans


@query
def npl_by_branch(spark, folder):
    return ratios.npl_by_branch(star.asset_positions(spark, folder, "loan_status"))


@query
def npl_bank(spark, folder):
    return ratios.npl_bank(star.assets(spark, folder, placed=False))


@query
def npl_top5(spark, folder):
    return ratios.worst_branches(ratios.npl_by_branch(star.asset_positions(spark, folder, "loan_status")))


# Capital adequacy


@query
def asset_rwa(spark, folder):
    rows = positions.with_rwa(star.assets(spark, folder, placed=False), rules.risk_config(spark))
    return rows.select("asset_id", "asset_type", "balance", "rule_weight", "risk_weighted_balance")


@query
def rwa_by_type(spark, folder):
    return ratios.rwa_by_type(star.assets(spark, folder, placed=False), rules.risk_config(spark))


@query
def rwa_own_weight(spark, folder):
    return ratios.own_weight_rwa(star.assets(spark, folder, placed=False))


@query
def tier1_capital(spark, folder):
    return ratios.tier1_capital(star.capital(spark, folder))


@query
def car(spark, folder):
    assets = star.assets(spark, folder, placed=False)
    return _rounded(ratios.car(assets, star.capital(spark, folder), rules.risk_config(spark)), "CAR")


def _one_type_short(spark):
    pairs = [(kind, weight) for kind, weight, _ in rules.ASSET_RULES if kind != UNRULED_TYPE]
    return rules.risk_config(spark, pairs)


@query
def unmapped_types(spark, folder):
    return checks.unmapped_types(star.assets(spark, folder, placed=False), _one_type_short(spark))


@query
def car_one_type_unmapped(spark, folder):
    assets = star.assets(spark, folder, placed=False)
    return _rounded(ratios.car(assets, star.capital(spark, folder), _one_type_short(spark)), "CAR")


# Liquidity coverage


@query
def asset_hqla(spark, folder):
    rows = positions.with_hqla(star.assets(spark, folder, placed=False))
    return rows.select("asset_id", "hqla_level", "balance", "hqla_value")


@query
def hqla_by_level(spark, folder):
    return ratios.hqla_by_level(star.assets(spark, folder, placed=False))


@query
def outflow_30d(spark, folder):
    return funding.horizon_outflow(star.liabilities(spark, folder, placed=False))


@query
def lcr(spark, folder):
    assets = star.assets(spark, folder, placed=False)
    return _rounded(ratios.lcr(assets, star.liabilities(spark, folder, placed=False)), "LCR")


@query
def outflow_ladder(spark, folder):
    return funding.outflow_ladder(star.liabilities(spark, folder))


@query
def rolling_ladder(spark, folder):
    return funding.rolling_ladder(funding.outflow_ladder(star.liabilities(spark, folder)))


@query
def rolling_outflow(spark, folder):
    return funding.rolling_outflow(star.liabilities(spark, folder)).select(
        "liability_id",
        "branch_id",
        "liability_type",
        "balance",
        "outflow_rate",
        "maturity_days",
        "projected_outflow",
        "rolling_30d_outflow",
    )


@query
def due_within(spark, folder):
    rows = ratios.due_within(star.liabilities(spark, folder, placed=False), "due_date", DUE_AS_OF)
    return rows.select("liability_id", "balance", "due_date")


# All measures from one scan


@query
def fused_branch_measures(spark, folder):
    placed = star.asset_positions(spark, folder, *positions.TRAITS)
    return ratios.branch_measures(placed, rules.risk_config(spark), counts="positions")


@query
def fused_bank_ratios(spark, folder):
    return _rounded(_bank_ratios(spark, folder), "CAR", "LCR")


def _bank_ratios(spark, folder):
    return ratios.ratios_of(
        star.assets(spark, folder, placed=False),
        star.liabilities(spark, folder, placed=False),
        star.capital(spark, folder),
        rules.risk_config(spark),
    )


@query
def branch_report(spark, folder):
    placed = star.asset_positions(spark, folder, *positions.TRAITS)
    measured = ratios.branch_measures(placed, rules.risk_config(spark), counts="positions")
    return measured.join(star.branches(spark, folder), "branch_id", "left").select(
        "branch_name", "region", "total_loan_balance", "npl_balance", "npl_ratio_percent"
    )


# Benchmarks


def _observed(spark, folder):
    return benchmarks.observations(star.financials(spark, folder), None, MIN_OBSERVED_ASSETS)


def _benchmarks(observed):
    return benchmarks.benchmark_table(benchmarks.average_by_period(observed), SNAPSHOT_TIME)


def _latest_benchmarks(spark, folder):
    averages = benchmarks.average_by_period(_observed(spark, folder))
    return benchmarks.benchmark_table(ranking.newest_period(averages), SNAPSHOT_TIME)


@query
def benchmark_avg(spark, folder):
    return benchmarks.average_by_period(_observed(spark, folder))


@query
def benchmark_one_period(spark, folder):
    observed = benchmarks.observations(star.financials(spark, folder, OBSERVED_DAY), None, MIN_OBSERVED_ASSETS)
    return benchmarks.average_of(observed, OBSERVED_DAY.strftime("%Y%m%d"))


@query
def benchmark_table(spark, folder):
    return _benchmarks(_observed(spark, folder))


@query
def latest_benchmarks(spark, folder):
    return _latest_benchmarks(spark, folder).select("metric_name", "industry_average")


# Runs


@query
def metric_snapshot(spark, folder):
    return history.snapshot(_bank_ratios(spark, folder), SNAPSHOT_RUN, SNAPSHOT_TIME)


def _runs(spark, folder):
    return history.runs(
        star.assets(spark, folder, placed=False),
        star.liabilities(spark, folder, placed=False),
        star.capital(spark, folder),
        rules.risk_config(spark),
    )


@query
def metric_history(spark, folder):
    return history.run_metrics(_runs(spark, folder))


def _newest(spark, folder):
    return history.run_metrics(history.newest_run(_runs(spark, folder)))


@query
def latest_run(spark, folder):
    return _newest(spark, folder).select("metric_name", "metric_value")


@query
def latest_run_balances(spark, folder):
    return positions.newest_run_balances(star.assets(spark, folder, placed=False), "asset_type")


def _compared(spark, folder):
    return benchmarks.compare(_newest(spark, folder), _latest_benchmarks(spark, folder))


@query
def bank_vs_benchmark(spark, folder):
    return _compared(spark, folder)


@query
def benchmark_delta(spark, folder):
    return benchmarks.with_delta(_compared(spark, folder))


@query
def scorecard(spark, folder):
    current = history.snapshot(_bank_ratios(spark, folder), SNAPSHOT_RUN)
    return benchmarks.with_delta(benchmarks.compare(current, _latest_benchmarks(spark, folder)))


# Checks


@query
def duplicate_keys(spark, folder):
    return checks.duplicate_keys(star.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query
def null_keys(spark, folder):
    return star.asset_gaps(spark, folder)


@query
def loan_types(spark, folder):
    types = positions.balances_by(star.assets(spark, folder, placed=False), "asset_type")
    return types.select("asset_type", "positions", measures.is_loan_type(F.col("asset_type")).alias("is_loan"))


@query
def screened_duplicate_keys(spark, folder):
    """``duplicate_keys`` by a screen of hashes; it keeps the hashes that repeat."""
    return keys.screened_duplicate_keys(star.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query
def limit_violations(spark, folder):
    """Values of assets that columns of these limits could not hold."""
    return limits.over_limits(star.assets(spark, folder, placed=False), ASSET_LIMITS, "asset_id")


# Rejected input


@query
def rejected_amounts(spark, folder):
    """Liabilities as text rows, some with an amount or a rate that is none: those put aside, and why."""
    raw = star.liability_text(spark, folder)
    line = F.concat_ws(",", *raw.columns)
    kinds = {"liability_id": "STRING", "liability_type": "STRING", "balance": "DECIMAL(18,2)", "outflow_rate": RATE_LIMIT}
    marked = quarantine.typed(raw, kinds, line, F.lit(None).cast("string"), F.lit(False))
    return quarantine.split(marked, "liabilities").rejected.select("table_name", "line", "reasons")


@query
def accepted_outflow(spark, folder):
    """Outflow by liability type of the text rows that fit."""
    raw = star.liability_text(spark, folder)
    kinds = {"liability_id": "STRING", "liability_type": "STRING", "balance": "DECIMAL(18,2)", "outflow_rate": RATE_LIMIT}
    marked = quarantine.typed(raw, kinds, F.lit(""), F.lit(""), F.lit(False))
    rows = funding.with_outflow(quarantine.split(marked, "liabilities").rows)
    return rows.groupBy("liability_type").agg(F.sum("projected_outflow").alias("projected_outflow"), F.count("*").alias("rows"))


@query
def envelope_averages(spark, folder):
    """Benchmark averages from JSON envelopes, one a line, some of which are cut short."""
    entries = quarantine.institutions(quarantine.opened(star.envelopes(spark, folder)))
    return benchmarks.average_by_period(benchmarks.observations(entries, None, MIN_OBSERVED_ASSETS))


@query
def rejected_envelopes(spark, folder):
    """The lines that are not JSON."""
    found = quarantine.opened(star.envelopes(spark, folder))
    return found.where(F.col("corrupt").isNotNull()).select(F.col("corrupt").alias("line"))


# Maturity by a hash


@query
def hashed_maturity_days(spark, folder):
    rows = star.liabilities(spark, folder, placed=False).drop("maturity_days")
    return funding.with_maturity(rows, MATURITY_SEED).select("liability_id", "maturity_days")


@query
def hashed_lcr(spark, folder):
    """LCR of liabilities that carry no maturity of their own."""
    rows = star.liabilities(spark, folder, placed=False).drop("maturity_days")
    return _rounded(ratios.lcr(star.assets(spark, folder, placed=False), funding.with_maturity(rows, MATURITY_SEED)), "LCR")


# Stored tables


@query
def stored_rolling_outflow(spark, folder):
    """``rolling_outflow`` from a stored ladder, joined on branch alone."""
    rows = star.liabilities(spark, folder)
    rolling = funding.rolling_ladder(funding.outflow_ladder(rows))
    ladders = kept(funding.branch_ladders(rolling), work_folder(spark, "ladder"), "ladders")
    names = ("liability_id", "branch_id", "balance", "maturity_days", "projected_outflow", "rolling_30d_outflow")
    return funding.with_rolling(rows, ladders).select(*names)


def _stored(spark, folder):
    place = work_folder(spark, "reports")
    return {
        "metrics": reports.stored_runs(history.run_metrics(_runs(spark, folder)), place),
        "benchmarks": reports.stored_benchmarks(_benchmarks(_observed(spark, folder)), place),
    }


@query
def stored_latest_run(spark, folder):
    """The newest run by SQL over a stored table of a partition for each run."""
    return reports.report(spark, "latest_run", **_stored(spark, folder))


@query
def stored_latest_benchmarks(spark, folder):
    return reports.report(spark, "latest_benchmarks", **_stored(spark, folder))


@query
def stored_comparison(spark, folder):
    return reports.report(spark, "comparison", **_stored(spark, folder))


@query
def stored_history(spark, folder):
    """One metric over a range of runs, by SQL with parameters."""
    parameters = {"metric": "NPL", "first": "1996", "last": "1999"}
    return reports.report(spark, "history", parameters, **_stored(spark, folder))


#: Queries that keep a table of their own in the shared folder, and so run jobs while they are built.
STORING = ("screened_duplicate_keys", "stored_rolling_outflow", "stored_latest_run", "stored_latest_benchmarks")
STORING += ("stored_comparison", "stored_history")


# Storing a run


@query
def staged_metrics(spark, folder):
    """Two of three metrics staged one by one: the missing one gives no row."""
    wide = _bank_ratios(spark, folder)
    staged = one_metric(wide, "CAR").unionByName(one_metric(wide, "NPL"))
    return history.staged_snapshot(staged, SNAPSHOT_RUN, SNAPSHOT_TIME)


@query
def audit_entry(spark, folder):
    """The audit row of a complete run, without its id and time."""
    stored = history.snapshot(_bank_ratios(spark, folder), SNAPSHOT_RUN, SNAPSHOT_TIME)
    return tables.audit_row(stored, SNAPSHOT_RUN).drop("log_id")


# Exact money


def exact_branch_totals(spark, folder):
    """Loan totals per branch as exact decimals: no cast to DOUBLE, so cents stay beyond 9e13."""
    exact = {name: F.col(name).cast("decimal(38,2)") for name in ("total_loan_balance", "npl_balance")}
    return ratios.npl_by_branch(star.asset_positions(spark, folder, "loan_status")).withColumns(exact)


_QUERIES["exact_branch_totals"] = exact_branch_totals

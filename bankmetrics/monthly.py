"""The monthly run: read, compute once, store with audit, compare with benchmarks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from bankmetrics.functions import rules
from bankmetrics.operators import funding
from bankmetrics.plans import benchmarks, history, ratios
from bankmetrics.sinks import files, tables
from bankmetrics.sources import quarantine
from bankmetrics.sources.files import read_inputs


def new_run_id() -> str:
    return str(uuid.uuid4())


def bank_ratios(spark: SparkSession, folder: str, fmt: str = "csv", seed: int = 0) -> DataFrame:
    """All three ratios from the tables in ``folder``, one pass over each table."""
    inputs = read_inputs(spark, folder, fmt)
    liabilities = funding.with_maturity(inputs["liabilities"], seed)
    return ratios.ratios_of(inputs["assets"], liabilities, inputs["capital"], rules.risk_config(spark))


def store(metrics: DataFrame, run_id: str, database: str | None = None, again: bool = False) -> None:
    """Stores the metrics of a run, then its audit row from what was stored; ``again`` replaces a run that is there.

    If the second write fails, the metrics stay, and ``tables.append_audit``
    (command ``audit``) adds the audit row; it may be repeated.
    """
    (tables.replace_metrics if again else tables.append_metrics)(metrics, database)
    tables.append_audit(metrics.sparkSession, run_id, database)


def load_benchmarks(
    financials: DataFrame,
    report_date: str = benchmarks.REPORT_DATE,
    folder: str | None = None,
    database: str | None = None,
    other_periods: bool = False,
) -> None:
    """Averages the observations, replaces the benchmark table and keeps a CSV copy of it in ``folder``.

    ``other_periods`` keeps the benchmarks of other report periods.
    """
    observed = benchmarks.observations(financials, report_date)
    averages = benchmarks.average_of(observed, report_date)
    tables.replace_benchmarks(benchmarks.benchmark_table(averages, dt.datetime.now()), database, other_periods)
    if folder:
        stored = tables.read(financials.sparkSession, tables.BENCHMARKS, database)
        files.write_small_csv(stored, f"{folder}/fdic_benchmarks.csv")


def run(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    database: str | None = None,
    run_id: str | None = None,
    seed: int = 0,
    again: bool = False,
    rejected: str | None = None,
) -> str:
    """One run over ``folder``; returns its id. All ratios come from the same input.

    ``again`` replaces a run of that id. With ``rejected``, a shared folder, each source is parsed once into a folder of
    the run there, rows that do not fit their schema are left out of all ratios and put aside, and a second audit row
    tells how many. Without it a value that does not fit is NULL.
    """
    run_id = run_id or new_run_id()
    if rejected is None:
        store(history.snapshot(bank_ratios(spark, folder, fmt, seed), run_id, dt.datetime.now()), run_id, database, again)
        return run_id
    checked = quarantine.read_checked_inputs(spark, folder, fmt, f"{rejected}/{run_id}/{uuid.uuid4().hex}")
    liabilities = funding.with_maturity(checked["liabilities"].rows, seed)
    wide = ratios.ratios_of(checked["assets"].rows, liabilities, checked["capital"].rows, rules.risk_config(spark))
    store(history.snapshot(wide, run_id, dt.datetime.now()), run_id, database, again)
    tables.append_check(quarantine.all_rejected(checked.values()), run_id, list(checked), database)
    return run_id


def report(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Latest run against latest benchmarks, with difference and status."""
    metrics = tables.read(spark, tables.METRICS, database)
    industry = tables.read(spark, tables.BENCHMARKS, database)
    return benchmarks.with_delta(benchmarks.compare_latest(metrics, industry))

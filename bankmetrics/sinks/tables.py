"""Result tables: creation, append and rerun of a run with its audit rows, replacement of benchmarks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.functions import rules
from bankmetrics.operators import limits
from bankmetrics.operators.checks import duplicate_keys
from bankmetrics.sinks import work

METRICS = "regulatory_metrics"
BENCHMARKS = "fdic_benchmarks"
AUDIT = "audit_log"

# Columns, limits and defaults of the three result tables.
# Metrics are partitioned by run, so reading one run reads one partition.
COLUMNS = {
    METRICS: """run_id VARCHAR(50), metric_name VARCHAR(50), metric_value DECIMAL(10,4),
        computation_date TIMESTAMP DEFAULT current_timestamp()""",
    BENCHMARKS: """report_period VARCHAR(20), metric_name VARCHAR(50), industry_average DECIMAL(10,4),
        fetched_at TIMESTAMP DEFAULT current_timestamp()""",
    AUDIT: """log_id STRING, run_id VARCHAR(50), pipeline_step VARCHAR(100), status VARCHAR(20), message STRING,
        log_timestamp TIMESTAMP DEFAULT current_timestamp()""",
}
PARTITIONS = {METRICS: "PARTITIONED BY (run_id)"}
KEYS = {
    METRICS: ("run_id", "metric_name"),
    BENCHMARKS: ("report_period", "metric_name"),
    AUDIT: ("log_id",),
}

# The step's name, and the words of status and message in ``audit_row``.
LOAD_STEP = "Metrics Load"

CHECK_STEP = "Input Check"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class DuplicateKey(ValueError):
    """A write would break the key of a result table."""


class ColumnLimit(PySparkException):
    """Values that the columns of a result table cannot hold."""


class EmptyRun(ValueError):
    """A rerun that has no metric at all."""


def _qualified(table: str, database: str | None) -> str:
    return f"{database}.{table}" if database else table


def create_tables(spark: SparkSession, database: str | None = None, location: str | None = None) -> None:
    """Creates the tables that are not there yet; ``location`` is a shared folder for their files."""
    for table, columns in COLUMNS.items():
        placed = f"LOCATION '{location}/{table}'" if location else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_qualified(table, database)} ({columns}) "
            f"USING parquet {PARTITIONS.get(table, '')} {placed}"
        )


def read(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(_qualified(table, database))


def _refuse_duplicates(rows: DataFrame, table: str) -> None:
    repeated = duplicate_keys(rows, *KEYS[table]).limit(3).collect()
    if repeated:
        raise DuplicateKey(f"{table}: keys occur more than once: {[tuple(row) for row in repeated]}")


def violations(rows: DataFrame, table: str) -> DataFrame:
    """Every value of ``rows`` that a column of a result table cannot hold: its key, column_name, value, column_limit."""
    held = {name: kind for name, kind in limits.columns_of(COLUMNS[table]).items() if name in rows.columns}
    return limits.over_limits(rows, held, *KEYS[table])


def _refuse_violations(rows: DataFrame, table: str) -> None:
    found = violations(rows, table).limit(20).collect()
    if found:
        said = "; ".join(f"{r['column_name']} {r['value']!r} is over {r['column_limit']}" for r in found)
        raise ColumnLimit(message=f"{table}: {said}")


@contextmanager
def _staged(rows: DataFrame, table: str, database: str | None) -> Iterator[str]:
    """The rows in a table of their own, computed once and without limits; limits and keys are checked there.

    It lies in the warehouse, which all executors share, and goes at the end.
    """
    spark = rows.sparkSession
    staging = _qualified(f"{table}_{uuid.uuid4().hex}", database)
    columns = ", ".join(name for name in limits.columns_of(COLUMNS[table]) if name in rows.columns)
    try:
        spark.sql(f"CREATE TABLE {staging} USING parquet AS SELECT {columns} FROM {{rows}}", rows=rows)
        _refuse_violations(spark.table(staging), table)
        _refuse_duplicates(spark.table(staging), table)
        yield staging
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


METRIC_COLUMNS = "run_id, metric_name, metric_value, computation_date"


def append_metrics(metrics: DataFrame, database: str | None = None) -> None:
    """Appends the metric rows of a run; refuses a run and metric already stored.

    Too long a name or too large a value is refused, all of them at once. The rows are computed once.
    """
    spark, name = metrics.sparkSession, _qualified(METRICS, database)
    with _staged(metrics, METRICS, database) as staging:
        rows, keys = spark.table(staging), list(KEYS[METRICS])
        stored = spark.table(name).join(rows.select("run_id").distinct(), "run_id", "left_semi").select(*keys)
        _refuse_duplicates(stored.unionByName(rows.select(*keys)), METRICS)
        spark.sql(f"INSERT INTO {name} ({METRIC_COLUMNS}) SELECT {METRIC_COLUMNS} FROM {staging} DISTRIBUTE BY run_id")


def replace_metrics(metrics: DataFrame, database: str | None = None) -> None:
    """Stores the metric rows of a run again, or for the first time: a rerun replaces its run and no other.

    Dynamic partition overwrite exchanges the partitions of the runs in ``metrics``. Until the job commits, the old rows
    stay, whatever fails. A metric that the rerun lacks goes; a rerun without any metric is refused, as it would leave
    the old rows.
    """
    spark, name = metrics.sparkSession, _qualified(METRICS, database)
    with _staged(metrics, METRICS, database) as staging:
        if spark.table(staging).isEmpty():
            raise EmptyRun(f"{METRICS}: no rows to store")
        before = spark.conf.get(OVERWRITE_MODE)
        spark.conf.set(OVERWRITE_MODE, "dynamic")
        try:
            spark.sql(f"INSERT OVERWRITE {name} ({METRIC_COLUMNS}) SELECT {METRIC_COLUMNS} FROM {staging} DISTRIBUTE BY run_id")
        finally:
            spark.conf.set(OVERWRITE_MODE, before)


def audit_row(stored: DataFrame, run_id: str) -> DataFrame:
    """The audit entry of a run, from what is stored for it.

    FAILED, with the missing names, unless all three metrics are there.
    """
    values = [
        F.max(F.when(F.col("metric_name") == name, F.col("metric_value"))).alias(name) for name in rules.METRICS
    ]
    wide = stored.where(F.col("run_id") == run_id).agg(*values)
    missing = F.concat_ws(", ", *[F.when(F.col(name).isNull(), F.lit(name)) for name in rules.METRICS])
    template = "Loaded " + ", ".join(f"{name}:%s" for name in rules.METRICS)
    return wide.select(
        F.uuid().alias("log_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(LOAD_STEP).alias("pipeline_step"),
        F.when(missing == "", "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(missing == "", F.format_string(template, *rules.METRICS))
        .otherwise(F.concat(F.lit("Missing "), missing))
        .alias("message"),
    )


def _add_audit(spark: SparkSession, rows: DataFrame, database: str | None) -> None:
    """Appends audit rows, unless one that says the same of the run is there; time is the table's default."""
    same = ["run_id", "pipeline_step", "status", "message"]
    rows = rows.join(read(spark, AUDIT, database).select(*same), same, "left_anti")
    spark.sql(
        f"INSERT INTO {_qualified(AUDIT, database)} (log_id, run_id, pipeline_step, status, message) "
        "SELECT log_id, run_id, pipeline_step, status, message FROM {rows}",
        rows=rows,
    )


def append_audit(spark: SparkSession, run_id: str, database: str | None = None) -> None:
    """Appends the audit row of a stored run.

    A row that says the same of the run is not added again, so a call that may
    have failed can be repeated.
    """
    _add_audit(spark, audit_row(read(spark, METRICS, database), run_id), database)


def check_row(rejected: DataFrame, run_id: str, checked: list[str]) -> DataFrame:
    """The audit entry of a run's input check, from its rejected rows: REJECTED with their number by table, or SUCCESS."""
    counts = [F.count_if(F.col("table_name") == name).alias(name) for name in checked]
    total = sum((F.col(name) for name in checked), F.lit(0))
    told = [F.concat(F.lit(f"{name}:"), F.col(name).cast("string")) for name in checked]
    return rejected.agg(*counts).select(
        F.uuid().alias("log_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(CHECK_STEP).alias("pipeline_step"),
        F.when(total > 0, "REJECTED").otherwise("SUCCESS").alias("status"),
        F.concat(F.lit("Rejected "), F.concat_ws(", ", *told)).alias("message"),
    )


def append_check(rejected: DataFrame, run_id: str, checked: list[str], database: str | None = None) -> None:
    """Appends the audit row of a run's input check; it may be repeated."""
    _add_audit(rejected.sparkSession, check_row(rejected, run_id, checked), database)


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where(F.col("col_name") == "Location").first()["data_type"]


def _drop_versions(spark: SparkSession, parent: str, keep: set[str]) -> None:
    """Removes the folders of earlier versions of the benchmarks, but for those of the names to keep."""
    for folder in work.subfolders(spark, parent):
        version = folder.rsplit("/", 1)[1]
        if re.fullmatch(rf"{BENCHMARKS}-[0-9a-f]{{32}}", version) and version not in keep:
            work.removed(spark, folder)


def replace_benchmarks(benchmarks: DataFrame, database: str | None = None, other_periods: bool = False) -> None:
    """Replaces all benchmarks in one step, or, with ``other_periods``, those of the periods in ``benchmarks``.

    The new rows go to a folder of their own, under the limits of the table,
    and the table then points to that folder. Until then it holds the old
    rows, whatever fails. The folder before stays for who still reads it;
    folders of versions before that go.
    """
    spark = benchmarks.sparkSession
    name, version = _qualified(BENCHMARKS, database), uuid.uuid4().hex
    old = _location(spark, name)
    folder = f"{old.rsplit('/', 1)[0]}/{BENCHMARKS}-{version}"
    final = _qualified(f"{BENCHMARKS}_{version}", database)
    columns = "report_period, metric_name, industry_average, fetched_at"
    with _staged(benchmarks, BENCHMARKS, database) as staging:
        rows = spark.table(staging).select(*columns.split(", "))
        if other_periods:
            others = spark.table(name).join(rows.select("report_period").distinct(), "report_period", "left_anti")
            rows = others.select(*columns.split(", ")).unionByName(rows)
        spark.sql(f"CREATE TABLE {final} ({COLUMNS[BENCHMARKS]}) USING parquet LOCATION '{folder}'")
        try:
            spark.sql(f"INSERT INTO {final} ({columns}) SELECT {columns} FROM {{rows}}", rows=rows)
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        finally:
            # The table of the version is external, so its files stay.
            spark.sql(f"DROP TABLE {final}")
    _drop_versions(spark, folder.rsplit("/", 1)[0], {folder.rsplit("/", 1)[1], old.rsplit("/", 1)[1]})

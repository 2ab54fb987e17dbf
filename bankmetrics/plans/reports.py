"""Reports as SQL text over stored tables, with named views and parameters.

A text names its tables in braces and its parameters with a colon; ``report`` fills both in. The newest run is a scalar
subquery on the partition column, so a stored history gives one partition to the outer read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics.sinks.work import kept

# The words of benchmark_status are those of functions/measures.py.
REPORTS = {
    "latest_run": """
        SELECT metric_name, metric_value FROM {metrics}
        WHERE run_id = (SELECT run_id FROM {metrics} ORDER BY computation_date DESC NULLS LAST, run_id DESC LIMIT 1)""",
    "one_run": "SELECT metric_name, metric_value FROM {metrics} WHERE run_id = :run_id",
    "latest_benchmarks": """
        SELECT metric_name, industry_average FROM {benchmarks}
        WHERE report_period = (SELECT max(report_period) FROM {benchmarks})""",
    "comparison": """
        SELECT bank.metric_name, metric_value AS bank_metric, industry_average AS benchmark,
            metric_value - industry_average AS delta,
            CASE WHEN metric_value - industry_average > 0 THEN 'Above Benchmark'
                 WHEN metric_value - industry_average <= 0 THEN 'Not Above Benchmark' END AS status
        FROM ({latest_run}) AS bank JOIN ({latest_benchmarks}) AS industry ON bank.metric_name = industry.metric_name""",
    "history": """
        SELECT run_id, computation_date, metric_value FROM {metrics}
        WHERE metric_name = :metric AND run_id BETWEEN :first AND :last""",
}


def report(spark: SparkSession, name: str, parameters: dict | None = None, **tables: DataFrame) -> DataFrame:
    """A report over tables given by the names in its text; a name of another report is that report."""
    text = REPORTS[name]
    for other in REPORTS:
        text = text.replace(f"({{{other}}})", f"({REPORTS[other]})")
    used = {t: df for t, df in tables.items() if f"{{{t}}}" in text}
    return spark.sql(text, args=parameters or {}, **used)


def stored_runs(metrics: DataFrame, folder: str, name: str = "metrics") -> DataFrame:
    """Metric rows stored in a folder, a partition for each run, as the table that reports read."""
    metrics.repartition("run_id").write.partitionBy("run_id").parquet(f"{folder}/{name}")
    columns = [f for f in metrics.schema if f.name != "run_id"]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in columns) + ", run_id STRING"
    return metrics.sparkSession.read.schema(kind).parquet(f"{folder}/{name}")


def stored_benchmarks(benchmarks: DataFrame, folder: str) -> DataFrame:
    return kept(benchmarks.withColumn("report_period", F.col("report_period").cast("string")), folder, "benchmarks")

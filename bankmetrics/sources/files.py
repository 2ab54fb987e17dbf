"""Readers for the balance-sheet tables, staged results and benchmark data."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics import schemas


def read_input(
    spark: SparkSession, folder: str, table: str, fmt: str = "csv", schema: str | None = None, infer: bool = False
) -> DataFrame:
    """One of ``branches``, ``assets``, ``liabilities``, ``capital``.

    CSV is read with the declared schema, or with ``schema``: no inference
    pass over the data, and a malformed number becomes NULL in its own row
    instead of turning the whole column into text. Columns go by position.
    ``infer=True`` asks for Spark's inference. Columnar formats carry their
    own schema.
    """
    if fmt != "csv":
        return spark.read.format(fmt).load(f"{folder}/{table}")
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema or schemas.INPUTS[table])
    return reader.csv(f"{folder}/{table}.csv")


def read_inputs(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    return {table: read_input(spark, folder, table, fmt) for table in schemas.INPUTS}


def read_staged_metrics(spark: SparkSession, folder: str, names=("CAR", "LCR", "NPL")) -> DataFrame:
    """Metrics staged as CSV under ``<folder>/<name>_result``; a missing one gives no row."""
    wanted = ",".join(f"{name.lower()}_result" for name in names)
    reader = spark.read.schema(schemas.STAGED_METRIC).option("header", True)
    try:
        return reader.csv(f"{folder}/{{{wanted}}}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schemas.STAGED_METRIC)


def read_financials(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Institution financials from JSON envelopes ``{data: [{data: {...}}]}``.

    Text that is not JSON fails the read; a field that is not a number is NULL.
    One envelope per line is the default, as such files are split among tasks;
    with ``multi_line=True`` a file is one document, read by one task.
    """
    reader = spark.read.schema(schemas.FINANCIALS_ENVELOPE).option("mode", "FAILFAST")
    entries = reader.json(path, multiLine=multi_line).select(F.explode("data").alias("entry"))
    return entries.select(
        *[F.col(f"entry.data.{name}").try_cast(kind).alias(name) for name, kind in schemas.FINANCIALS.items()]
    )


"""Input rows that fit their schema, and those that do not, from one read.

The readers of ``files`` give a malformed number as NULL, so its row leaves all sums in silence. Here each row is read as
text, every field is tried as its type, and a row with a field that does not fit, or with too few or too many fields, is
put aside with its source line and the reasons.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmetrics import schemas
from bankmetrics.operators.limits import MISFITS, columns_of, misfits

CORRUPT = "_corrupt_record"
#: What a marked row has besides its columns: the line, its file, and why it is put aside.
MARKS = ("_line", "_file", "_reasons")
FIELDS = "number of fields"


@dataclass(frozen=True)
class Checked:
    """``rows`` of a table that fit, and ``rejected`` ones: table_name, file, line, reasons."""

    rows: DataFrame
    rejected: DataFrame


def _reasons(found: Column) -> Column:
    """The misfits of a row as a text."""
    told = F.transform(
        found, lambda m: F.concat(m["column_name"], F.lit(": "), F.coalesce(m["value"], F.lit("NULL")), F.lit(" is no "), m["column_limit"])
    )
    return F.array_join(told, "; ")


def typed(raw: DataFrame, schema: dict[str, str], line: Column, file: Column, wrong_count: Column) -> DataFrame:
    """Rows of text columns as rows of ``schema``, with the marks; ``_reasons`` is empty where a row fits."""
    count = F.struct(F.lit(FIELDS).alias("column_name"), line.alias("value"), F.lit(f"row of {len(schema)}").alias("column_limit"))
    found = F.when(wrong_count, F.array(count).cast(MISFITS)).otherwise(misfits(schema))
    return raw.select(
        *(F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in schema.items()),
        line.alias("_line"),
        file.alias("_file"),
        _reasons(found).alias("_reasons"),
    )


def read_marked(spark: SparkSession, folder: str, table: str, fmt: str = "csv", schema: str | None = None) -> DataFrame:
    """All rows of an input table, typed, with the marks.

    CSV fields go by position. The line is the source line where the number of fields is wrong, else its fields written
    again as CSV. Columnar formats carry their types, so their rows fit, and have no line.
    """
    if fmt != "csv":
        rows = spark.read.format(fmt).load(f"{folder}/{table}")
        return rows.withColumns({"_line": F.lit(None).cast("string"), "_file": F.col("_metadata.file_path"), "_reasons": F.lit("")})
    columns = columns_of(schema or schemas.INPUTS[table])
    text = ", ".join(f"`{name}` STRING" for name in [*columns, CORRUPT])
    raw = spark.read.schema(text).option("header", True).option("columnNameOfCorruptRecord", CORRUPT).csv(f"{folder}/{table}.csv")
    again = F.to_csv(F.struct(*(F.col(f"`{name}`") for name in columns)))
    return typed(raw, columns, F.coalesce(CORRUPT, again), F.col("_metadata.file_path"), F.col(CORRUPT).isNotNull())


def split(marked: DataFrame, table: str) -> Checked:
    """Both kinds of rows of a marked table. Each is a read of its own unless the table is stored (``split_once``)."""
    columns = [F.col(f"`{c}`") for c in marked.columns if c not in MARKS]
    rejected = marked.where("_reasons <> ''").select(
        F.lit(table).alias("table_name"), F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reasons").alias("reasons")
    )
    return Checked(marked.where("_reasons = ''").select(*columns), rejected)


def split_once(marked: DataFrame, table: str, folder: str) -> Checked:
    """Parses the source once: stores the marked rows under ``folder``, apart by whether they fit, and reads them there.

    What follows reads columns of Parquet instead of lines of text, and of the rejected rows only their own partition.
    """
    path = f"{folder}/{table}"
    marked.withColumn("_fits", F.col("_reasons") == "").write.partitionBy("_fits").parquet(path)
    stored = marked.sparkSession.read.schema(f"{marked.schema.toDDL()}, _fits BOOLEAN").parquet(path)
    return Checked(split(stored.where("_fits").drop("_fits"), table).rows, split(stored.where("not _fits").drop("_fits"), table).rejected)


def read_checked_inputs(
    spark: SparkSession, folder: str, fmt: str = "csv", into: str | None = None, tables: Iterable[str] = schemas.INPUTS
) -> dict[str, Checked]:
    """All input tables with their rejected rows; ``into`` is a folder to store them in, each source parsed once."""
    marked = {table: read_marked(spark, folder, table, fmt) for table in tables}
    return {t: split(m, t) if into is None else split_once(m, t, into) for t, m in marked.items()}


def all_rejected(checked: Iterable[Checked]) -> DataFrame:
    """The rejected rows of several tables."""
    first, *others = (c.rejected for c in checked)
    for other in others:
        first = first.unionByName(other)
    return first


def opened(lines: DataFrame, line: str = "line") -> DataFrame:
    """Adds ``entries`` and ``corrupt`` to lines of JSON envelopes ``{data: [{data: {...}}]}``.

    entries has the typed institutions of an envelope, a field that is not a number as NULL; it is empty for an envelope
    without data, and NULL, with the text as ``corrupt``, for a line that is not JSON. Blank and NULL lines are neither.
    """
    kind = f"{schemas.FINANCIALS_ENVELOPE}, {CORRUPT} STRING"
    text = F.when(F.trim(F.col(line)) != "", F.col(line))
    parsed = F.from_json(text, kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    found = lines.withColumn("_parsed", parsed)
    institutions = F.transform(
        F.filter(F.coalesce(F.col("_parsed.data"), F.array()), lambda e: e.isNotNull() & e["data"].isNotNull()),
        lambda e: F.struct(*(e["data"][name].try_cast(kind).alias(name) for name, kind in schemas.FINANCIALS.items())),
    )
    bad = F.col(f"_parsed.{CORRUPT}")
    return found.withColumns({"entries": F.when(bad.isNull(), institutions), "corrupt": bad}).drop("_parsed")


def institutions(found: DataFrame) -> DataFrame:
    """One row for each entry of ``opened`` lines."""
    # Not the plain explode: Spark puts a filter on its array before it, and would parse each line for that once more.
    return found.select(F.explode_outer("entries").alias("_entry")).where("_entry is not null").select("_entry.*")


def read_checked_financials(spark: SparkSession, path: str, multi_line: bool = False) -> Checked:
    """Institution financials and the lines that are not JSON; with ``multi_line`` a file is one line.

    ``files.read_financials`` ends at the first such line.
    """
    text = spark.read.text(path, wholetext=multi_line)
    lines = text.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    found = opened(lines)
    rejected = found.where(F.col("corrupt").isNotNull()).select(
        F.lit("financials").alias("table_name"), "file", F.col("corrupt").alias("line"), F.lit("not JSON").alias("reasons")
    )
    return Checked(institutions(found), rejected)

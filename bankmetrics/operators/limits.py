"""Values that do not fit a column: all of them, with row and column, where a write would stop at the first."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISFITS = "array<struct<column_name:string,value:string,column_limit:string>>"

_TEXT = re.compile(r"(?:VAR)?CHAR\((\d+)\)", re.IGNORECASE)
_REQUIRED = re.compile(r"\s+NOT\s+NULL$", re.IGNORECASE)


def columns_of(ddl: str) -> dict[str, str]:
    """Column names and limits of a DDL string such as ``id VARCHAR(50) NOT NULL, amount DECIMAL(10,4)``.

    A DEFAULT is no limit.
    """
    parts = re.split(r",(?![^(]*\))", ddl)
    plain = [re.sub(r"\s+DEFAULT\s+.*", "", part.strip(), flags=re.IGNORECASE | re.DOTALL) for part in parts]
    return {name: kind.strip() for name, kind in (part.split(None, 1) for part in plain)}


def fits(value: Column, limit: str) -> Column:
    """Whether a value can be stored in a column of that limit; never NULL.

    The limit is a type, VARCHAR(n) and CHAR(n) included, with or without NOT NULL. A number with more digits after the
    point than the column fits, as it is rounded; a text has to be a value of the type as a whole.
    """
    kind, required = _REQUIRED.sub("", limit), bool(_REQUIRED.search(limit))
    text = _TEXT.fullmatch(kind)
    if text:
        good = F.length(value.cast("string")) <= int(text[1])
    elif kind.upper() == "STRING":
        good = F.lit(True)
    else:
        good = value.try_cast(kind).isNotNull()
    return F.when(value.isNull(), F.lit(not required)).otherwise(good)


def misfits(limits: dict[str, str]) -> Column:
    """Name, value and limit of each column of a row that does not fit, in the order of ``limits``."""
    each = [
        F.when(
            ~fits(F.col(f"`{name}`"), limit),
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"`{name}`").cast("string").alias("value"),
                F.lit(limit).alias("column_limit"),
            ),
        )
        for name, limit in limits.items()
    ]
    return F.array_compact(F.array(*each)).cast(MISFITS)


def over_limits(rows: DataFrame, limits: dict[str, str], *keys: str) -> DataFrame:
    """One row for each value of ``rows`` that does not fit: the keys, column_name, value and column_limit.

    One narrow pass without a shuffle; a row with several such values gives several rows.
    """
    return rows.select(*(F.col(f"`{k}`") for k in keys), F.inline(misfits(limits)))

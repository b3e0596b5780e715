"""Typed cells from text, and from columns of other types."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The spellings that a CSV reader takes as a missing value.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def quoted(name: str) -> str:
    """A column name safe for names with dots, slashes, blanks or backticks."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def one_row(spark: SparkSession, record: Mapping[str, Any], schema: str) -> DataFrame:
    """A table of one row from literals, which unlike Python rows needs no job of its own."""
    kinds = T.StructType.fromDDL(schema)
    cells = [F.lit(record[f.name]).cast(f.dataType).alias(f.name) for f in kinds]
    return spark.range(0, 1, 1, 1).select(*cells)


def text_cell(value: Column) -> Column:
    return F.when(~value.isin(*MISSING_TEXT), value)


def number(value: Column) -> Column:
    """Double, with NaN as null so that aggregates and grouping see one missing value."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def bad_number(raw: Column) -> Column:
    """1 where text is neither a number nor a spelling of missing."""
    return F.when(
        raw.isNotNull() & raw.try_cast("double").isNull() & ~raw.isin(*MISSING_TEXT), 1
    ).otherwise(0)


def whole_number(value: Column) -> Column:
    """Integer where the number is whole, else null (0.5 must not become 0)."""
    real = value.try_cast("double")
    return F.when(real == F.floor(real), real.try_cast("int"))

"""Exact duplicate removal and its row counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from oddrow.functions.cells import column
from oddrow.sources.storage import Scratch
from oddrow.sources.tables import BAD_CELLS

# Rows of the input that each kept row stands for.
COPIES = "_copies"


# Types whose minimum a hash aggregate can hold.
FIXED_WIDTH = (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType)


def _others(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> list[str]:
    others = [c for c in order if c not in subset]
    return others + [
        c for c in df.columns if c not in subset and c not in others and c != BAD_CELLS
    ]


def dedup(df: DataFrame, subset: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per distinct ``subset``, with ``_copies`` counting its input rows.

    Of the other columns the row that sorts first by ``order`` (then by the remaining
    columns) survives. This is a grouped aggregate and not a window, so copies collapse
    before the shuffle and a row repeated very often costs no task more than others. Rows
    group by a hash first: sorting by it is nearly always decided by one long.
    """
    others = _others(df, subset, order)
    aggregates = [F.count(F.lit(1)).alias(COPIES)]
    if others:
        aggregates.append(F.min(F.struct(*[column(c).alias(f"o{i}") for i, c in enumerate(others)]))
                          .alias("_first"))
    if BAD_CELLS in df.columns:
        aggregates.append(F.sum(BAD_CELLS).alias(BAD_CELLS))
    grouping = [column(c) for c in subset]
    if others:
        grouping.insert(0, F.xxhash64(*grouping).alias("_hash"))
    grouped = df.groupBy(*grouping).agg(*aggregates)
    kept = {c: column(c) for c in subset}
    kept |= {c: F.col(f"_first.o{i}").alias(c) for i, c in enumerate(others)}
    kept |= {BAD_CELLS: F.col(BAD_CELLS)}
    return grouped.select(*[kept[c] for c in df.columns], COPIES)


def dedup_stored(
    df: DataFrame,
    subset: Sequence[str],
    order: Sequence[str],
    scratch: Scratch,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """:func:`dedup` as a stored table, in two stages, with ``extra`` columns made of the row.

    A hash aggregate counts the rows of each key and holds the least value of every other column,
    which is the row itself where the key has one row; nothing is sorted. Only keys with copies
    go through the ordered pick: their rows are found again by the hash of the key. Columns that
    are not of a fixed width cannot be held so; tables with such columns take one stage.
    """
    others = _others(df, subset, order)
    made = dict(extra or {})
    if not all(isinstance(df.schema[c].dataType, FIXED_WIDTH) for c in others):
        return scratch.keep(dedup(df, subset, order).withColumns(made), "rows")
    rest = [*others, *([BAD_CELLS] if BAD_CELLS in df.columns else [])]
    least = [F.min(column(c)).alias(c) for c in rest]
    counted = df.groupBy(*[column(c) for c in subset]).agg(
        F.count(F.lit(1)).alias(COPIES), *least
    )
    kept = [column(c) for c in df.columns]
    rows = scratch.keep(counted.select(*kept, COPIES).withColumns(made), "rows")
    repeated = rows.filter(F.col(COPIES) > 1)
    if not others or repeated.isEmpty():
        return rows
    key = F.xxhash64(*[column(c) for c in subset])
    hashes = repeated.select(key.alias("_hash")).distinct()
    again = df.withColumn("_hash", key).join(hashes, "_hash", "left_semi").drop("_hash")
    # A key without copies may share the hash of one that has some.
    picked = dedup(again, subset, order).filter(F.col(COPIES) > 1).withColumns(made)
    return rows.filter(F.col(COPIES) == 1).unionByName(scratch.keep(picked, "picked"))


def dedup_report(deduped: DataFrame) -> DataFrame:
    """One row: rows before, rows removed, rows after."""
    return deduped.agg(
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("rows_removed"),
        F.count(F.lit(1)).alias("rows_after"),
    )


def dedup_counts(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """:func:`dedup_report` of a table that has not been deduplicated yet."""
    grouped = df.groupBy(*[column(c) for c in subset]).agg(F.count(F.lit(1)).alias(COPIES))
    return dedup_report(grouped)

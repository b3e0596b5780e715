"""Running totals in a global order, without one task that sees all rows. DataFrames only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrow.sources.storage import Scratch


def running_total(
    rows: DataFrame, order: Sequence[Column], value: str, name: str, scratch: Scratch
) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` up to and including each row.

    Rows are cut into ranges of the order by Spark's range partitioning and stored with the number
    of their range; sums are taken inside ranges and moved by the totals of the ranges before,
    which are one row for each shuffle partition.
    """
    ranges = scratch.keep(
        rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()),
        f"ranges-of-{name}",
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = totals.select(
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = (
        Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        ranges.join(F.broadcast(before), F.col("_range") == F.col("_of"))
        .withColumn(name, F.sum(value).over(inside) + F.col("_before"))
        .drop("_range", "_of", "_before")
    )

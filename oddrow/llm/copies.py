"""Rows that stand for several equal ones, told apart again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

#: Copies that one task makes of a row at a time.
CHUNK = 10_000


def one_by_one(rows: DataFrame, times: str, ordinal: str, chunk: int = CHUNK) -> DataFrame:
    """Every row ``times`` times, numbered from 0 in ``ordinal``.

    Rows with many copies are cut into chunks that are dealt over the tasks before they are made.
    """
    n = F.col(times)
    told_apart = [f.name for f in rows.schema if isinstance(f.dataType, AtomicType)]
    few = rows.filter(n <= chunk).withColumn(
        ordinal, F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))
    )
    first = F.col("_chunk") * chunk
    many = (
        rows.filter(n > chunk)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), ((n - 1) / chunk).cast("int"))))
        .repartition("_chunk", *(F.col(c) for c in told_apart))
        .withColumn(
            ordinal,
            F.explode(F.sequence(first.cast("long"), F.least(first + chunk, n).cast("long") - 1)),
        )
        .drop("_chunk")
    )
    return few.unionByName(many)

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oddrow.shipping import ship_package

WHITE_SPACE = " \t\n\x0b\x0c\r"
NOT_WORD = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ids_and_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with whatever other columns there are left out; null texts stay null."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def packed(docs: DataFrame) -> DataFrame:
    """Every row as one value ``row``, so that no column name can clash with a new one."""
    quoted = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return docs.select(F.struct(*quoted).alias("row"))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("row.*")


def word_count(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    parts = F.split(text, NOT_WORD)
    edges = F.when(parts[0] == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return (F.size(parts) - edges).cast("long")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null ids give null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def small_batches(
    batches: Iterable[pa.RecordBatch], most: int = 8_000_000
) -> Iterator[pa.RecordBatch]:
    """Slices of about ``most`` bytes, so that what is made of long texts does not pile up."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * most / max(most, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_batches(df: DataFrame, function, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package on the workers' path.

    Workers serve later stages too, so a task gives its buffers back when its batches end.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)

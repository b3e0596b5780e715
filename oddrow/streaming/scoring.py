"""Continuous scoring: the batch scoring plan, which keeps no state, on a streaming source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oddrow.plans.jobs import score


def score_stream(spark: SparkSession, rows: DataFrame, run: str) -> DataFrame:
    """Streaming rows of the run's profile with ``mse`` and ``prediction``; copies are kept."""
    return score(spark, rows, run, dedup_rows=False)

"""Decisions on reconstruction errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def anomaly_flag(score: Column, threshold: Column | float) -> Column:
    """1 iff score >= threshold; NaN and missing scores give 0 (Spark orders NaN last)."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((score >= limit) & ~F.isnan(score), F.lit(False)).cast("int")


def mean_square(values: Sequence[Column]) -> Column:
    """Mean of the squares: the error of rebuilding standard scores by their mean, zero."""
    total = values[0] * values[0]
    for value in values[1:]:
        total = total + value * value
    return total / F.lit(float(len(values)))

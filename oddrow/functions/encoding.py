"""One-hot and standard-score expressions from fitted state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def one_hot(value: Column, categories: Sequence[str | None]) -> Column:
    """Array with one slot per category; unseen values give all zeros.

    The categories are one literal and the slots come from array functions, so the
    generated code does not grow with the number of categories.
    """
    width = len(categories)
    zero, one = F.lit(0.0), F.lit(1.0)
    if width == 0:
        return F.array().cast("array<double>")
    known = [c for c in categories if c is not None]
    place = F.array_position(F.lit(known), value) if known else F.lit(0)
    missing_place = categories.index(None) + 1 if None in categories else 0
    place = F.when(value.isNull(), missing_place).otherwise(place).cast("int")
    return F.when(place == 0, F.array_repeat(zero, width)).otherwise(
        F.concat(
            F.array_repeat(zero, place - 1), F.array(one), F.array_repeat(zero, width - place)
        )
    )


def standard_score(value: Column, mean: float, scale: float) -> Column:
    return (value - F.lit(mean)) / F.lit(scale)

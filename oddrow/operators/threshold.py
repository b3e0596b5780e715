"""The alarm threshold: an exact, interpolated percentile of the training errors."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.errors import InferenceError
from oddrow.functions.cells import column, number

# Values that the driver takes at a time: a sample that proposes an interval, or the last few.
FETCH_ROWS = 16_384
SAMPLE_SEED = 42


@dataclass(frozen=True)
class Threshold:
    threshold: float
    percentile: int
    mse_mean: float
    mse_std: float


def sampled_values(values: DataFrame, rows: int, size: int = FETCH_ROWS) -> np.ndarray:
    """About ``size`` of the ``rows`` values of the column ``x``, sorted; all if there are fewer.

    A sample only ever proposes bounds, which exact counts then confirm. Quantile sketches would
    bring every task's sketch to a single task.
    """
    if rows > size:
        values = values.sample(fraction=size / rows, seed=SAMPLE_SEED)
    return np.sort(values.select("x").toPandas()["x"].to_numpy())


def _interval(sample: np.ndarray, share: float) -> tuple[float, float]:
    """Sample values around a quantile, wide enough to hold it almost surely."""
    m = len(sample)
    center = share * m
    margin = 4.0 * math.sqrt(m * share * (1.0 - share)) + 8.0
    low, high = math.floor(center - margin), math.ceil(center + margin)
    if low <= 0 and high >= m - 1:
        # Too few values for an interval: a pivot halves the range instead.
        low = high = min(math.floor(center), m - 1)
    return float(sample[max(low, 0)]), float(sample[min(high, m - 1)])


def kth_smallest(values: DataFrame, k: int, n: int, fetch_rows: int = FETCH_ROWS) -> float:
    """The value of rank ``k`` (from 0) among ``n`` non-null values of the column ``x``.

    A sample proposes an interval, exact counts confirm or correct it, and the search goes on
    strictly inside or outside, so heavily tied values leave the interval in one round.
    """
    x = F.col("x")
    inside, below, count = values, 0, n
    while count > fetch_rows:
        sample = sampled_values(inside, count, fetch_rows)
        if not len(sample):
            sample = np.array([inside.first().x])
        lo, hi = _interval(sample, (k - below + 0.5) / count)
        c = inside.agg(
            F.count_if(x < lo).alias("lt_lo"),
            F.count_if(x <= lo).alias("le_lo"),
            F.count_if(x < hi).alias("lt_hi"),
            F.count_if(x <= hi).alias("le_hi"),
        ).first()
        place = k - below
        if c.lt_lo <= place < c.le_lo:
            return lo
        if c.lt_hi <= place < c.le_hi:
            return hi
        if place < c.lt_lo:
            inside, count = inside.filter(x < lo), c.lt_lo
        elif place >= c.le_hi:
            inside, below, count = inside.filter(x > hi), below + c.le_hi, count - c.le_hi
        else:
            inside = inside.filter((x > lo) & (x < hi))
            below, count = below + c.le_lo, c.lt_hi - c.le_lo
    return float(sampled_values(inside, count, fetch_rows)[k - below])


def exact_percentile(
    df: DataFrame,
    score: Column,
    percentile: float,
    n: int | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> float | None:
    """Linear-interpolated percentile of the non-missing scores; None without any."""
    values = df.select(number(score).alias("x")).filter("x is not null")
    if n is None:
        n = values.count()
    if n == 0:
        return None
    position = (n - 1) * (percentile / 100.0)
    k = math.floor(position)
    lower = kth_smallest(values, k, n, fetch_rows)
    part = position - k
    if part == 0.0:
        return lower
    tail = values.agg(
        F.count_if(F.col("x") <= lower).alias("upto"),
        F.min(F.when(F.col("x") > lower, F.col("x"))).alias("next"),
    ).first()
    upper = lower if tail.upto > k + 1 else tail.next
    return lower * (1 - part) + upper * part


def fit_threshold(
    df: DataFrame, percentile: int, score: str = "mse", fetch_rows: int = FETCH_ROWS
) -> Threshold:
    """Threshold with mean and population deviation of the scores; one way for every size."""
    x = number(column(score))
    measures = [F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.count(x).alias("n")]
    stats = df.agg(*measures).first()
    if not stats["n"]:
        raise InferenceError("threshold not computed: there are no scores to take it from")
    value = exact_percentile(df, x, percentile, stats["n"], fetch_rows)
    return Threshold(value, percentile, stats["mean"], stats["std"])


def score_stats(df: DataFrame, score: str = "mse") -> DataFrame:
    """One row: mean and population deviation of a score column."""
    x = number(column(score))
    return df.agg(F.avg(x).alias("mse_mean"), F.stddev_pop(x).alias("mse_std"))

"""Fitted preprocessing: one-hot categories and standard scaling, learned from training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.errors import ConfigurationError, InferenceError
from oddrow.functions.cells import column
from oddrow.functions.encoding import one_hot, standard_score
from oddrow.params import ArchitectureParams
from oddrow.profiles import Profile
from oddrow.sources.tables import check_columns

FEATURES = "features"

# A one-hot block is dense model input, and its categories travel as a plan literal.
MAX_CATEGORIES = ArchitectureParams.max_categories
# A spread below this share of the mean is rounding noise of a constant column.
CONSTANT_SPREAD = 10 * float(np.finfo(np.float64).eps)


def category_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct categories per column in long form; a missing value is a category."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, category string")
    parts = F.array(
        *[
            F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("category"))
            for c in columns
        ]
    )
    return df.select(F.explode(parts).alias("p")).select("p.*").distinct()


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation per column, missing cells left out."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        aggregates.append(F.avg(column(c)).alias(f"mean_{i}"))
        aggregates.append(F.stddev_pop(column(c)).alias(f"std_{i}"))
    return df.agg(*aggregates)


def scale_of(mean: float, std: float) -> float:
    """Divisor of a column; constant columns are only centred."""
    return 1.0 if std <= CONSTANT_SPREAD * abs(mean) else std


@dataclass(frozen=True)
class ColumnScale:
    column: str
    mean: float
    std: float

    @property
    def scale(self) -> float:
        return scale_of(self.mean, self.std)


@dataclass(frozen=True)
class Preprocessor:
    """Fitted state; encodes rows with one projection and no shuffle."""

    categories: tuple[tuple[str, tuple[str | None, ...]], ...]
    scales: tuple[ColumnScale, ...]

    @property
    def width(self) -> int:
        return sum(len(values) for _, values in self.categories) + len(self.scales)

    @property
    def names(self) -> list[str]:
        """Feature names in array order."""
        slots = [f"{c}={v}" for c, values in self.categories for v in values]
        return slots + [s.column for s in self.scales]

    def feature_array(self, element: str = "double") -> Column:
        """One-hot blocks, then scaled numbers, as an array of ``double`` or ``float``.

        The array is cast as a whole: a cast per cell makes the generated method of a wide
        table too large for the JVM to compile.
        """
        blocks = [one_hot(column(c).cast("string"), values) for c, values in self.categories]
        numbers = [standard_score(column(s.column), s.mean, s.scale) for s in self.scales]
        if numbers:
            blocks.append(F.array(*numbers))
        features = F.concat(*blocks) if len(blocks) > 1 else blocks[0]
        return features if element == "double" else features.cast(f"array<{element}>")

    def transform(self, df: DataFrame, element: str = "double") -> DataFrame:
        """Add ``features``; ``float`` is what a float32 model takes."""
        wanted = [c for c, _ in self.categories] + [s.column for s in self.scales]
        missing = [c for c in wanted if c not in df.columns]
        if missing:
            raise InferenceError(f"rows to encode lack fitted columns: {missing}")
        return df.withColumn(FEATURES, self.feature_array(element))


def _categories(
    df: DataFrame, columns: Sequence[str], most: int
) -> dict[str, list[str | None]]:
    """The sorted categories of each column; distinct values are counted before any is listed."""
    values = category_table(df, columns)
    counts = {r["column"]: r["count"] for r in values.groupBy("column").count().collect()}
    wide = {c: n for c, n in sorted(counts.items()) if n > most}
    if wide:
        raise ConfigurationError(
            f"more than {most} categories: {wide}; one-hot encoding them needs a higher "
            "'architecture.max_categories'"
        )
    found: dict[str, list[str | None]] = {c: [] for c in columns}
    for row in values.collect():
        found[row["column"]].append(row["category"])
    # A missing value sorts last.
    return {c: sorted(v, key=lambda x: (x is None, x or "")) for c, v in found.items()}


def fit_preprocessor(
    train: DataFrame, profile: Profile, max_categories: int = MAX_CATEGORIES
) -> Preprocessor:
    """Learn categories and scales; pass training rows only.

    A column with more than ``max_categories`` distinct values is refused: every category is an
    input of the model and a literal of the plan.
    """
    check_columns(train.columns, profile, "training rows", label_required=False)
    found = {}
    if profile.categorical:
        found = _categories(train, profile.categorical, max_categories)
    row = moments(train, profile.numeric).first()
    if not row["rows"]:
        raise InferenceError("cannot fit a preprocessor on zero rows")
    empty = [c for i, c in enumerate(profile.numeric) if row[f"mean_{i}"] is None]
    if empty:
        raise InferenceError(f"training rows hold no value at all in columns: {empty}")
    scales = tuple(
        ColumnScale(c, row[f"mean_{i}"], row[f"std_{i}"]) for i, c in enumerate(profile.numeric)
    )
    return Preprocessor(tuple((c, tuple(v)) for c, v in found.items()), scales)


def feature_columns(df: DataFrame, width: int) -> list[Column]:
    """The feature array as columns f0, f1, ..."""
    return [F.element_at(FEATURES, i + 1).alias(f"f{i}") for i in range(width)]

"""Class counts and the data-quality gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.errors import DataLoadError, SchemaValidationError
from oddrow.functions.cells import column
from oddrow.functions.labels import is_normal
from oddrow.operators.dedup import COPIES
from oddrow.profiles import Profile
from oddrow.sources.tables import BAD_CELLS

_INFINITE = (float("inf"), float("-inf"))


def class_counts(df: DataFrame, profile: Profile) -> DataFrame:
    """One row: total, normal and attack records."""
    normal = F.count_if(is_normal(profile))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), normal.alias("normal"), (total - normal).alias("attack")
    )


def distinct_labels(df: DataFrame, profile: Profile) -> DataFrame:
    """One row per label value, with its records."""
    return df.groupBy(column(profile.label).alias("label")).agg(F.count(F.lit(1)).alias("records"))


def quality_counts(df: DataFrame, profile: Profile) -> DataFrame:
    """One row: classes, then missing and infinite cells per feature column by position."""
    label = column(profile.label)
    counts = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_normal(profile)).alias("normal"),
        F.count_if(label.isNotNull() & ~is_normal(profile)).alias("attack"),
        F.count_if(label.isNull()).alias("missing_label"),
    ]
    counts += [
        F.count_if(column(c).isNull()).alias(f"missing_{i}")
        for i, c in enumerate(profile.features)
    ]
    counts += [
        F.count_if(column(c).isin(*_INFINITE)).alias(f"infinite_{i}")
        for i, c in enumerate(profile.features)
        if c in profile.numeric
    ]
    return df.agg(*counts)


def _probe(profile: Profile) -> Column:
    """Zero for a row of finite numbers, NaN with an infinite one, null with a missing cell.

    A chain of products costs a wide table far less than a test per column.
    """
    zero = F.lit(0.0)
    probe = zero
    for c in profile.numeric:
        probe = probe + column(c) * zero
    for c in profile.categorical:
        probe = F.when(column(c).isNotNull(), probe)
    return probe


@dataclass(frozen=True)
class Quality:
    """Counts of a table; the per-column counts are taken only if some row has a gap."""

    total: int
    normal: int
    attack: int
    rows_before: int
    missing_label: int
    missing: dict[str, int]
    infinite: dict[str, int]
    bad_cells: int

    @property
    def rows_removed(self) -> int:
        return self.rows_before - self.total

    @classmethod
    def of(cls, df: DataFrame, profile: Profile) -> Quality:
        probe = _probe(profile)
        counts = [
            F.count(F.lit(1)).alias("total"),
            F.count_if(is_normal(profile)).alias("normal"),
            F.count_if(column(profile.label).isNull()).alias("missing_label"),
            F.count_if(probe.isNull() | F.isnan(probe)).alias("gaps"),
        ]
        if COPIES in df.columns:
            counts.append(F.sum(COPIES).alias("rows_before"))
        if BAD_CELLS in df.columns:
            counts.append(F.sum(BAD_CELLS).alias("bad_cells"))
        row = df.agg(*counts).first().asDict()
        detail = quality_counts(df, profile).first().asDict() if row["gaps"] else {}

        def cells(kind: str) -> dict[str, int]:
            found = {c: detail.get(f"{kind}_{i}", 0) for i, c in enumerate(profile.features)}
            return {c: n for c, n in found.items() if n}

        return cls(
            total=row["total"],
            normal=row["normal"],
            attack=row["total"] - row["normal"],
            rows_before=row.get("rows_before") or row["total"],
            missing_label=row["missing_label"],
            missing=cells("missing"),
            infinite=cells("infinite"),
            bad_cells=row.get("bad_cells") or 0,
        )

    def check_values(self, source: str) -> None:
        """Numbers must be numbers: unreadable, missing or infinite cells stop the job."""
        problems = []
        if self.bad_cells:
            problems.append(f"{self.bad_cells} unreadable numbers or rows of a wrong length")
        if self.missing:
            problems.append(f"missing values in {self.missing}")
        if self.infinite:
            problems.append(f"infinite values in {self.infinite}")
        if problems:
            raise SchemaValidationError(f"'{source}' fails the quality gate: {'; '.join(problems)}")

    def check_prepared(self, source: str) -> None:
        """The gate on prepared data: some rows, every label known, both classes, no gaps."""
        if self.total == 0:
            raise DataLoadError(f"prepared dataset is empty: {source}")
        if self.missing_label:
            raise SchemaValidationError(
                f"'{source}': the label column has {self.missing_label} missing values"
            )
        if not self.normal or not self.attack:
            raise SchemaValidationError(
                f"'{source}' must hold normal and attack labels, found {self.normal} normal "
                f"and {self.attack} attack records"
            )
        self.check_values(source)

"""Normal rows, attack rows and the binary label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oddrow.functions.cells import column
from oddrow.profiles import Profile


def is_normal(profile: Profile) -> Column:
    """Never null: a row without a label is not normal."""
    return column(profile.label).eqNullSafe(F.lit(profile.normal))


def is_attack(profile: Profile) -> Column:
    return ~is_normal(profile)


def binary_label(profile: Profile) -> Column:
    """0 for labels mapped to 0; 1 for attacks, unknown labels and missing labels."""
    zeros = [k for k, v in profile.label_map.items() if v == 0]
    return F.when(column(profile.label).isin(*zeros), 0).otherwise(1).cast("int")

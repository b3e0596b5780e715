"""Seeded pseudo-random ranks of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from oddrow.functions.cells import column

MISSING_MARK = "\\N"


def seeded_rank(seed: int, columns: Sequence[str]) -> Column:
    """32 hex digits from the seed and the named values as text; for a few key columns."""
    parts = [F.coalesce(column(c).cast("string"), F.lit(MISSING_MARK)) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def seeded_row_rank(seed: int, columns: Sequence[str]) -> Column:
    """32 hex digits from the seed and 128 bits of hash over many columns of any type.

    Hashing binary values costs a wide table far less than spelling them out.
    """
    cells = [column(c) for c in columns]
    halves = [F.xxhash64(F.lit(part), *cells).cast("string") for part in ("a", "b")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *halves))

"""Bounded samples of rows to fit a model on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import ids_and_texts
from oddrow.sources.storage import Scratch

SEED = 11


def _place(*columns: str) -> Column:
    """A hash as a number from 0 to 1."""
    return (F.xxhash64(F.lit(SEED), *columns) / 2.0**63 + 1) / 2


def _share(most: int, total: int) -> float:
    """A share that nearly surely holds the ``most`` smallest of ``total`` places."""
    return min(1.0, 1.2 * most / total + 1_000 / total) if total else 1.0


def sample_ids(rows: DataFrame, most: int, column: str = "doc_id") -> DataFrame:
    """At most ``most`` distinct ids: those of the smallest hashes."""
    ids = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    return (
        ids.withColumn("_place", _place(column))
        .filter(F.col("_place") <= _share(most, ids.count()))
        .orderBy("_place", column)
        .limit(most)
        .select(column)
    )


def sample_texts(
    docs: DataFrame, ids: DataFrame, limits: dict[int, int], scratch: Scratch
) -> DataFrame:
    """(role, doc_id, text): the different texts of ``ids`` (doc_id, role), at most
    ``limits[role]`` of each role, by the smallest hashes.

    An id may have any number of rows, so rows are bounded here and not only ids: repeated ones
    fall together, and the rest is cut by a hash of id and text before texts are moved.
    """
    named = ["role", "doc_id", "mark"]
    rows = (
        ids_and_texts(docs)
        .join(F.broadcast(ids), "doc_id")
        .withColumn("mark", F.xxhash64("text"))
    )
    found = rows.select(*named).distinct().groupBy("role").count().collect()
    totals = {r["role"]: r["count"] for r in found}
    place, near = _place("doc_id", "mark"), F.lit(False)
    for role, most in limits.items():
        near |= (F.col("role") == role) & (place <= _share(most, totals.get(role, 0)))
    few = scratch.keep(rows.filter(near).dropDuplicates(named), "sample")
    parts = [
        few.filter(F.col("role") == role).orderBy(place, "doc_id", "mark").limit(most)
        for role, most in limits.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return scratch.keep(out.select("role", "doc_id", "text"), "bounded")

"""Exact-size seeded selection of rows: train/validation split and sampling.

Rows are ordered by a seeded hash. Only the hash value at the cut is looked for, by counting
rows per hash prefix (a bounded number of groups); the selection itself is then a comparison
with a literal, so no row is shuffled, ranked or sorted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.errors import DataLoadError
from oddrow.functions.ranks import seeded_rank, seeded_row_rank

HASH_DIGITS = 32
# 16**3 prefix groups per counting pass; the bucket at the cut is fetched once it is this small.
PREFIX_STEP = 3
FETCH_ROWS = 65_536
REPLICA_CHUNK = 1_000_000
# Samples of at most so many rows are taken in one scan.
HEAP_ROWS = 1_000

# Column with the hash of the key, for tables that are selected from more than once.
RANK = "_rank"
SPLIT = "split"
TRAIN, VALIDATION, ATTACK = "train", "val", "attack"


@dataclass(frozen=True)
class Cut:
    """``chosen`` holds for ``taken`` rows, less ``from_ties`` of the identical rows at ``tie``."""

    chosen: Column
    total: int
    taken: int
    tie: Column | None = None
    from_ties: int = 0


def find_cut(
    df: DataFrame,
    ranks: Sequence[Column],
    size: Callable[[int], int],
    fetch_rows: int = FETCH_ROWS,
) -> Cut:
    """Cut off the ``size(total)`` lowest rows in the order given by the hash columns."""
    scope = df.select(*[r.alias(f"r{i}") for i, r in enumerate(ranks)])
    chosen: Column = F.lit(False)
    at: Column = F.lit(True)
    total: int | None = None
    need = 0
    for level, rank in enumerate(ranks):
        name = f"r{level}"
        prefix = ""
        while len(prefix) < HASH_DIGITS:
            width = len(prefix) + PREFIX_STEP
            start = F.substring(name, 1, width).alias("p")
            here = scope.filter(F.col(name).startswith(prefix)) if prefix else scope
            measures = [F.count(F.lit(1)).alias("count")]
            if prefix:
                # Cheap below the first prefix, and shows a bucket made of one hash only.
                measures += [F.min(name).alias("low"), F.max(name).alias("high")]
            counts = here.groupBy(start).agg(*measures).toPandas().sort_values("p")
            if total is None:
                total = int(counts["count"].sum())
                need = min(max(size(total), 0), total)
                taken = need
                if need in (0, total):
                    return Cut(F.lit(need > 0), total, taken)
            running = counts["count"].to_numpy().cumsum()
            place = int(np.searchsorted(running, need))
            need -= int(running[place - 1]) if place else 0
            inside = int(counts["count"].iloc[place])
            prefix = str(counts["p"].iloc[place])
            head = F.substring(rank, 1, len(prefix))
            if need == inside:
                return Cut(chosen | (at & (head <= prefix)), total, taken)
            if "low" in counts and counts["low"].iloc[place] == counts["high"].iloc[place]:
                prefix = str(counts["low"].iloc[place])
            elif inside <= fetch_rows:
                values = sorted(
                    scope.filter(F.col(name).startswith(prefix)).select(name).toPandas()[name]
                )
                prefix = values[need - 1]
                before = values.index(prefix)
                if values.count(prefix) == need - before:
                    return Cut(chosen | (at & (rank <= prefix)), total, taken)
                need -= before
        chosen = chosen | (at & (rank < prefix))
        at = at & (rank == prefix)
        scope = scope.filter(F.col(name) == prefix)
    return Cut(chosen, total, taken, at, need)


def _identical_rows(df: DataFrame, tie: Column) -> DataFrame:
    """The rows at a tie, numbered; they agree in every column, so one stands for all."""
    at = df.filter(tie)
    count = at.count()
    last_chunk = (count - 1) // REPLICA_CHUNK
    one = at.limit(1).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(last_chunk))))
    spread = one.repartition(last_chunk + 1, "_chunk") if last_chunk else one
    first = F.col("_chunk").cast("long") * REPLICA_CHUNK
    ordinals = F.sequence(first, F.least(first + REPLICA_CHUNK, F.lit(count)) - 1)
    return spread.withColumn("_ordinal", F.explode(ordinals)).drop("_chunk")


def rank_of(seed: int, key: Sequence[str], columns: Sequence[str]) -> Column:
    """The seeded rank by the key, or by ``columns`` without one."""
    return seeded_rank(seed, key) if key else seeded_row_rank(seed, columns)


def row_ranks(df: DataFrame, seed: int, key: Sequence[str]) -> list[Column]:
    """Stored or fresh rank of the key, then of the whole row for rows that share a key."""
    columns = [c for c in df.columns if c != RANK]
    first = F.col(RANK) if RANK in df.columns else rank_of(seed, key, columns)
    return [first, seeded_row_rank(seed, columns)]


def with_rank(
    df: DataFrame, seed: int, key: Sequence[str], columns: Sequence[str] = ()
) -> DataFrame:
    """Add ``_rank``, the seeded rank by the key, or by ``columns`` (default: all) without one."""
    return df.withColumn(RANK, rank_of(seed, key, columns or df.columns))


def rank_place() -> Column:
    """A long, evenly spread, from the stored rank of a row."""
    return F.conv(F.substring(RANK, 1, 15), 16, 10).cast("long")


def mark_lowest(
    df: DataFrame,
    seed: int,
    key: Sequence[str],
    size: Callable[[int], int],
    flag: str,
    scope: Column | None = None,
) -> tuple[DataFrame, Cut]:
    """Add a boolean ``flag``, true for exactly ``size(n)`` rows of ``scope`` by seeded order."""
    ranks = row_ranks(df, seed, key)
    inside = F.lit(True) if scope is None else scope
    cut = find_cut(df if scope is None else df.filter(scope), ranks, size)
    if cut.tie is None:
        return df.withColumn(flag, inside & cut.chosen), cut
    tied = inside & cut.tie
    plain = df.filter(~tied).withColumn(flag, inside & cut.chosen)
    copies = _identical_rows(df, tied).withColumn(flag, F.col("_ordinal") < cut.from_ties)
    return plain.unionByName(copies.drop("_ordinal")), cut


def train_size(fraction: float) -> Callable[[int], int]:
    """Rows that train out of n; the rest validates."""
    return lambda n: int(fraction * n)


@dataclass(frozen=True)
class Split:
    rows: DataFrame
    n_train: int
    n_val: int


def split_normal(
    df: DataFrame, normal: Column, fraction: float, seed: int, key: Sequence[str] = ()
) -> Split:
    """Add ``split``: train or val for normal rows, in exact sizes, and attack for the rest.

    A column ``_rank`` from :func:`with_rank` is used if present.
    """
    marked, cut = mark_lowest(df, seed, key, train_size(fraction), "_train", normal)
    if cut.total < 2:
        raise DataLoadError(
            f"a train/val split needs at least 2 normal records, found {cut.total}"
        )
    if cut.taken == 0 or cut.taken == cut.total:
        raise DataLoadError(
            f"{cut.total} normal records leave the {'training' if not cut.taken else 'validation'}"
            " split empty"
        )
    name = F.when(F.col("_train"), TRAIN).when(normal, VALIDATION).otherwise(ATTACK)
    rows = marked.withColumn(SPLIT, name).drop("_train")
    return Split(rows, cut.taken, cut.total - cut.taken)


def sample_rows(df: DataFrame, n: int, seed: int, key: Sequence[str] = ()) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen by seeded order.

    A small sample is the ``n`` rows that sort first, for which every task keeps only as many:
    one scan. Rows that agree in all columns are interchangeable. A large one is cut by rank.
    """
    if n <= HEAP_ROWS:
        ranks = row_ranks(df, seed, key)
        names = [f"_order{i}" for i in range(len(ranks))]
        ordered = df.withColumns(dict(zip(names, ranks))).orderBy(*names).limit(n)
        return ordered.drop(*names)
    marked, _ = mark_lowest(df, seed, key, lambda total: min(n, total), "_chosen")
    return marked.filter("_chosen").drop("_chosen")

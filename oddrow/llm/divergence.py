"""Source divergence audit by count-level bitmaps.

The terms that a language keeps are numbered, most frequent first, in containers of 64. For every
(group, count) a container holds one bitset: the terms that occur so often in the group, a group
being the documents of one source in one language. The bitsets of two groups, ANDed and counted,
give their joint cells: how many terms occur i times here and j times there. Each cell is
multiplied by the divergence f of its two counts. Terms that a group does not have need no bitset:
cells with a zero follow by complement, from the sizes of the levels and the number of terms.

f compares shares p and q of a term in units of 10^-9, with one added to every count:
``floor((p - q)^2 / q)``. All arithmetic is in whole numbers.

Terms are counted in tasks, merged per (language, source, term), and spread by containers, which
hold at most 64 terms whatever their frequency. The table of groups is broadcast: the result has
one row for each two groups of a language, so it is small beside the result itself.

Defined cases: null text, lang and source count as empty; a language that keeps no terms has
divergence 0 between all its groups; repeated rows are documents of their own; equal values rank
by item; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrow.llm.common import map_batches, text_of
from oddrow.llm.words import LETTERS, utf8, words_of
from oddrow.sources.storage import Scratch

UNIT = 1_000_000_000
MIN_DOCUMENTS = 3
TOP_TERMS = 200
#: Terms counted in a task before their counts are passed on.
HELD_TERMS = 250_000
#: Words of an AND table, and cells, held at a time.
TABLE = 1 << 20
_CONTAINER_BITS = 6  # 64 terms: one long per bitset
GROUP = ("lang", "source")


# ------------------------------------------------------------------------- counts


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs): occurrences and documents, summed over part of a task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    words_since = 0
    for batch in batches:
        langs, sources = (batch.column(c).to_pylist() for c in GROUP)
        for lang, source, text in zip(langs, sources, utf8(batch.column("text"))):
            words = words_of(text, LETTERS)
            times, docs = held.setdefault((lang, source), (Counter(), Counter()))
            times.update(words)
            docs.update(set(words))
            words_since += len(words)
            if words_since > HELD_TERMS:
                words_since = 0
                if sum(len(t) for t, _ in held.values()) > HELD_TERMS:
                    yield from _passed_on(held)
                    held = {}
    yield from _passed_on(held)


def _passed_on(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (times, docs) in held.items():
        n = len(times)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * n, pa.string()),
                pa.array([source] * n, pa.string()),
                pa.array(list(times), pa.binary()).cast(pa.string()),
                pa.array(list(times.values()), pa.int64()),
                pa.array([docs[term] for term in times], pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def kept_terms(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, total, levels): the kept terms with their count in each group."""
    counted = map_batches(
        docs.select(*(text_of(c).alias(c) for c in (*GROUP, "text"))),
        _count,
        "lang string, source string, term string, n long, docs long",
    )
    by_group = counted.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    return (
        by_group.groupBy("lang", "term")
        .agg(
            F.sum("n").alias("total"),
            F.sum("docs").alias("docs"),
            F.collect_list(F.struct("source", "n")).alias("levels"),
        )
        .filter(F.col("docs") >= min_documents)
        .drop("docs")
    )


def numbered_terms(terms: DataFrame) -> DataFrame:
    """``terms`` with ``id``: consecutive inside a range of the order by language and count."""
    order = [F.asc("lang"), F.desc("total"), F.asc("term")]
    ranges = terms.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranges.withColumn("id", F.monotonically_increasing_id())


def group_table(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(lang, source, number, words, lang_words, kept): every group, numbered in its language."""
    groups = docs.select(*(text_of(c).alias(c) for c in GROUP)).distinct()
    words = (
        terms.select("lang", F.explode("levels").alias("level"))
        .groupBy("lang", F.col("level.source").alias("source"))
        .agg(F.sum("level.n").alias("words"))
    )
    langs = terms.groupBy("lang").agg(
        F.sum("total").alias("lang_words"), F.count("*").alias("kept")
    )
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.lit(0).cast("long")
    return (
        groups.join(words, list(GROUP), "left")
        .join(langs, "lang", "left")
        .select(
            *GROUP,
            number.alias("number"),
            *(F.coalesce(c, zero).alias(c) for c in ("words", "lang_words", "kept")),
        )
    )


# ------------------------------------------------------------------------- shares


def share(count: Column, words: Column, kept: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (words + kept)), exactly."""
    wide = "decimal(20,0)"
    parts = (count + F.lit(1)).cast(wide) * F.lit(UNIT).cast("decimal(10,0)")
    return _div(parts, (words + kept).cast(wide)) + F.lit(1)


def _div(a: Column, b: Column) -> Column:
    """The whole part of a / b, of whole numbers that are not negative."""
    return F.call_function("div", a, b)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same share of whole arrays; ``totals`` is words + kept, at least 1."""
    whole, rest = np.divmod(counts + 1, totals)
    for _ in range(3):  # three decimal places at a time stay inside 64 bits
        digits, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + digits
    return whole + 1


def divergences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


# ------------------------------------------------------------------------- bitmaps


def bitmaps(numbered: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, container, levels): levels are (number of the group, count, bitset)."""
    bit = F.lit(1).cast("long")
    shift = F.expr(f"CAST(id & {(1 << _CONTAINER_BITS) - 1} AS INT)")
    entries = numbered.select(
        "lang",
        F.shiftright("id", _CONTAINER_BITS).alias("container"),
        F.call_function("shiftleft", bit, shift).alias("bit"),
        F.explode("levels").alias("level"),
    ).select("lang", "container", "bit", "level.source", "level.n")
    levels = (
        entries.join(groups.select(*GROUP, "number"), list(GROUP))
        .repartition("lang", "container")
        .groupBy("lang", "container", "number", "n")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return levels.groupBy("lang", "container").agg(
        F.collect_list(F.struct("number", "n", "bits")).alias("levels")
    )


def _joint_cells(numbers: np.ndarray, bits: np.ndarray) -> Iterator[tuple]:
    """(level i, level j, terms) of one container with number i below number j and terms > 0."""
    rows = max(1, TABLE // len(bits))
    for at in range(0, len(bits), rows):
        both = bits[at : at + rows, None] & bits[None, :]
        i, j = np.nonzero(both)
        size = np.bitwise_count(both[i, j])
        i += at
        kept = numbers[i] < numbers[j]
        yield i[kept], j[kept], size[kept]


class _Sums:
    """Divergences between the groups of a language, summed over the terms of containers."""

    def __init__(self, totals: np.ndarray) -> None:
        self.totals = totals  # words + kept of each group
        self.absent = shares(np.zeros_like(totals), totals)
        n = len(totals)
        self.values = np.zeros((n, n), np.int64)  # p from the row's group, q from the column's
        self.never = divergences(self.absent[:, None], self.absent[None, :])
        self._clear()

    def _clear(self) -> None:
        self._levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._n_levels = self._n_cells = 0

    def add(self, numbers: np.ndarray, counts: np.ndarray, bits: np.ndarray) -> None:
        """One container."""
        self.values += int(np.bitwise_count(np.bitwise_or.reduce(bits))) * self.never
        self._levels.append((numbers, counts, np.bitwise_count(bits)))
        for i, j, size in _joint_cells(numbers, bits):
            self._cells.append((i + self._n_levels, j + self._n_levels, size))
            self._n_cells += len(i)
        self._n_levels += len(numbers)
        if self._n_cells + self._n_levels > TABLE:
            self.settle()

    def settle(self) -> None:
        """Multiply the cells gathered so far by their divergences."""
        if not self._levels:
            return
        numbers, counts, sizes = map(np.concatenate, zip(*self._levels))
        order = np.lexsort((counts, numbers))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(numbers[order]) != 0) | (np.diff(counts[order]) != 0)
        level = np.empty(len(order), np.int64)
        level[order] = np.cumsum(new) - 1
        numbers, counts = numbers[order][new], counts[order][new]
        sizes = np.bincount(level, sizes).astype(np.int64)
        here = shares(counts, self.totals[numbers])

        # Complement: every term of a level, as if the other group had none of them.
        width = max(1, TABLE // len(self.totals))
        for at in range(0, len(here), width):
            part = slice(at, at + width)
            group, p, n = numbers[part], here[part, None], sizes[part, None]
            np.add.at(
                self.values, group, n * (divergences(p, self.absent) - self.never[group])
            )
            np.add.at(
                self.values.T, group, n * (divergences(self.absent, p) - self.never.T[group])
            )

        if self._n_cells:
            i, j, terms = map(np.concatenate, zip(*self._cells))
            cell, place = np.unique(level[i] * len(here) + level[j], return_inverse=True)
            terms = np.bincount(place, terms).astype(np.int64)
            i, j = np.divmod(cell, len(here))
            for i, j in ((i, j), (j, i)):
                a, s, p, q = numbers[i], numbers[j], here[i], here[j]
                none_a, none_s = self.absent[a], self.absent[s]
                more = divergences(p, q) - divergences(p, none_s) - divergences(none_a, q)
                np.add.at(self.values, (a, s), terms * (more + self.never[a, s]))
        self._clear()


def _pairs(totals: dict[str, np.ndarray]):
    """(lang, here, there, value) of all ordered pairs of groups, summed over a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            levels = batch.column("levels")
            offsets = levels.offsets.to_numpy()
            flat = levels.flatten()
            numbers, counts, bits = (
                flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)
            )
            bits = bits.view(np.uint64)
            offsets = offsets - offsets[0]
            sums: dict[str, _Sums] = {}
            for lang, a, b in zip(batch.column("lang").to_pylist(), offsets, offsets[1:]):
                held = sums.get(lang) or sums.setdefault(lang, _Sums(totals[lang]))
                held.add(numbers[a:b], counts[a:b], bits[a:b])
            for lang, held in sums.items():
                held.settle()
                n = len(held.totals)
                here, there = np.nonzero(~np.eye(n, dtype=bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(here), pa.string()),
                        pa.array(here, pa.int32()),
                        pa.array(there, pa.int32()),
                        pa.array(held.values[here, there]),
                    ],
                    names=["lang", "here", "there", "value"],
                )

    return run


# ------------------------------------------------------------------------- results


def pair_values(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the divergence of each group from each other of its lang."""
    totals: dict[str, np.ndarray] = {}
    rows = groups.select("lang", "number", (F.col("words") + F.col("kept")).alias("total"))
    frame = rows.toPandas().sort_values(["lang", "number"])
    for lang, part in frame.groupby("lang"):
        totals[lang] = part["total"].to_numpy(np.int64)
    sent = levels.sparkSession.sparkContext.broadcast(totals)
    summed = (
        map_batches(
            levels,
            lambda batches: _pairs(sent.value)(batches),
            "lang string, here int, there int, value long",
        )
        .groupBy("lang", "here", "there")
        .agg(F.sum("value").alias("value"))
    )
    here = groups.select("lang", "source", F.col("number").alias("here"))
    there = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("there"))
    return (
        here.join(there, "lang")
        .filter(F.col("here") != F.col("there"))
        .join(summed, ["lang", "here", "there"], "left")
        .select("lang", "source", "item", F.coalesce("value", F.lit(0)).alias("value"))
    )


def term_values(numbered: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the terms with a larger share in the group than in its lang."""
    p = share(F.col("n"), F.col("words"), F.col("kept"))
    q = share(F.col("total"), F.col("lang_words"), F.col("kept"))
    return (
        numbered.select("lang", "term", "total", F.explode("levels").alias("level"))
        .select("lang", "term", "total", "level.source", "level.n")
        .join(groups, list(GROUP))
        .select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
        .filter(F.col("p") > F.col("q"))
        .select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))
    )


def _ranked(values: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), F.asc("item"))
    return values.select(
        *GROUP, F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(
    docs: DataFrame,
    scratch: Scratch,
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: the divergence from every other source of the language. Part ``term``: the
    ``top_terms`` terms by which the group differs most from its whole language.
    """
    numbered = scratch.keep(numbered_terms(kept_terms(docs, min_documents)), "terms")
    groups = scratch.keep(group_table(docs, numbered), "groups")
    levels = scratch.keep(bitmaps(numbered, groups), "bitmaps")
    pairs = _ranked(pair_values(levels, groups), "pair")
    terms = _ranked(term_values(numbered, groups), "term").filter(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)

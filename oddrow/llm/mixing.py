"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a seeded hash and queued up to three times over. A queued
document gets a virtual finish time, the words of its source up to and including it divided by the
source's target; all queues are merged by that time, and the merged stream ends at the total
budget. DataFrame functions only.

Running sums never gather a source or the stream in one task: rows are summed inside blocks of a
source's hash order and inside ranges of virtual time, and only their totals are summed over blocks
and ranges. Identical rows travel as one with a count and are told apart in chunks.

Defined cases: a null text has size 0; null sources form one source that ranks last; documents
without words are queued but take nothing; repeated rows are queued as separate documents;
an empty table gives an empty result; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oddrow.llm.common import packed, text_of, unpacked, word_count
from oddrow.llm.copies import one_by_one
from oddrow.llm.ordered import running_total
from oddrow.sources.storage import Scratch

WEIGHTS = (1, 2, 3)
PASSES = 3
#: Documents per block of a running sum, on average.
BLOCK_ROWS = 4_000
SEED = 7
KEY = ("doc_id", "source", "_mark")


def _mark(prefix: str = "") -> Column:
    """A seeded hash of the row, which also orders the shuffle."""
    return F.xxhash64(
        F.lit(SEED),
        F.col(f"{prefix}doc_id"),
        F.col(f"{prefix}source"),
        text_of(f"{prefix}text"),
    )


def targets(docs: DataFrame) -> DataFrame:
    """(source, source_size, target): each source's share of all words.

    The share is the level ``L`` times the weight, or three times the source's size if that is
    less, where the level spends the whole budget: the limit of handing out the excess again.
    One row per source meets in the windows below, never a document.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*map(F.lit, WEIGHTS))
    weighed = sizes.withColumn(
        "_rank", F.row_number().over(by_name) - 1
    ).withColumn("weight", F.get(choices, F.col("_rank") % len(WEIGHTS)).cast("double"))
    cap = F.col("source_size") * float(PASSES)
    by_ratio = Window.orderBy(cap / F.col("weight"), "_rank")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = weighed.withColumns(
        {
            "_place": F.row_number().over(by_ratio),
            "_all": F.sum("source_size").over(everything),
            "_filled": F.coalesce(F.sum(cap).over(before), F.lit(0.0)),
            "_weights": F.sum("weight").over(
                by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
            ),
        }
    ).withColumn("_level", (F.col("_all") - F.col("_filled")) / F.col("_weights"))
    # Sources that fill up come first in this order; the first that does not sets the level.
    first_open = F.min(
        F.when(F.col("_level") * F.col("weight") <= cap, F.struct("_place", "_level"))
    ).over(everything)
    return level.withColumn("_open", first_open["_level"]).select(
        "source",
        "source_size",
        F.least(cap, F.coalesce(F.col("_open") * F.col("weight"), cap)).alias("target"),
    )


def _running(rows: DataFrame, group: list[str], block: Column, order: list, value: str):
    """``rows`` with ``_sum``: the sum of ``value`` up to each row within its group."""
    placed = rows.withColumn("_block", block)
    totals = placed.groupBy(*group, "_block").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *(F.col(c).alias(f"_of_{c}") for c in group),
        F.col("_block").alias("_of_block"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = F.col("_block") == F.col("_of_block")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        placed.join(offsets, same)
        .withColumn("_sum", F.sum(value).over(inside) + F.col("_offset"))
        .drop("_block", "_offset", "_of_block", *(f"_of_{c}" for c in group))
    )


def queue(docs: DataFrame, scratch: Scratch, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every queued document and pass with its place in the merged order.

    Columns: doc_id, source, _mark, _copy (number of the row among identical ones), size,
    source_size, target, pass, finish (virtual time), until (words of the merged order up to
    here) and taken (whether that is within the budget).
    """
    # Identical rows travel as one row with a count and are told apart after the running sum.
    sized = scratch.keep(
        docs.select("doc_id", "source", _mark().alias("_mark"), word_count(text_of()).alias("size"))
        .groupBy(*KEY, "size")
        .agg(F.count("*").alias("_n"))
        .withColumn("_words", F.col("size") * F.col("_n")),
        "sizes",
    )
    shares = scratch.keep(
        targets(sized.select("source", F.col("_words").alias("size"))), "targets"
    )
    totals = sized.agg(F.sum("_n").alias("rows"), F.sum("_words").alias("words")).first()
    blocks = max(1, (totals["rows"] or 0) // block_rows)
    budget = totals["words"] or 0

    order = [F.asc("_mark"), F.col("doc_id").asc_nulls_first(), F.col("source").asc_nulls_last()]
    place = (F.col("_mark") / 2.0**63 + 1) / 2  # the hash as a number from 0 to 1
    summed = _running(sized, ["source"], F.floor(place * blocks), order, "_words")
    copies = one_by_one(scratch.keep(summed, "summed"), "_n", "_ordinal")
    queued = (
        copies.withColumn("_copy", F.col("_ordinal") + 1)
        .withColumn("_sum", F.col("_sum") - (F.col("_n") - F.col("_copy")) * F.col("size"))
        .join(
            shares.withColumnRenamed("source", "_source"),
            F.col("source").eqNullSafe(F.col("_source")),
        )
        .withColumn("pass", F.explode(F.array(*map(F.lit, range(PASSES)))))
        .withColumn(
            "finish",
            (F.col("_sum") + F.col("pass") * F.col("source_size"))
            / F.greatest("target", F.lit(1e-9)),
        )
    )
    merged = running_total(
        queued.drop("_sum", "_n", "_words", "_ordinal"),
        [F.asc("finish"), *order, F.asc("_copy"), F.asc("pass")],
        "size",
        "until",
        scratch,
    )
    return merged.withColumn("taken", F.col("until") <= budget)


def takes(queued: DataFrame) -> DataFrame:
    """One row per input row: its size, its source's size and target, words and passes taken."""
    return queued.groupBy(*KEY, "_copy", "size", "source_size", "target").agg(
        F.sum(F.when(F.col("taken"), F.col("size")).otherwise(0)).alias("taken"),
        F.sum(F.when(F.col("taken") & (F.col("size") > 0), 1).otherwise(0)).alias("passes"),
    )


def mix(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """The mixed documents with their columns; a document taken twice is there twice."""
    chosen = takes(queue(docs, scratch)).filter(F.col("passes") > 0)
    # Identical rows are interchangeable, so their passes add up on one representative.
    times = chosen.groupBy(*KEY).agg(F.sum("passes").alias("_times"))
    times = times.select(*(F.col(c).alias(f"_of_{c}") for c in KEY), "_times")
    one = (
        packed(docs)
        .withColumn("_mark", _mark("row."))
        .withColumns({c: F.col(f"row.{c}") for c in ("doc_id", "source")})
        .dropDuplicates(list(KEY))
    )
    same = F.col("_mark") == F.col("_of__mark")
    for c in ("doc_id", "source"):
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return unpacked(one_by_one(one.join(times, same), "_times", "_pass"))

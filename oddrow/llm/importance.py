"""Resampling towards a target distribution by hashed word runs.

Every text is scanned by an Aho-Corasick automaton. Its dictionary holds the distinct words of a
portion of texts, each bounded by delimiters and carrying its CRC and its length; the scan emits
these payloads in order, and runs of several words get their CRC by composing adjacent payloads,
without touching the text again. The CRC modulo the number of buckets is the feature. Buckets are
counted over all documents and all target texts, their log ratio is the gain, and a document's
weight is the sum over its features. A Gumbel number made from the id turns the weights into draws
without replacement: the highest sums are drawn.

Ranks over all documents need no single task: rows are cut into ranges of the order, ranked inside
them, and moved by the totals of the ranges before. Rows that agree in everything travel as one
with a count.

Defined cases: null and empty texts have no features and weight 0; a null id is hashed as an empty
one and comes last among ties; repeated rows are ranked one by one, in any order; an empty target
gives every bucket the gain of t = T = 0; empty tables give an empty result; other columns are not
read, and :func:`draw` returns all of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator
from operator import itemgetter
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import map_batches, packed, text_of, unpacked
from oddrow.llm.copies import one_by_one
from oddrow.llm.crc import runs
from oddrow.llm.ordered import running_total
from oddrow.llm.words import LETTERS_AND_DIGITS, portions
from oddrow.sources.storage import Scratch

BUCKETS = 10_000
MAX_RUN = 1
SEED = 2024
MIN_WORDS = 20
PERCENT = 10
#: Bytes of text that share a dictionary.
PORTION_BYTES = 4_000_000

_LENGTH_SHIFT = 32


# ------------------------------------------------------------------------- features


def dictionary(words: Iterable[str]) -> ahocorasick.Automaton:
    """Delimited words with their payload: length in bytes and CRC in one number."""
    made = ahocorasick.Automaton()
    for word in words:
        held = word.encode()
        made.add_word(f" {word} ", len(held) << _LENGTH_SHIFT | zlib.crc32(held))
    made.make_automaton()
    return made


def payloads(scanner: ahocorasick.Automaton, text: str) -> np.ndarray:
    """The payloads of the words of a text, in order; its words are between blanks."""
    return np.fromiter(map(itemgetter(1), scanner.iter(text)), np.uint64)


def buckets_of(found: np.ndarray, most: int, buckets: int) -> np.ndarray:
    """The buckets of all runs of 1 to ``most`` words."""
    crcs = (found & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    lengths = (found >> np.uint64(_LENGTH_SHIFT)).astype(np.int64)
    return np.concatenate(runs(crcs, lengths, most)) % np.uint32(buckets)


class Features(NamedTuple):
    n_words: np.ndarray  # of each text
    n_features: np.ndarray
    buckets: np.ndarray  # of all features end to end


def features_of(texts: pa.Array, most: int = MAX_RUN, buckets: int = BUCKETS) -> Features:
    """The features of every whole text of a portion."""
    blanked = [
        f" {text.translate(LETTERS_AND_DIGITS).decode()} " if text else ""
        for text in texts.cast(pa.binary()).to_pylist()
    ]
    words: set[str] = set()
    for text in blanked:
        words.update(text.split(" "))
    words.discard("")
    made, n_words = [np.empty(0, np.uint32)], np.zeros(len(blanked), np.int64)
    if words:
        scanner = dictionary(words)
        for i, text in enumerate(blanked):
            found = payloads(scanner, text) if text else np.empty(0, np.uint64)
            n_words[i] = len(found)
            made.append(buckets_of(found, most, buckets))
    else:
        made += [made[0]] * len(blanked)
    sizes = np.fromiter(map(len, made[1:]), np.int64, len(blanked))
    return Features(n_words, sizes, np.concatenate(made))


def _count(most: int, buckets: int):
    """(bucket, n): the features of all texts of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in portions(batches, PORTION_BYTES):
            found = features_of(batch.column("text"), most, buckets).buckets
            total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], names=["bucket", "n"]
        )

    return run


def bucket_counts(texts: DataFrame, most: int = MAX_RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts; every task sends at most one row per bucket."""
    counted = map_batches(
        texts.select(F.col("text").cast("string").alias("text")),
        _count(most, buckets),
        "bucket int, n long",
    )
    return counted.groupBy("bucket").agg(F.sum("n").cast("long").alias("n"))


def _as_array(counts: DataFrame, buckets: int) -> np.ndarray:
    made = np.zeros(buckets, np.int64)
    for row in counts.collect():  # at most one row per bucket
        made[row["bucket"]] = row["n"]
    return made


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket's share in the target and in the documents, in thousandths."""
    n = len(docs)
    all_docs, all_target = float(docs.sum() + n), float(target.sum() + n)
    ratios = ((target + 1.0) * all_docs) / ((docs + 1.0) * all_target)
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


# ------------------------------------------------------------------------- scores


def _weigh(of_bucket: np.ndarray, most: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, PORTION_BYTES):
            found = features_of(batch.column("text"), most, len(of_bucket))
            sums = np.concatenate([[0], np.cumsum(of_bucket[found.buckets])])
            ends = np.cumsum(found.n_features)
            weights = sums[ends] - sums[ends - found.n_features]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("mark"),
                    *(pa.array(x) for x in (found.n_words, found.n_features, weights)),
                ],
                names=["doc_id", "mark", "n_words", "n_features", "weight"],
            )

    return run


def _mark(prefix: str = "") -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(text_of(f"{prefix}text"))


def noise(seed: int = SEED) -> Column:
    """Gumbel number of the id, in thousandths."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    digits = F.substring(F.sha2(named.cast("binary"), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(share)))


def score(
    docs: DataFrame,
    target: DataFrame,
    most: int = MAX_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, mark, n_words, n_features, weight, score) of every row."""
    counted = (_as_array(bucket_counts(x, most, buckets), buckets) for x in (docs, target))
    of_bucket = gains(*counted)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        _mark().alias("mark"),
    )
    weighed = map_batches(
        rows,
        _weigh(of_bucket, most),
        "doc_id long, mark long, n_words long, n_features long, weight long",
    )
    return weighed.withColumn("score", F.col("weight") + noise(seed))


def ranked(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (with a count ``n``) with ``first``: the rank of their first copy, from 1 on."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("mark")]
    placed = running_total(rows, order, "n", "until", scratch)
    return placed.withColumn("first", F.col("until") - F.col("n") + 1).drop("until")


def resample(
    docs: DataFrame,
    target: DataFrame,
    scratch: Scratch,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    **options: int,
) -> DataFrame:
    """(doc_id, mark, n_words, n_features, weight, score, rank) of every row.

    ``rank`` counts the drawn rows from 1 on and is null for the others: of the rows with
    ``min_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    scored = score(docs, target, **options)
    classes = scratch.keep(
        scored.groupBy(*scored.columns).agg(F.count("*").alias("n")), "scores"
    )
    eligible = F.col("n_words") >= min_words
    n = classes.filter(eligible).agg(F.sum("n")).first()[0] or 0
    placed = ranked(classes.filter(eligible), scratch)
    others = classes.filter(~eligible).withColumn("first", F.lit(None).cast("long"))
    rank = F.col("first") + F.col("copy")
    return (
        one_by_one(scratch.keep(placed.unionByName(others), "places"), "n", "copy")
        .withColumn("rank", F.when(rank <= percent * n // 100, rank))
        .drop("first", "copy", "n")
    )


def draw(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns; of one id and text any may stand."""
    times = (
        resampled.filter(F.col("rank").isNotNull())
        .groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
        .agg(F.count("*").alias("_times"))
    )
    rows = packed(docs).withColumns(
        {"_own_id": F.col("row.doc_id").cast("long"), "_own_mark": _mark("row.")}
    )
    same = F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_mark") == F.col("_mark"))
    drawn = rows.join(times, same).dropDuplicates(["_own_id", "_own_mark"])
    return unpacked(one_by_one(drawn, "_times", "_copy"))

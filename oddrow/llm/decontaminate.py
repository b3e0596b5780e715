"""Benchmark decontamination by suffix arrays over the training documents.

Documents are dealt into shards of bounded size. Every shard gets the suffix array of its words,
and every suffix of every benchmark item is searched in it by halving. What occurs for a whole
window (``WINDOW`` words, or the whole of a shorter item) is a verbatim match; it is followed as
far as item and document agree. Documents with a match are affected and can be removed.

Benchmark items are the stated queries: they come to the tasks in blocks of bounded size, however
many there are. With more than one block the shards' arrays are stored once and searched block by
block; a user may store them too (:func:`build_index`) and search later benchmarks in them.

Defined cases: null and empty texts have no words, are never affected and find nothing; benchmark
rows of one id are one item, a null id is written as an empty one, and an item that occurs in several
rows counts once; repeated documents are judged row by row; empty tables give an empty result, or
no match; only doc_id and text (item_id and text) are read, and :func:`remove` returns all columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import ids_and_texts, map_batches, text_of
from oddrow.llm.suffix_arrays import Matches, expand, search, suffix_array
from oddrow.llm.words import SEPARATOR, Numbers, numbered, portions, utf8, words_of
from oddrow.sources.storage import Scratch

WINDOW = 10
#: Bytes of text in a shard; a longer document is a shard of its own.
SHARD_BYTES = 4_000_000
#: Bytes of benchmark text in a block, on average; a block is broadcast.
BLOCK_BYTES = 8_000_000

INDEX = "doc_ids array<long>, sizes array<long>, words binary, sequence binary, suffixes binary"
FOUND = (
    "doc_id long, n_words long, spans array<struct<start: int, end: int>>, "
    "items array<string>, longest int"
)
_NUMBER = np.dtype("<u4")


# ------------------------------------------------------------------------- benchmark


class Block(NamedTuple):
    """Items of a benchmark, their words numbered by a dictionary of the block."""

    names: list[str]  # of the items
    words: list[bytes]
    sequence: np.ndarray
    item: np.ndarray  # of each searched suffix
    starts: np.ndarray
    ends: np.ndarray
    widths: np.ndarray


def make_block(items: Iterable[tuple[str | None, str | None]], window: int = WINDOW) -> Block:
    """A block of (item_id, text)."""
    rows = sorted({(name or "", text or "") for name, text in items})
    names = sorted({name for name, _ in rows})
    place = {name: i for i, name in enumerate(names)}
    numbers = Numbers()
    sequence, sizes = numbered([words_of(text.encode()) for _, text in rows], numbers)
    widths = np.minimum(sizes, window)
    # Of the suffixes of an item those that hold a window can match one.
    held = np.where(sizes > 0, sizes - widths + 1, 0)
    begin = np.cumsum(sizes) - sizes
    starts, of = expand(begin, begin + held)
    item = np.array([place[name] for name, _ in rows], np.int64)
    ends = (begin + sizes)[of]
    return Block(names, numbers.words(), sequence, item[of], starts, ends, widths[of])


def blocks_of(benchmark: DataFrame, window: int = WINDOW) -> list[Callable[[], Block]]:
    """Functions that fetch one block each; an empty benchmark is one empty block."""
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), text_of().alias("text")
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))

    def fetch(k: int) -> Block:
        rows = items.filter(place == k).toArrow().to_pylist()
        return make_block(((r["item_id"], r["text"]) for r in rows), window)

    return [lambda k=k: fetch(k) for k in range(n)]


# ------------------------------------------------------------------------- shards


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of INDEX for each portion of (doc_id, text)."""
    for batch in portions(batches, SHARD_BYTES):
        numbers = Numbers()
        texts = [words_of(text) for text in utf8(batch.column("text"))]
        sizes = [len(words) for words in texts]
        for words in texts:
            words.append(SEPARATOR)
        sequence, _ = numbered(texts, numbers)
        del texts
        row = (
            batch.column("doc_id").to_pylist(),
            sizes,
            SEPARATOR.join(numbers.words()),
            sequence.astype(_NUMBER).tobytes(),
            suffix_array(sequence).astype(_NUMBER).tobytes(),
        )
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 3)
        names = ("doc_ids", "sizes", "words", "sequence", "suffixes")
        yield pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(row, kinds)], names=names
        )


class Shard(NamedTuple):
    doc_ids: list[int | None]
    sizes: np.ndarray
    words: list[bytes]
    sequence: np.ndarray
    suffixes: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        """The place of the first word of each document; a separator follows its last one."""
        return np.cumsum(self.sizes + 1) - self.sizes - 1


def _shard(batch: pa.RecordBatch, i: int) -> Shard:
    values = [batch.column(name)[i] for name in ("doc_ids", "sizes", "words")]
    sequence, suffixes = (
        np.frombuffer(batch.column(name)[i].as_buffer(), _NUMBER).astype(np.int64)
        for name in ("sequence", "suffixes")
    )
    doc_ids, sizes, words = (v.as_py() for v in values)
    return Shard(doc_ids, np.array(sizes, np.int64), words.split(), sequence, suffixes)


def _search(shard: Shard, block: Block) -> Matches:
    numbers = dict(zip(shard.words, range(1, len(shard.words) + 1)))
    known = np.array([numbers.get(word, -1) for word in block.words] or [-1], np.int64)
    wanted = known[block.sequence - 1] if len(block.sequence) else block.sequence
    return search(
        shard.sequence, shard.suffixes, wanted, block.starts, block.ends, block.widths
    )


def _names_by_window(matches: Matches, block: Block) -> tuple[np.ndarray, list, np.ndarray]:
    """(first match of each different window, the items of the window, window of each match)."""
    keys = np.stack([block.widths[matches.which], matches.low])
    _, first, of = np.unique(keys, axis=1, return_index=True, return_inverse=True)
    of = of.reshape(-1)
    pairs = np.unique(np.stack([of, block.item[matches.which]]), axis=1)
    bounds = np.searchsorted(pairs[0], np.arange(len(first) + 1))
    return first, [pairs[1][a:b] for a, b in zip(bounds, bounds[1:])], of


def _report(shard: Shard, block: Block) -> tuple[list, list, np.ndarray]:
    """Per document: the hit spans of words, the items found, the longest match."""
    n = len(shard.doc_ids)
    spans, items, longest = [[] for _ in range(n)], [[] for _ in range(n)], np.zeros(n, int)
    matches = _search(shard, block)
    if not len(matches.which):
        return spans, items, longest
    starts = shard.starts
    doc_at = lambda places: np.searchsorted(starts, places, side="right") - 1

    first, held, _ = _names_by_window(matches, block)
    places, window = expand(matches.low[first], matches.high[first])
    places = shard.suffixes[places]
    widths = block.widths[matches.which[first]]
    change = np.bincount(places, minlength=len(shard.sequence) + 1)
    change -= np.bincount(places + widths[window], minlength=len(change))
    hit = np.cumsum(change) > 0
    edges = np.flatnonzero(np.diff(hit, prepend=False))
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        doc = int(doc_at(start))
        spans[doc].append({"start": start - int(starts[doc]), "end": end - int(starts[doc])})

    pairs = np.unique(np.stack([doc_at(places), window]), axis=1)
    bounds = np.flatnonzero(np.diff(pairs[0], prepend=-1, append=n))
    known: dict[bytes, list[str]] = {}  # documents with the same windows have the same items
    for a, b in zip(bounds, bounds[1:]):
        key = pairs[1][a:b].tobytes()
        if key not in known:
            found = np.unique(np.concatenate([held[w] for w in pairs[1][a:b]]))
            known[key] = [block.names[i] for i in found]
        items[pairs[0][a]] = known[key]

    for length, low, high in matches.longer:
        places, _ = expand(low, high)
        longest[doc_at(shard.suffixes[places])] = length
    return spans, items, longest


def _reports(batches: Iterable[pa.RecordBatch], block: Block, numbered_rows: bool):
    kinds = [
        pa.int64(), pa.int64(),
        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
        pa.list_(pa.string()), pa.int32(),
    ]
    names = ["doc_id", "n_words", "spans", "items", "longest"]
    for batch in batches:
        for i in range(batch.num_rows):
            shard = _shard(batch, i)
            columns = [shard.doc_ids, shard.sizes, *_report(shard, block)]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if numbered_rows:
                n = len(shard.doc_ids)
                arrays += [pa.repeat(batch.column("shard")[i], n), pa.array(range(n), pa.int64())]
            extra = ["shard", "row"] if numbered_rows else []
            yield pa.RecordBatch.from_arrays(arrays, names=names + extra)


# ------------------------------------------------------------------------- jobs


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard: its documents, words, numbered words and suffix array."""
    return map_batches(ids_and_texts(docs), _shards, INDEX).withColumn(
        "shard", F.monotonically_increasing_id()
    )


def search_index(index: DataFrame, block: Block) -> DataFrame:
    """FOUND with (shard, row) of every document of a stored index."""
    sent = index.sparkSession.sparkContext.broadcast(block)
    return map_batches(
        index,
        lambda batches: _reports(batches, sent.value, True),
        f"{FOUND}, shard long, row long",
    )


def _merged(parts: list[DataFrame]) -> DataFrame:
    """Results of several blocks as one row per document; overlapping spans become one."""
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    empty = F.array().cast("array<struct<start: int, end: int>>")

    def join(done, span):
        last = F.element_at(done, -1)
        apart = (F.size(done) == 0) | (span["start"] > F.try_element_at(done, F.lit(-1))["end"])
        longer = F.struct(
            last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end")
        )
        return F.when(apart, F.concat(done, F.array(span))).otherwise(
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        )

    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("shard", "row", "doc_id", "n_words")
        .agg(
            F.aggregate(spans, empty, join).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max("longest").alias("longest"),
        )
        .drop("shard", "row")
    )


def find_matches(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, window: int = WINDOW
) -> DataFrame:
    """One row per document: doc_id, n_words, spans, items, longest.

    ``spans`` are the maximal runs of words inside verbatim matches (from 0, end excluded),
    ``items`` the ids with a match, ``longest`` the words of the longest one.
    """
    fetch = blocks_of(benchmark, window)
    if len(fetch) > 1:
        index = scratch.keep(build_index(docs), "suffix-arrays")
        return _merged([search_index(index, block()) for block in fetch])
    sent = docs.sparkSession.sparkContext.broadcast(fetch[0]())
    return map_batches(
        ids_and_texts(docs),
        lambda batches: _reports(_shards(batches), sent.value, False),
        FOUND,
    )


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a match, with all their columns; one pass per block."""
    number = docs.columns.index("text")
    for fetch in blocks_of(benchmark, window):
        sent = docs.sparkSession.sparkContext.broadcast(fetch())

        def run(batches, sent=sent):
            for batch in batches:
                texts = pa.RecordBatch.from_arrays(
                    [pa.array(range(batch.num_rows), pa.int64()), batch.column(number)],
                    names=["doc_id", "text"],
                )
                kept = np.ones(batch.num_rows, bool)
                for shard in _shards([texts]):
                    found = _report(one := _shard(shard, 0), sent.value)[2]
                    kept[np.array(one.doc_ids, int)[found > 0]] = False
                yield batch.filter(pa.array(kept))

        docs = map_batches(docs, run, docs.schema)
    return docs

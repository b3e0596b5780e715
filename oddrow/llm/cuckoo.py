"""Exact duplicates through a cuckoo-filter index.

Documents' digests are dealt into shards. A shard's filter takes every live digest; a digest whose
fingerprint is already there is a hit, and all texts of a hit fingerprint are verified against the
content, bucketed by digest. Digests without a hit are unique without any comparison.

The filter supports insertion and deletion of live digests. When an insertion finds no place, the
table is doubled and filled again from the shard's stored keys.

Defined cases: a null text counts as empty; of equal texts the largest doc_id stays, and every row
that carries it is marked kept (null ids rank lowest; if all are null, so is keep_id, and the rows
are marked kept); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from random import Random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import map_batches, packed, text_of, unpacked
from oddrow.sources.storage import Scratch

SLOTS = 4
MAX_KICKS = 500
MAX_LOAD = 0.9
#: Digests per shard, on average: bounds the memory of one task.
SHARD_KEYS = 50_000
#: Distinct digests that one scan task combines before passing them on.
COMBINE_KEYS = 100_000
FINGERPRINT = (1 << 16) - 1


class CuckooFilter:
    """16-bit fingerprints in two candidate buckets of four slots.

    ``keys`` are integers of 64 well-mixed bits. Copies of one key may be inserted and deleted
    like different keys with one fingerprint; the caller inserts each live key once.
    """

    def __init__(self, buckets: int = 64, state: bytes | None = None) -> None:
        self.buckets = 1 << max(0, (buckets - 1).bit_length())
        self.slots = array("H", state if state is not None else bytes(2 * SLOTS * self.buckets))
        self.buckets = len(self.slots) // SLOTS
        self.size = len(self.slots) - self.slots.count(0)
        self._random = Random(1)

    def _places(self, key: int) -> tuple[int, int, int]:
        mark = (key & FINGERPRINT) or 1
        first = (key >> 16) & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995)) & (self.buckets - 1)

    def _row(self, bucket: int) -> array:
        return self.slots[bucket * SLOTS : (bucket + 1) * SLOTS]

    def address(self, key: int) -> tuple[int, int]:
        """Equal for all keys that the filter cannot tell apart."""
        mark, first, second = self._places(key)
        return mark, min(first, second)

    def __contains__(self, key: int) -> bool:
        mark, first, second = self._places(key)
        return mark in self._row(first) or mark in self._row(second)

    def _put(self, bucket: int, mark: int) -> bool:
        row = self._row(bucket)
        if 0 not in row:
            return False
        self.slots[bucket * SLOTS + row.index(0)] = mark
        return True

    def insert(self, key: int) -> bool:
        """False if there was no place; the table then lacks one mark and must be resized."""
        mark, first, second = self._places(key)
        if self.size >= MAX_LOAD * len(self.slots):
            return False
        if not (self._put(first, mark) or self._put(second, mark)):
            bucket = second
            for _ in range(MAX_KICKS):
                at = bucket * SLOTS + self._random.randrange(SLOTS)
                self.slots[at], mark = mark, self.slots[at]
                bucket = self._other(bucket, mark)
                if self._put(bucket, mark):
                    break
            else:
                return False
        self.size += 1
        return True

    def delete(self, key: int) -> bool:
        """Remove one mark of a key that was inserted; False if there is none."""
        mark, first, second = self._places(key)
        for bucket in (first, second):
            row = self._row(bucket)
            if mark in row:
                self.slots[bucket * SLOTS + row.index(mark)] = 0
                self.size -= 1
                return True
        return False

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()


class Shard:
    """A filter with its stored keys: live digest -> number of documents."""

    def __init__(self, live: dict[bytes, int] | None = None, state: bytes | None = None) -> None:
        self.live = dict(live or {})
        self.filter = CuckooFilter(state=state)
        if state is None:
            self._refill(self.filter.buckets)

    @staticmethod
    def key(digest: bytes) -> int:
        # The leading bytes deal digests into shards, so the filter uses the last ones.
        return int.from_bytes(digest[-8:], "big")

    def _refill(self, buckets: int) -> None:
        """Build the table anew from the stored keys, doubling until all have a place."""
        while True:
            self.filter = CuckooFilter(buckets)
            if all(self.filter.insert(self.key(d)) for d in self.live):
                return
            buckets *= 2

    def add(self, digest: bytes, count: int = 1) -> bool:
        """Add documents; True for a hit: this or an indistinguishable digest was there."""
        key = self.key(digest)
        hit = key in self.filter
        known = hit and digest in self.live
        self.live[digest] = self.live.get(digest, 0) + count
        if not known and not self.filter.insert(key):
            self._refill(2 * self.filter.buckets)
        return hit

    def remove(self, digest: bytes, count: int = 1) -> bool:
        """Remove documents; the digest leaves the filter with its last one."""
        if self.key(digest) not in self.filter or digest not in self.live:
            return False
        self.live[digest] -= count
        if self.live[digest] <= 0:
            del self.live[digest]
            self.filter.delete(self.key(digest))
        return True


KEY_SCHEMA = "shard int, digest binary, n long"
HIT_SCHEMA = "shard int, digest binary, n long, hit boolean"
INDEX_SCHEMA = "shard int, digests array<binary>, counts array<long>, state binary"


def _combine(shards: int):
    """Count each scan task's digests before they are shuffled: a hot text stays one row."""

    schema = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("n", pa.int64())])

    def rows(seen: dict[bytes, int]) -> pa.RecordBatch:
        digests = list(seen)
        dealt = [int.from_bytes(d[:8], "big") % shards for d in digests]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(dealt, pa.int32()),
                pa.array(digests, pa.binary()),
                pa.array(list(seen.values()), pa.int64()),
            ],
            schema=schema,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for digest in batch.column(0).to_pylist():
                seen[digest] = seen.get(digest, 0) + 1
            if len(seen) >= COMBINE_KEYS:
                yield rows(seen)
                seen = {}
        if seen:
            yield rows(seen)

    return run


def _fill(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Insert one shard's digests; say which fingerprints were hit."""
    shard, crowded, repeated = Shard(), [], set()
    for digest, n in zip(table.column("digest").to_pylist(), table.column("n").to_pylist()):
        if shard.add(digest, n):
            crowded.append(digest)
        if n > 1:
            repeated.add(digest)
    # Addresses are taken in the table's last size: a digest that came twice has one address
    # there, and what only a smaller table could not tell apart needs no comparison.
    addresses = {shard.filter.address(Shard.key(d)) for d in crowded}
    stored = list(shard.live)
    hits = [d in repeated or shard.filter.address(Shard.key(d)) in addresses for d in stored]
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()] * len(stored), pa.int32()),
            "digest": pa.array(stored, pa.binary()),
            "n": pa.array(list(shard.live.values()), pa.int64()),
            "hit": pa.array(hits, pa.bool_()),
        }
    )


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, check): SHA-256 and a second, short hash of the whole text."""
    text = text_of()
    return docs.select(
        "doc_id",
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        F.xxhash64(text).alias("check"),
    )


def shard_count(rows: int) -> int:
    return max(1, -(-rows // SHARD_KEYS))


def index_digests(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, digest, n, hit): the stored keys after all digests went through the filters."""
    combined = map_batches(keys.select("digest"), _combine(shards), KEY_SCHEMA)
    return combined.groupBy("shard").applyInArrow(_fill, HIT_SCHEMA)


def verified_groups(docs: DataFrame, keys: DataFrame, stored: DataFrame) -> DataFrame:
    """(digest, check, keep_id, group_size) of texts that occur twice or more.

    Only rows with a hit are compared: by the texts themselves, within their digest's bucket.
    Equal texts of one scan are counted together before they are shuffled.
    """
    hits = stored.filter("hit").select("digest")
    ids = keys.join(hits, "digest", "left_semi").select(F.col("doc_id").alias("_id")).distinct()
    text = text_of()
    content = docs.select("doc_id", text.alias("text")).join(
        ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi"
    )
    bucketed = content.select(
        "doc_id",
        "text",
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        F.xxhash64("text").alias("check"),
    )
    return (
        bucketed.groupBy("digest", "check", "text")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .filter("group_size > 1")
        .drop("text")
    )


def find_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per document."""
    keys = scratch.keep(digests(docs), "digests")
    stored = scratch.keep(index_digests(keys, shard_count(keys.count())), "keys")
    copies = scratch.keep(verified_groups(docs, keys, stored), "copies")
    return keys.join(copies, ["digest", "check"], "left").select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id"))
        .otherwise(F.col("keep_id"))
        .alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.lit(True))
        .otherwise(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with one row of each text: the one of the largest doc_id.

    Of rows that are equal in doc_id and text, one stays.
    """
    gone = find_copies(docs, scratch).filter(~F.col("kept")).select("doc_id", "text_sha256")
    rows = packed(docs).select(
        "row",
        F.col("row.doc_id").alias("id"),
        F.sha2(text_of("row.text").cast("binary"), 256).alias("sha"),
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("sha") == F.col("text_sha256"))
    left = rows.join(gone.distinct(), same, "left_anti")
    return unpacked(left.dropDuplicates(["id", "sha"]))


# ---------------------------------------------------------------------- a kept index


def update_index(
    index: DataFrame | None, docs: DataFrame, shards: int, remove: bool = False
) -> DataFrame:
    """The index (shard, digests, counts, state) after ``docs`` were added or removed."""
    combined = map_batches(digests(docs).select("digest"), _combine(shards), KEY_SCHEMA)
    if index is None:
        index = docs.sparkSession.createDataFrame([], INDEX_SCHEMA)
    change = combined.withColumn("n", F.col("n") * (-1 if remove else 1))
    return (
        index.groupBy("shard")
        .cogroup(change.groupBy("shard"))
        .applyInArrow(_change, INDEX_SCHEMA)
    )


def _stored(index: pa.Table) -> Shard:
    if index.num_rows == 0:
        return Shard()
    row = index.to_pylist()[0]
    return Shard(dict(zip(row["digests"], row["counts"])), row["state"])


def _change(
    key: tuple[pa.Scalar, ...], index: pa.Table, change: pa.Table
) -> pa.Table:
    shard = _stored(index)
    for digest, n in zip(change.column("digest").to_pylist(), change.column("n").to_pylist()):
        if n > 0:
            shard.add(digest, n)
        else:
            shard.remove(digest, -n)
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()], pa.int32()),
            "digests": pa.array([list(shard.live)], pa.list_(pa.binary())),
            "counts": pa.array([list(shard.live.values())], pa.list_(pa.int64())),
            "state": pa.array([shard.filter.to_bytes()], pa.binary()),
        }
    )


def probe_index(index: DataFrame, docs: DataFrame, shards: int) -> DataFrame:
    """(shard, digest, n, hit) of the texts of ``docs``: n stored documents, hit by the filter."""
    combined = map_batches(digests(docs).select("digest"), _combine(shards), KEY_SCHEMA)
    return (
        index.groupBy("shard")
        .cogroup(combined.groupBy("shard"))
        .applyInArrow(_look_up, HIT_SCHEMA)
    )


def _look_up(
    key: tuple[pa.Scalar, ...], index: pa.Table, asked: pa.Table
) -> pa.Table:
    shard = _stored(index)
    wanted = list(dict.fromkeys(asked.column("digest").to_pylist()))
    return pa.table(
        {
            "shard": pa.array([key[0].as_py()] * len(wanted), pa.int32()),
            "digest": pa.array(wanted, pa.binary()),
            "n": pa.array([shard.live.get(d, 0) for d in wanted], pa.int64()),
            "hit": pa.array([Shard.key(d) in shard.filter for d in wanted], pa.bool_()),
        }
    )

"""Token ids in binary files: frequency-ranked, byte-aligned, control bytes apart.

Documents are sorted by id into files. A file is a series of blocks of whole documents. In a block
ids are replaced by their rank of frequency in the whole corpus (ties: the smaller id first), so
that frequent ids become small numbers; a number is stored in 1 to 4 bytes, and its length less one in two bits of a
separate stream of control bytes, four numbers to a byte. Control bytes are decoded by looking up
their four lengths in a table, for all numbers of a block at once.

Texts are encoded once, into kept blocks by ranks of their own and their counts. The counts of all
blocks make the one table of ids by rank, at most as long as the vocabulary, which is stored beside
the files; the blocks are then renumbered by it. Blocks and table are Parquet tables (``blocks`` and
``ranks``), so that any storage which Spark reaches will do.

Ids are those of ``Tokenizer.encode`` at its defaults without template tokens: the string of an
added token of the file has the id of that token.

Defined cases: a null text counts as empty and has the end id only; null doc_ids come first; rows
of one doc_id are ordered by a hash of the text, identical ones are interchangeable; an empty
table gives no blocks; a text longer than a block makes a block of its own.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from oddrow.llm.chunks import ID
from oddrow.llm.common import ids_and_texts, map_batches, small_batches
from oddrow.llm.matches import MatchEncoder
from oddrow.sources.storage import Scratch

END_ID = 2
BLOCK_TOKENS = 1 << 21
_HEAD = "file int, block int, before long, doc_ids array<long>, lengths array<long>, "
SCHEMA = _HEAD + "control binary, data binary"
#: Blocks before the corpus is counted, with ids by rank in the block and their counts.
OWN_SCHEMA = _HEAD + "ranks binary, counts binary, control binary, data binary"
COUNT = np.dtype("<i8")
ROWS = "file int, at long, doc_id long, n_tokens long, ids_crc32 long"
_LENGTHS = np.array(
    [[(byte >> shift & 3) + 1 for shift in (0, 2, 4, 6)] for byte in range(256)], np.uint8
)


# -------------------------------------------------------------------------- the coding


def pack(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    most = int(numbers.max(initial=0))
    width = 2 if most <= 0xFFFF else 4
    numbers = np.ascontiguousarray(numbers, f"<u{width}")
    extra = (numbers > 0xFF).view(np.uint8)
    if width == 4:
        extra = extra + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    padded = np.zeros(-(-len(extra) // 4) * 4, np.uint8)
    padded[: len(extra)] = extra
    fours = padded.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(width, dtype=np.uint8) <= extra[:, None]
    return control.tobytes(), numbers.view(np.uint8)[used.ravel()].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The numbers again, by table look-up of the control bytes."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    place = np.int32 if len(data) < 2**31 else np.int64
    starts = np.cumsum(lengths, dtype=place)
    starts -= lengths
    stored = np.frombuffer(data, np.uint8)
    numbers = stored[starts].astype(np.uint32)
    for step in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > step)
        numbers[longer] |= stored[starts[longer] + step].astype(np.uint32) << np.uint32(8 * step)
    return numbers


class Block(NamedTuple):
    ranks: bytes
    control: bytes
    data: bytes


def encode_block(ids: np.ndarray, counts: np.ndarray | None = None) -> Block:
    """A block of ids; ``counts`` by id, where they are known."""
    counts = np.bincount(ids) if counts is None else counts
    ranked = np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)]
    rank_of = np.zeros(len(counts), ID)
    rank_of[ranked] = np.arange(len(ranked), dtype=ID)
    return Block(ranked.astype(ID).tobytes(), *pack(rank_of[ids]))


def decode_block(block: Block, count: int) -> np.ndarray:
    return np.frombuffer(block.ranks, ID)[unpack(block.control, block.data, count)]


# -------------------------------------------------------------------------- the tokenizer


class Encoder:
    """Ids of texts by a byte-level BPE file of the tokenizers library.

    Texts are split at the added tokens of the file, which have ids of their own. As in the
    library, ``encode_special_tokens`` takes the strings of special ones for ordinary text.
    """

    def __init__(self, path: str, encode_special_tokens: bool = True) -> None:
        tokenizer = Tokenizer.from_file(path)
        self._model = tokenizer.model
        self._alphabet = _byte_alphabet()
        self._matches = MatchEncoder(self._encode_matches)
        self._added: dict[str, np.ndarray] = {}
        for made, token in tokenizer.get_added_tokens_decoder().items():
            if token.special and encode_special_tokens:
                continue
            if token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"added token {token.content!r} has flags that are not supported")
            self._added[token.content] = np.array([made], ID)
        # The longest of those that begin at one place, as the library takes them.
        longest_first = sorted(self._added, key=len, reverse=True)
        self._at_added = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def _encode_matches(self, matches: list[str]) -> list[list[int]]:
        if not matches:
            return []
        # No text in UTF-8 has a byte 0xFF.
        raw = np.frombuffer(b"\xff".join([m.encode() for m in matches]), np.uint8)
        written = self._alphabet[raw].tobytes().decode("utf-16-le").split("\n")
        tokenize = self._model.tokenize
        return [[t.id for t in tokenize(w)] for w in written]

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        with_added = np.zeros(len(texts), bool)
        for content in self._added:
            with_added |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not with_added.any():
            return list(self._matches.encode(texts))
        made: list[np.ndarray] = [None] * len(texts)
        plain = self._matches.encode(texts.filter(pa.array(~with_added)))
        for i, ids in zip(np.flatnonzero(~with_added), plain):
            made[i] = ids
        # Text and added tokens by turns, beginning and ending with a text.
        splits = [self._at_added.split(t) for t in texts.filter(pa.array(with_added)).to_pylist()]
        between = self._matches.encode([part for parts in splits for part in parts[::2]])
        for i, parts in zip(np.flatnonzero(with_added), splits):
            ids = [self._added[p] if k % 2 else next(between) for k, p in enumerate(parts)]
            made[i] = np.concatenate(ids)
        return made


def _byte_alphabet() -> np.ndarray:
    """Byte to character of byte-level vocabularies: printable bytes stand for themselves.

    The byte 0xFF, with which no character begins or goes on, ends a match.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    alphabet = np.arange(256, dtype="<u2")
    alphabet[others] = 256 + np.arange(len(others))
    alphabet[0xFF] = ord("\n")
    return alphabet


@lru_cache(maxsize=2)
def encoder(path: str, encode_special_tokens: bool = True) -> Encoder:
    """The encoder of a file, made once per worker."""
    return Encoder(path, encode_special_tokens)


# -------------------------------------------------------------------------- files


def write_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending doc_id order."""
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = (
        ids_and_texts(docs)
        .na.fill("", "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(tokenizer, encode_special_tokens=False), np.array([end_id], ID)
        file = TaskContext.get().partitionId()
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        block = before = held = 0

        def flush() -> pa.RecordBatch:
            nonlocal block, before, held
            ids = np.concatenate([x for p in parts for x in (p, end)])
            counts = np.bincount(ids)
            coded = encode_block(ids, counts)
            counts = counts[np.frombuffer(coded.ranks, ID)].astype(COUNT)
            row = {
                "file": file, "block": block, "before": before, "doc_ids": list(doc_ids),
                "lengths": [len(p) + 1 for p in parts], "counts": counts.tobytes(),
                **coded._asdict(),
            }
            block, before, held = block + 1, before + held, 0
            doc_ids.clear()
            parts.clear()
            return pa.RecordBatch.from_pylist([row], schema=_block_schema("ranks", "counts"))

        for few in small_batches(batches):
            made = coder.encode(few.column("text"))
            for doc_id, ids in zip(few.column("doc_id").to_pylist(), made):
                doc_ids.append(doc_id)
                parts.append(ids)
                held += len(ids) + 1
                if held >= BLOCK_TOKENS:
                    yield flush()
        if parts:
            yield flush()

    scratch = Scratch(docs.sparkSession)
    blocks = scratch.keep(map_batches(ordered, run, OWN_SCHEMA), "own-ranks")
    table = _ranked(blocks)
    _renumbered(blocks, table).write.mode("overwrite").option("compression", "none").parquet(
        f"{path}/blocks"
    )
    stored = docs.sparkSession.createDataFrame([(bytearray(table.tobytes()),)], "ids binary")
    stored.coalesce(1).write.mode("overwrite").parquet(f"{path}/ranks")
    scratch.drop()


def _ranked(blocks: DataFrame) -> np.ndarray:
    """Ids by rank of frequency in all blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ranks, counts in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(ranks, ID).astype(np.int64)),
                        pa.array(np.frombuffer(counts, COUNT)),
                    ],
                    names=["id", "n"],
                )

    counted = map_batches(blocks.select("ranks", "counts"), run, "id long, n long")
    # One row per id that occurs, at most the vocabulary.
    totals = counted.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = (totals.column(c).to_numpy() for c in ("id", "n"))
    return ids[np.lexsort((ids, -n))].astype(ID)


def _renumbered(blocks: DataFrame, table: np.ndarray) -> DataFrame:
    """Blocks whose numbers are ranks in ``table``."""
    rank_of = np.zeros(int(table.max(initial=0)) + 1, ID)
    rank_of[table] = np.arange(len(table), dtype=ID)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                numbers = unpack(row["control"], row["data"], sum(row["lengths"]))
                row["control"], row["data"] = pack(rank_of[np.frombuffer(row["ranks"], ID)][numbers])
                del row["ranks"], row["counts"]
                yield pa.RecordBatch.from_pylist([row], schema=_block_schema())

    return map_batches(blocks, run, SCHEMA)


def _block_schema(*more: str) -> pa.Schema:
    whole = [("file", pa.int32()), ("block", pa.int32()), ("before", pa.int64())]
    lists = [("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
    return pa.schema(whole + lists + [(c, pa.binary()) for c in (*more, "control", "data")])


def read_ids(block: dict, table: np.ndarray) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a block's documents, by the table of ids by rank."""
    ids = table[unpack(block["control"], block["data"], sum(block["lengths"]))]
    at = 0
    for doc_id, n in zip(block["doc_ids"], block["lengths"]):
        yield doc_id, ids[at : at + n]
        at += n


def read_table(spark: SparkSession, path: str) -> np.ndarray:
    """Ids by rank of frequency, of the files in ``path``."""
    return np.frombuffer(spark.read.schema("ids binary").parquet(f"{path}/ranks").first()["ids"], ID)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                at, columns = row["before"], ([], [], [], [], [])
                for doc_id, ids in read_ids(row, table):
                    made = (row["file"], at, doc_id, len(ids), zlib.crc32(ids.astype(ID)))
                    for column, value in zip(columns, made):
                        column.append(value)
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.int64()] * 4))],
                    names=["file", "at", "doc_id", "n_tokens", "ids_crc32"],
                )

    table = read_table(spark, path)
    blocks = spark.read.schema(SCHEMA).parquet(f"{path}/blocks")
    totals = blocks.groupBy("file").agg(
        F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("tokens")
    )
    # One row per file.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("file").alias("_file"),
        F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("_offset"),
    )
    rows = map_batches(blocks, run, ROWS)
    return rows.join(offsets, F.col("file") == F.col("_file")).select(
        "doc_id", (F.col("at") + F.col("_offset")).alias("start"), "n_tokens", "ids_crc32"
    )

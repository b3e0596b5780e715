"""Byte-level BPE encoding and decoding through a sentencepiece model made from the ranks.

The model is serialised directly from the vocabulary: every byte is written as one character, every
token is a piece whose score is its negative rank, and text is not normalised. Merging the adjacent
pair of the best score is then merging the pair of the lowest rank. Matches of the pre-tokenizer's
pattern are encoded one by one; a match that is itself a token is taken as such, as rank-based
encoders do. Ids are decoded by the inverse of the byte mapping.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to nothing;
rows are independent, so ties and repeated rows need no rule; an empty table gives an empty
result; an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from oddrow.llm.chunks import ChunkEncoder
from oddrow.llm.common import ids_and_texts, map_batches, small_batches

# One character per byte, none of which sentencepiece treats specially.
FIRST_CHARACTER = 0x2800
TO_CHARACTERS = {b: FIRST_CHARACTER + b for b in range(256)}
# Fixed values of the public model format: field numbers, piece kinds and the model type.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
MODEL_TYPE_FIELD, BPE = 3, 2
UNK_ID_FIELD, BOS_ID_FIELD, EOS_ID_FIELD, PAD_ID_FIELD = 40, 41, 42, 43
NAME_FIELD, FLAG_FIELDS = 1, (3, 4, 5)  # dummy prefix, extra white space, escaped white space

SCHEMA = "doc_id long, ids array<int>"
#: Chunks and pieces that a worker remembers, in each of two generations.
REMEMBERED = 120_000
#: Bytes of text that are cut and encoded together.
PORTION = 1_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a file with one base64 token and its rank per line."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    body = _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _bytes(PIECES, body + _number(3, kind))


def as_characters(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHARACTERS)


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece ``i + 1`` is the token at place ``i`` in rank order."""
    if len(ranks) > 1 << 24:
        raise ValueError("scores are 32-bit floats, which tell at most 2**24 ranks apart")
    ordered = sorted(ranks, key=ranks.__getitem__)
    pieces = [_piece("<unk>", 0.0, UNKNOWN)]
    pieces += [_piece(as_characters(t), -float(ranks[t]), NORMAL) for t in ordered]
    none = [_number(f, -1) for f in (BOS_ID_FIELD, EOS_ID_FIELD, PAD_ID_FIELD)]
    trainer = _number(MODEL_TYPE_FIELD, BPE) + _number(UNK_ID_FIELD, 0) + b"".join(none)
    normalizer = _bytes(NAME_FIELD, b"identity") + b"".join(_number(f, 0) for f in FLAG_FIELDS)
    return b"".join(pieces) + _bytes(TRAINER, trainer) + _bytes(NORMALIZER, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranks))
        self._rank_at = sorted(ranks.values())
        self._token_of = {rank: token for token, rank in ranks.items()}
        self._chunks = ChunkEncoder(self._encode_pieces, REMEMBERED, PORTION)

    def _encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        raw = [p.encode("utf-8") for p in pieces]
        made = [[self.ranks[r]] if r in self.ranks else None for r in raw]
        merged = [i for i, ids in enumerate(made) if ids is None]
        encoded = self._model.encode(
            [as_characters(raw[i]) for i in merged], out_type=int, num_threads=1
        )
        rank_at = self._rank_at
        for i, ids in zip(merged, encoded):
            if 0 in ids:
                raise ValueError("the vocabulary does not hold every byte")
            made[i] = [rank_at[k - 1] for k in ids]
        return made

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        return self._chunks.encode(texts)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self._token_of.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a rank file, made once per worker."""
    with open(path, "rb") as source:
        return Codec(read_ranks(source.read()))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for few in small_batches(batches, PORTION):
            ids = [made.astype(np.int32) for made in coder.encode(few.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [few.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )

    return map_batches(ids_and_texts(docs).na.fill("", "text"), run, SCHEMA)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of their decoding.

    Ids are decoded where they are made; only the digests leave the task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        names = {rank: str(rank) for rank in coder.ranks.values()}
        for few in small_batches(batches, PORTION):
            counts, of_ids, of_bytes = [], [], []
            for ids in map(np.ndarray.tolist, coder.encode(few.column("text"))):
                counts.append(len(ids))
                listed = ",".join(map(names.__getitem__, ids))
                of_ids.append(hashlib.sha256(listed.encode()).hexdigest())
                of_bytes.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    few.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(of_ids, pa.string()),
                    pa.array(of_bytes, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(ids_and_texts(docs).na.fill("", "text"), run, schema)

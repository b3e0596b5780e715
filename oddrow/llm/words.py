"""Words of letters (and digits) in UTF-8 texts, cut without decoding them."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_DIGITS, _LETTERS = b"0123456789", b"abcdefghijklmnopqrstuvwxyz"


def _table(kept: bytes) -> bytes:
    """Lower-cases A-Z, keeps ``kept`` and all bytes of other characters, blanks the rest."""
    blank = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in kept:
        blank[byte] = byte
    for byte in _LETTERS.upper():
        blank[byte] = byte + 32
    return bytes(blank)


#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a lower-cased text.
LETTERS_AND_DIGITS = _table(_LETTERS + _DIGITS)
#: Words ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, lower-cased.
LETTERS = _table(_LETTERS)


def words_of(text: bytes | None, table: bytes = LETTERS_AND_DIGITS) -> list[bytes]:
    """The words of a text in UTF-8; none if it is null."""
    return text.translate(table).split() if text else []


#: What parts texts; it cannot be a word.
SEPARATOR = b" "


class Numbers(dict):
    """Numbers words from 1 on in the order in which they are first asked for; 0 parts texts."""

    def __init__(self) -> None:
        super().__init__({SEPARATOR: 0})

    def __missing__(self, word: bytes) -> int:
        made = self[word] = len(self)
        return made

    def words(self) -> list[bytes]:
        """The words in the order of their numbers."""
        return list(self)[1:]


def numbered(texts: Iterable[list[bytes]], numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words of all texts end to end, number of words of each text)."""
    texts = list(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = map(numbers.__getitem__, chain.from_iterable(texts))
    return np.fromiter(flat, np.int64, int(sizes.sum())), sizes


def portions(
    batches: Iterable[pa.RecordBatch], most: int, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Slices of consecutive rows whose texts have about ``most`` bytes; one row at least."""
    for batch in batches:
        text = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of a column as bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()

"""Cutting texts into the matches of the byte-level tokenizers' pattern, many texts at once.

The pattern takes runs of letters, of digits, of white space and of other characters, so a match
begins where the kind of character changes, with three exceptions: the last white space before
another character is left out of its run, and belongs to the next match if it is a space; an
apostrophe that begins a match takes the ending of a contraction with it; a text begins a match.
All this is found on the bytes of many texts together. Different matches are then numbered by
value, so that each is looked up once, and those not met before go to the tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex

from oddrow.llm.chunks import ID, PORTION, REMEMBERED, Memory, _portions, _strings

OTHER, LETTER, NUMBER, SPACE = range(4)
_KINDS = {LETTER: r"\p{L}+", NUMBER: r"\p{N}+", SPACE: r"\s+"}
_BLANK, _APOSTROPHE = 0x20, 0x27
_ENDINGS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point."""
    surrogates = range(0xD800, 0xE000)
    every = "".join("\0" if c in surrogates else chr(c) for c in range(0x110000))
    kinds = np.full(len(every), OTHER, np.uint8)
    for kind, pattern in _KINDS.items():
        for run in regex.finditer(pattern, every):
            kinds[run.start() : run.end()] = kind
    return kinds


def _kind_of_bytes(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to."""
    table = _kinds()
    by_byte = np.full(256, OTHER, np.uint8)
    by_byte[:128] = table[:128]
    kinds = by_byte[data]
    at = np.flatnonzero(data >= 0xC0)
    lead = data[at]
    for length, least, bits in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        begins = at[lead & ~np.uint8(bits) == least]
        point = (data[begins] & bits).astype(np.int32)
        for k in range(1, length):
            point = point << 6 | data[begins + k] & 0x3F
        kind = table[point]
        for k in range(length):
            kinds[begins + k] = kind
    return kinds


def begins_of_matches(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Whether a match begins at each byte; ``texts``: where texts that are not empty begin."""
    kinds = _kind_of_bytes(data)
    first = np.zeros(len(data) + 1, bool)
    first[texts] = first[-1] = True
    begins = first.copy()
    begins[1:-1] |= kinds[1:] != kinds[:-1]
    # Places after white space that hold something else, in the same text.
    is_space = kinds == SPACE
    after = is_space[:-1] & ~is_space[1:] & ~first[1:-1]
    blank = after & (data[:-1] == _BLANK)
    begins[1:-1] &= ~blank
    begins[:-2] |= blank
    last = np.flatnonzero(after & ~blank)
    while (inside := data[last] & 0xC0 == 0x80).any():
        last = last - inside
    begins[last] = True
    quotes = np.flatnonzero(data == _APOSTROPHE)
    quotes = quotes[begins[quotes]]
    for ending in _ENDINGS:
        at = quotes[quotes + len(ending) < len(data)]
        for k, byte in enumerate(ending, 1):
            at = at[(data[at + k] == byte) & ~first[at + k]]
        begins[at + 1] = False
        begins[at + 1 + len(ending)] = True
    return begins[:-1]


class MatchEncoder:
    """Encodes texts through ``encode_matches``, which gives the ids of matches of the pattern.

    Ids are remembered as bytes, which the garbage collector need not follow.
    """

    def __init__(
        self,
        encode_matches: Callable[[list[str]], list[list[int]]],
        entries: int = REMEMBERED,
        portion: int = PORTION,
    ) -> None:
        self._encode_matches = encode_matches
        self._portion = portion
        self._known = Memory(entries)

    def encode(self, texts: pa.Array | list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string())
        _, offsets, data = texts.buffers()
        if not len(texts):
            return
        offsets = np.frombuffer(offsets, np.int64)[texts.offset :][: len(texts) + 1]
        for start, end in _portions(np.diff(offsets), self._portion):
            yield from self._encode_portion(data, offsets[start : end + 1])

    def _encode_portion(self, data: pa.Buffer, offsets: np.ndarray) -> Iterator[np.ndarray]:
        if offsets[0] == offsets[-1]:
            yield from [np.zeros(0, ID)] * (len(offsets) - 1)
            return
        data = data.slice(offsets[0], offsets[-1] - offsets[0])
        offsets = offsets - offsets[0]
        begins = begins_of_matches(np.frombuffer(data, np.uint8), offsets[:-1][np.diff(offsets) > 0])
        places = np.append(np.flatnonzero(begins), offsets[-1])
        matches = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), data)
        numbered = matches.dictionary_encode()
        values = self._learned(_strings(numbered.dictionary))
        at = numbered.indices.to_numpy()
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // ID.itemsize
        ids = np.frombuffer(b"".join(values), ID)
        counts = lengths[at]
        ends = np.cumsum(counts)
        place = np.int32 if max(ends[-1], len(ids)) < 2**31 else np.int64
        flat = np.arange(ends[-1], dtype=place)
        flat += np.repeat(((np.cumsum(lengths) - lengths)[at] - (ends - counts)).astype(place), counts)
        flat = ids[flat]
        bounds = np.concatenate([[0], ends])[np.searchsorted(places, offsets)]
        for a, b in zip(bounds, bounds[1:]):
            yield flat[a:b]

    def _learned(self, matches: list[str]) -> list[bytes]:
        """The ids of different matches."""
        values, unknown = self._known.recall(matches)
        made = self._encode_matches([matches[i] for i in unknown])
        flat = np.fromiter(chain.from_iterable(made), ID).tobytes()
        at = 0
        for i, ids in zip(unknown, made):
            value = flat[at : (at := at + ID.itemsize * len(ids))]
            values[i] = self._known.new[matches[i]] = value
        self._known.turn()
        return values

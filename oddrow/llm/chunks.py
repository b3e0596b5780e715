"""Cutting texts into pieces that a tokenizer may encode one by one, and remembering the result.

With the pattern of the byte-level tokenizers every match begins at a space that is followed by a
character other than white space: only ``\\s+`` alternatives span spaces, and they leave the last
space before such a character to the next match. A text may therefore be cut before these spaces,
and each chunk may be matched alone. Most chunks are one word, and frequent ones are remembered.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex

# Python's \s covers every character that the pattern's \s covers, and a few more.
_CUT = re.compile(r" (?=\S)")
# A space before any character of Python's \s, or at the end; for RE2.
_LOOSE_SPACE = r" (?:[\t-\r\x1c-\x20\x85\p{Z}]|\z)"
_PATTERN = regex.compile(public_tokenizers.PATTERN)
#: Entries of each of the two generations of a memory.
REMEMBERED = 400_000
ID = np.dtype("<u4")
#: Bytes of text whose chunks are numbered together.
PORTION = 8_000_000


def cut(text: str) -> list[str]:
    """The chunks of a text, without the space that each but the first begins with."""
    return _CUT.split(text)


def pieces_of(chunk: str) -> list[str]:
    """The matches of the pattern in a chunk, its leading space put back."""
    if chunk.isalpha():
        return [" " + chunk]
    if chunk[:-1].isalpha():  # a word and one character of another kind
        return [" " + chunk[:-1], chunk[-1]]
    return _PATTERN.findall(" " + chunk)


class Memory:
    """A bounded mapping in two generations; what was not used for a generation is forgotten."""

    def __init__(self, entries: int = REMEMBERED) -> None:
        self.entries = entries
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, keys: Iterable[str]) -> list[str]:
        """The keys it does not know; known ones are held for another generation."""
        new, old, unknown = self.new, self.old, []
        for key in keys:
            if key not in new:
                value = old.get(key)
                if value is None:
                    unknown.append(key)
                else:
                    new[key] = value
        return unknown

    def recall(self, keys: list[str]) -> tuple[list[bytes | None], list[int]]:
        """The values of different keys, and the places of those it does not know."""
        values, unknown = list(map(self.new.get, keys)), []
        for i in [i for i, value in enumerate(values) if value is None]:
            values[i] = held = self.old.get(keys[i])
            if held is None:
                unknown.append(i)
            else:
                self.new[keys[i]] = held
        return values, unknown

    def turn(self) -> None:
        """Begin a new generation if this one is full."""
        if len(self.new) > self.entries:
            self.old, self.new = self.new, {}


class ChunkEncoder:
    """Encodes texts through ``encode_pieces``, which gives the ids of matches of the pattern.

    The chunks of many texts are numbered by value first, so each different one is looked up
    once. Ids are remembered as bytes, which the garbage collector need not follow.
    """

    def __init__(
        self,
        encode_pieces: Callable[[list[str]], Iterable[list[int]]],
        entries: int = REMEMBERED,
        portion: int = PORTION,
    ) -> None:
        self._encode_pieces = encode_pieces
        self._portion = portion
        self._chunks = Memory(entries)
        self._pieces = Memory(entries)

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        texts = texts.cast(pa.large_string())
        made: list[np.ndarray] = []
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        for start, end in _portions(sizes, self._portion):
            made += self._encode_portion(texts.slice(start, end - start))
        return made

    def _encode_portion(self, texts: pa.Array) -> list[np.ndarray]:
        loose = pc.match_substring_regex(texts, _LOOSE_SPACE)
        made: list[np.ndarray] = [None] * len(texts)
        plain = pc.indices_nonzero(pc.invert(loose)).to_numpy()
        if len(plain):
            split = pc.split_pattern(texts.take(pa.array(plain)), " ")
            for i, ids in zip(plain, self._encode_split(split)):
                made[i] = ids
        others = pc.indices_nonzero(loose).to_numpy()
        if len(others):
            cuts = [cut(t) for t in texts.take(pa.array(others)).to_pylist()]
            split = pa.array(cuts, pa.large_list(pa.large_string()))
            for i, ids in zip(others, self._encode_split(split)):
                made[i] = ids
        return made

    def _encode_split(self, split: pa.Array) -> list[np.ndarray]:
        chunks, offsets = split.flatten(), split.offsets.to_numpy()
        after_space = np.ones(len(chunks), bool)
        after_space[offsets[:-1]] = False
        heads = _strings(chunks.filter(pa.array(~after_space)))
        numbered = chunks.filter(pa.array(after_space)).dictionary_encode()
        different = _strings(numbered.dictionary)
        values = self._learned(different) + self._ids_of([_PATTERN.findall(h) for h in heads])
        at = np.empty(len(chunks), np.int64)
        at[after_space] = numbered.indices.to_numpy()
        at[~after_space] = len(different) + np.arange(len(heads))
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // ID.itemsize
        starts = np.cumsum(lengths) - lengths
        ids = np.frombuffer(b"".join(values), ID)
        counts = lengths[at]
        ends = np.cumsum(counts)
        place = np.int32 if max(ends[-1], len(ids)) < 2**31 else np.int64
        flat = np.arange(ends[-1], dtype=place)
        flat += np.repeat((starts[at] - (ends - counts)).astype(place), counts)
        flat = ids[flat]
        bounds = np.concatenate([[0], ends])[offsets]
        return [flat[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learned(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that follow a space."""
        values, unknown = self._chunks.recall(chunks)
        made = self._ids_of([pieces_of(chunks[i]) for i in unknown])
        for i, value in zip(unknown, made):
            values[i] = self._chunks.new[chunks[i]] = value
        self._chunks.turn()
        self._pieces.turn()
        return values

    def _ids_of(self, cuts: list[list[str]]) -> list[bytes]:
        """The ids of sequences of pieces."""
        lacking = self._pieces.missing({p for pieces in cuts for p in pieces})
        known = self._pieces.new
        ids = list(self._encode_pieces(lacking)) if lacking else []
        flat = np.fromiter(chain.from_iterable(ids), ID).tobytes()
        at = 0
        for piece, each in zip(lacking, ids):
            known[piece] = flat[at : (at := at + ID.itemsize * len(each))]
        return [
            known[pieces[0]] if len(pieces) == 1 else b"".join(map(known.__getitem__, pieces))
            for pieces in cuts
        ]


def _strings(values: pa.Array) -> list[str]:
    """The same as ``to_pylist``, several times as fast."""
    return values.to_numpy(zero_copy_only=False).tolist()


def _portions(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes, at least one text each."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)

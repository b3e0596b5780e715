"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

import numpy as np
import xxhash

WIDTH = 5
WORDS_REMEMBERED = 100_000
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(_MULTIPLIERS[1])
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(_MULTIPLIERS[2])
    return values ^ (values >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


_hashes = _WordHashes()


class ShingleSet(NamedTuple):
    key: int | None  # hash of the whole word sequence; None without words
    items: np.ndarray  # sorted distinct hashes


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[ShingleSet]:
    """The set of each text: lower-cased A-Z, words between ASCII white space.

    With fewer words than ``width`` the whole sequence is the one shingle; without words the set
    is empty.
    """
    words = [(t or "").encode().lower().split() for t in texts]
    lengths = [len(w) for w in words]
    flat = np.fromiter(
        map(_hashes.__getitem__, chain.from_iterable(words)), np.uint64, sum(lengths)
    )
    if len(_hashes) > WORDS_REMEMBERED:
        _hashes.clear()
    span = max(0, len(flat) - width + 1)
    grams = flat[:span]
    for step in range(1, width):
        grams = mix(grams * np.uint64(_MULTIPLIERS[0]) + flat[step : span + step])
    made, at = [], 0
    for own, n in zip(words, lengths):
        joined = b" ".join(own)
        if n >= width:
            items = np.sort(grams[at : at + n - width + 1])
            fresh = np.empty(len(items), bool)
            fresh[0] = True
            np.not_equal(items[1:], items[:-1], out=fresh[1:])
            items = items[fresh]
        elif n:
            items = np.array([xxhash.xxh3_64_intdigest(joined, seed=n)], np.uint64)
        else:
            items = np.empty(0, np.uint64)
        made.append(ShingleSet(xxhash.xxh3_64_intdigest(joined) if n else None, items))
        at += n
    return made

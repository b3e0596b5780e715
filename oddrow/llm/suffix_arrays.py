"""Suffix arrays over numbered words, and searches in them.

A sequence holds the words of several texts end to end, each text followed by a 0, which is the
number of no word.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

KEY_BITS = 63


def _starts_of_groups(keys: np.ndarray) -> np.ndarray:
    """For sorted keys: True where a key differs from the one before."""
    first = np.empty(len(keys), bool)
    first[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    return first


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """The start of every suffix, in the order of the suffixes.

    Suffixes are first sorted by as many words as fit into one key. Those that still agree are
    sorted again by the places of what follows them, which multiplies the length compared each
    time, until all differ.
    """
    n = len(sequence)
    if not n:
        return np.empty(0, np.int64)
    sequence = sequence.astype(np.int64) + 1  # 0 is past the end
    bits = max(1, int(sequence.max()).bit_length())
    compared = max(1, KEY_BITS // bits)
    padded = np.concatenate([sequence, np.zeros(compared, np.int64)])
    keys = np.zeros(n, np.int64)
    for j in range(compared):
        keys <<= bits
        keys |= padded[j : n + j]
    order = np.argsort(keys)
    first = _starts_of_groups(keys[order])
    # The place of a suffix is that of the first of its group, from 1 on; 0 is past the end.
    places = np.zeros(n, np.int64)
    places[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    bits = n.bit_length()
    per_key = max(2, KEY_BITS // bits)
    alone = first & np.append(first[1:], True)
    undecided = np.flatnonzero(~alone)
    while len(undecided):
        held = order[undecided]
        keys = places[held]
        for j in range(1, per_key):
            after = held + j * compared
            inside = after < n
            keys = (keys << bits) | np.where(inside, places[np.where(inside, after, 0)], 0)
        sorting = np.argsort(keys)
        held, keys = held[sorting], keys[sorting]
        first = _starts_of_groups(keys)
        order[undecided] = held
        places[held] = np.maximum.accumulate(np.where(first, undecided, 0)) + 1
        alone = first & np.append(first[1:], True)
        undecided = undecided[~alone]
        compared = min(n, compared * per_key)
    return order


def _bound(words, suffixes, low, high, offset, wanted, after: bool) -> np.ndarray:
    """Per search, the first place in [low, high) whose word at ``offset`` is not below (or is
    above) the wanted one, by halving."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        found = words[suffixes[middle] + offset]
        right = found <= wanted[open_] if after else found < wanted[open_]
        low[open_[right]] = middle[right] + 1
        high[open_[~right]] = middle[~right]
        open_ = open_[low[open_] < high[open_]]
    return low


class Matches(NamedTuple):
    """Of searched suffixes that occur up to their width: which, and their range of places."""

    which: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: (length, low, high): the suffixes in these places agree with a searched one for as long.
    longer: list[tuple[int, np.ndarray, np.ndarray]]


def search(
    sequence: np.ndarray,
    suffixes: np.ndarray,
    wanted: np.ndarray,
    starts: np.ndarray,
    ends: np.ndarray,
    widths: np.ndarray,
) -> Matches:
    """Search ``wanted[starts:ends]``, each at least ``widths`` long, word by word.

    Each word narrows the range of a search by two binary searches. Ranges at the width are the
    occurrences; those of every further length tell how long each occurrence goes on.
    """
    longest = int((ends - starts).max(initial=0))
    words = np.concatenate([sequence, np.zeros(longest + 1, sequence.dtype)])
    which = np.arange(len(starts))
    low = np.zeros(len(starts), np.int64)
    high = np.full(len(starts), len(suffixes), np.int64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    longer = []
    for offset in range(longest):
        more = starts[which] + offset < ends[which]
        which, low, high = which[more], low[more], high[more]
        if not len(which):
            break
        word = wanted[starts[which] + offset]
        begin = _bound(words, suffixes, low, high, offset, word, after=False)
        high = _bound(words, suffixes, begin, high, offset, word, after=True)
        kept = begin < high
        which, low, high = which[kept], begin[kept], high[kept]
        full = widths[which] == offset + 1
        if full.any():
            found.append((which[full], low[full], high[full]))
        long = widths[which] <= offset + 1
        if long.any():
            at, once = np.unique(low[long], return_index=True)
            longer.append((offset + 1, at, high[long][once]))
    if not found:
        none = np.empty(0, np.int64)
        return Matches(none, none, none, longer)
    return Matches(*(np.concatenate(x) for x in zip(*found)), longer)


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(all numbers of the ranges, the range of each)."""
    sizes = high - low
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(low)), sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + (low - (ends - sizes))[of], of

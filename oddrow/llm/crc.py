"""CRC-32 of joined byte strings from the CRCs and lengths of their parts."""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

_POLYNOMIAL = np.uint32(0xEDB88320)
_BYTES = (0, 8, 16, 24)


def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A linear map, given as the images of the 32 single bits, of many values."""
    out = np.zeros_like(values)
    for bit, image in enumerate(columns):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), image, np.uint32(0))
    return out


@cache
def _columns(power: int) -> np.ndarray:
    """What ``2 ** power`` zero bytes after a message do to the single bits of its CRC."""
    if power:
        half = _columns(power - 1)
        return _apply(half, half)
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        bits = (bits >> np.uint32(1)) ^ np.where(bits & np.uint32(1), _POLYNOMIAL, np.uint32(0))
    return bits


@cache
def _tables(power: int) -> list[np.ndarray]:
    """The same map by the four bytes of a CRC."""
    values = np.arange(256, dtype=np.uint32)
    return [_apply(_columns(power), values << np.uint32(shift)) for shift in _BYTES]


def joined(first: np.ndarray, second: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs of ``a + b`` from those of a and b and the number of bytes in b."""
    moved = first.astype(np.uint32)
    for power in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero(lengths >> power & 1)
        part = moved[at]
        tables = zip(_tables(power), _BYTES)
        moved[at] = np.bitwise_xor.reduce(
            [table[part >> np.uint32(shift) & np.uint32(255)] for table, shift in tables]
        )
    return moved ^ second.astype(np.uint32)


def runs(crcs: np.ndarray, lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """CRCs of all runs of 1, 2, ... ``most`` adjacent words, joined by one space."""
    made = [crcs.astype(np.uint32)]
    space = np.uint32(zlib.crc32(b" "))
    after_space = joined(np.full(len(crcs), space), crcs, lengths) if most > 1 else crcs
    for n in range(2, most + 1):
        if len(crcs) < n:
            break
        made.append(joined(made[-1][:-1], after_space[n - 1 :], lengths[n - 1 :] + 1))
    return made

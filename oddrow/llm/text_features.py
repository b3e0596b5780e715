"""Numbers that describe how a text is written: shares of character kinds, repetition, lengths."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

#: Kinds of characters, in the order of the counts.
KINDS = (
    "lower", "upper", "other_letter", "digit", "space", "line", "stop", "comma", "exclamation",
    "question", "bar", "symbol", "bracket", "quote", "dash", "other",
)
_MARKS = {
    "\n": "line", ".": "stop", ",": "comma", ";": "comma", ":": "comma", "!": "exclamation",
    "?": "question", "|": "bar", **dict.fromkeys("#*$%&<>@^~=+\\/_", "symbol"),
    **dict.fromkeys("()[]{}", "bracket"), **dict.fromkeys("\"'`", "quote"), "-": "dash",
}
_CATEGORIES = {"Ll": "lower", "Lu": "upper", "Lt": "upper", "Lm": "other_letter",
               "Lo": "other_letter", "Nd": "digit", "Nl": "digit", "No": "digit",
               "Zs": "space", "Zl": "line", "Zp": "line", "Cc": "space", "Sm": "symbol",
               "Sc": "symbol", "Sk": "symbol", "So": "symbol", "Pd": "dash", "Ps": "bracket",
               "Pe": "bracket", "Pi": "quote", "Pf": "quote"}
_PLANE = 1 << 16
NAMES = (
    *KINDS, "word_length", "long_words", "bare_words", "shouted_words", "distinct_words",
    "top_word", "repeated_windows", "repeated_lines", "words_per_line", "words_per_stop",
    "log_words", "has_words",
)


@lru_cache(maxsize=1)
def _kind_of() -> np.ndarray:
    """The kind of every character of the first plane."""
    at = {k: i for i, k in enumerate(KINDS)}
    kinds = np.empty(_PLANE, np.uint8)
    for code in range(_PLANE):
        c = chr(code)
        kinds[code] = at[_MARKS.get(c) or _CATEGORIES.get(unicodedata.category(c), "other")]
    return kinds


def describe(text: str | None) -> np.ndarray:
    """The features of one whole text; all zero for a text without characters."""
    made = np.zeros(len(NAMES), np.float32)
    if not text:
        return made
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds = _kind_of()[np.minimum(codes, _PLANE - 1)]
    counts = np.bincount(kinds, minlength=len(KINDS)).astype(np.float64)
    made[: len(KINDS)] = np.log1p(50 * counts / len(codes))
    words = text.split()
    n = len(words)
    if not n:
        return made
    lines = [line for line in text.split("\n") if line.strip()]
    seen: dict[str, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    windows = max(1, n - 2)
    distinct_windows = len(set(zip(words, words[1:], words[2:]))) if n > 2 else 1
    bare = shouted = long = 0
    for word, times in seen.items():
        if len(word) > 15:
            long += times
        if word.isupper():
            shouted += times
        elif not any(map(str.isalpha, word)):
            bare += times
    made[len(KINDS) :] = (
        (len(codes) - counts[4] - counts[5]) / n / 5,
        np.log1p(50 * long / n),
        np.log1p(50 * bare / n),
        np.log1p(20 * shouted / n),
        np.log1p(len(seen)) / np.log1p(n),
        np.log1p(20 * (max(seen.values()) - 1) / n),
        5 * (1 - distinct_windows / windows),
        5 * (1 - len(set(lines)) / len(lines)),
        np.log1p(n / len(lines)),
        np.log1p(n / (1 + counts[6] + counts[8] + counts[9])),
        np.log1p(n) / 3,
        1,
    )
    return made

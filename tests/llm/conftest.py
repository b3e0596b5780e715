"""Fixtures of the text-preparation tests."""

from __future__ import annotations

import random

import pytest

from oddrow.sources.storage import Scratch

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COMMON = "the of and to in a is that for it as was with be by on not he his but".split()


@pytest.fixture
def scratch(spark):
    made = Scratch(spark)
    yield made
    made.drop()


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text[, source]) tuples."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def prose():
    """Seeded invented prose of ``n`` words, in lines of some sentences."""

    def write(n, seed):
        r = random.Random(seed)
        words = []
        for _ in range(n):
            plain = r.choice(COMMON) if r.random() < 0.3 else _invented(r)
            words.append(plain + (".\n" if r.random() < 0.02 else ". " if r.random() < 0.08 else " "))
        return "".join(words).strip()

    return write


def _invented(r):
    parts = ("an", "re", "tion", "lo", "mi", "ka", "sel", "or", "ta", "ne", "vi", "du")
    return "".join(r.choice(parts) for _ in range(r.randint(2, 4)))

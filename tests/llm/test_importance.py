"""CRC composition, automaton features, draws and ranks against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oddrow.llm import copies, crc, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCH = "item_id long, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def features(text, most=1):
    w = words(text)
    return [
        zlib.crc32(" ".join(w[i : i + n]).encode()) % 10_000
        for n in range(1, most + 1)
        for i in range(len(w) - n + 1)
    ]


def expected(rows, target, most=1):
    """[(doc_id, n_features, weight, score, rank)] in any order."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text, most))
    for text in target:
        t.update(features(text, most))
    total_s, total_t = sum(s.values()) + 10_000.0, sum(t.values()) + 10_000.0
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * total_s / ((s[b] + 1.0) * total_t)))
    out = []
    for doc_id, text in rows:
        found = features(text, most)
        weight = sum(map(gain, found))
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, weight + noise, len(words(text))])
    fit = [r for r in out if r[4] >= 20]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(fit[: 10 * len(fit) // 100], 1):
        row.append(place)
    return sorted(map(str, ((*r[:4], r[5] if len(r) > 5 else None) for r in out)))


def rows_of(found):
    names = ("doc_id", "n_features", "weight", "score", "rank")
    return sorted(str(tuple(r[n] for n in names)) for r in found.collect())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=40), st.binary(max_size=300)), min_size=1))
def test_joined_crc(parts):
    first, second = (np.array([zlib.crc32(p[i]) for p in parts], np.uint32) for i in (0, 1))
    sizes = np.array([len(b) for _, b in parts])
    assert crc.joined(first, second, sizes).tolist() == [zlib.crc32(a + b) for a, b in parts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=8), st.integers(1, 3))
def test_features_are_the_hashed_runs(texts, most):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts] + [None, "", "A a\x00É 7b"]
    made = importance.features_of(pa.array(texts, pa.string()), most)
    wanted = [features(t, most) for t in texts]
    assert made.n_words.tolist() == [len(words(t)) for t in texts]
    assert made.n_features.tolist() == list(map(len, wanted))
    assert made.buckets.tolist() == [b for each in wanted for b in each]


@pytest.fixture
def corpus(prose):
    rows = [(i, prose(15 + 2 * i, i)) for i in range(60)]
    rows += [(60, rows[50][1]), (7, rows[7][1]), (None, prose(90, 3)), (61, None), (62, "")]
    return rows, [prose(40, 1), prose(60, 200), None, ""]


@pytest.mark.parametrize("most, portion", [(1, 4_000_000), (2, 500)])
def test_resample_equals_plain_python(
    spark, make_docs, scratch, corpus, monkeypatch, most, portion
):
    monkeypatch.setattr(importance, "PORTION_BYTES", portion)
    rows, target = corpus
    benchmark = spark.createDataFrame(list(enumerate(target)), BENCH)
    docs = make_docs(rows)
    found = importance.resample(docs, benchmark, scratch, most=most)
    assert rows_of(found) == expected(rows, target, most)
    drawn = importance.draw(docs, found)
    assert drawn.columns == docs.columns
    ids = [r["doc_id"] for r in found.filter("rank IS NOT NULL").collect()]
    assert sorted(r["doc_id"] for r in drawn.collect()) == sorted(ids)


def test_repeated_rows_are_a_third_of_the_table(spark, make_docs, scratch, prose):
    rows = [(i, prose(30, i)) for i in range(40)] + [(99, prose(30, 0) * 2)] * 25
    target = [prose(30, 0)]
    found = importance.resample(
        make_docs(rows), spark.createDataFrame([(0, target[0])], BENCH), scratch
    )
    assert rows_of(found) == expected(rows, target)


def test_copies_in_chunks(spark):
    rows = spark.createDataFrame([("a", 3), ("b", 25), ("c", 1)], "name string, n long")
    made = copies.one_by_one(rows, "n", "k", chunk=4)
    found = sorted((r["name"], r["k"]) for r in made.collect())
    wanted = [("a", k) for k in range(3)] + [("b", k) for k in range(25)] + [("c", 0)]
    assert found == wanted


def test_empty_tables_and_clashing_columns(spark, make_docs, scratch):
    none = spark.createDataFrame([], BENCH)
    docs = make_docs([(1, "a b c"), (2, None)])
    assert rows_of(importance.resample(docs, none, scratch)) == expected(
        [(1, "a b c"), (2, None)], []
    )
    assert importance.resample(docs.limit(0), none, scratch).collect() == []
    odd = spark.createDataFrame(
        [(1, "w " * 30, 5, 6, 7, "x")] * 10,
        "doc_id long, text string, score int, rank int, mark int, n string",
    )
    found = importance.resample(odd, none, scratch)
    assert sorted(r["rank"] or 0 for r in found.collect()) == [0] * 9 + [1]
    drawn = importance.draw(odd, found).collect()
    assert [tuple(r) for r in drawn] == [(1, "w " * 30, 5, 6, 7, "x")]


def test_very_long_text(spark, make_docs, scratch, prose):
    rows = [(i, prose(50_000 if i == 3 else 30, i)) for i in range(12)]
    found = importance.resample(
        make_docs(rows), spark.createDataFrame([(0, rows[3][1])], BENCH), scratch
    )
    assert rows_of(found) == expected(rows, [rows[3][1]])

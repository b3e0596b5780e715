"""Suffix arrays and benchmark decontamination against plain loops."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oddrow.llm import decontaminate
from oddrow.llm.suffix_arrays import search, suffix_array
from oddrow.llm.words import LETTERS, words_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCH = "item_id long, text string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def expected(docs, items, window=10):
    """{row: (words, hit words, items, longest match)} by comparing every place."""
    out = []
    for text in docs:
        words, hit, found, longest = WORD.findall(lower(text)), set(), set(), 0
        for name, item in items:
            own = WORD.findall(lower(item))
            n = min(window, len(own))
            for j in range(len(own) - n + 1 if n else 0):
                for k in range(len(words) - n + 1):
                    if words[k : k + n] == own[j : j + n]:
                        hit |= set(range(k, k + n))
                        found.add("" if name is None else str(name))
                        size = n
                        while words[k + size : k + size + 1] and words[k + size : k + size + 1] == own[j + size : j + size + 1]:
                            size += 1
                        longest = max(longest, size)
        out.append((len(words), len(hit), sorted(found), longest))
    return out


def rows_of(found):
    return sorted(
        (r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"],
         r["longest"])
        for r in found.collect()
    )


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_sorts_all_suffixes(numbers):
    made = suffix_array(np.array(numbers, np.int64))
    assert made.tolist() == sorted(range(len(numbers)), key=lambda i: numbers[i:])


def test_suffix_array_of_large_numbers_and_one_repeated_word():
    big = np.array([1 << 40, 5, 1 << 40, 5, 7], np.int64)
    assert suffix_array(big).tolist() == sorted(range(5), key=lambda i: big[i:].tolist())
    assert suffix_array(np.ones(2000, np.int64)).tolist() == list(range(1999, -1, -1))


def test_search_finds_every_place_of_a_window():
    rng = np.random.default_rng(3)
    sequence = rng.integers(0, 4, 500)
    order = suffix_array(sequence)
    wanted = rng.integers(1, 4, 40)
    starts = np.arange(0, 36)
    found = search(sequence, order, wanted, starts, np.full(36, 40), np.full(36, 4))
    places = {i: set() for i in starts.tolist()}
    for which, low, high in zip(found.which, found.low, found.high):
        places[int(which)] = set(order[low:high].tolist())
    for i in starts.tolist():
        same = [k for k in range(497) if (sequence[k : k + 4] == wanted[i : i + 4]).all()]
        assert places[i] == set(same)


def test_words():
    assert words_of("Ab1-cÉ\x00d ".encode()) == [b"ab1", "cÉ".encode(), b"d"]
    assert words_of(b"Ab1-c", LETTERS) == [b"ab", b"c"]
    assert words_of(None) == [] == words_of(b"")


@pytest.fixture
def corpus():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)]
    write = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(i, write(r.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(25)]
    items += [(3, write(30)), (None, write(12)), (90, items[24][1]), (91, None), (92, "")]
    docs = [write(r.randint(0, 80)) for _ in range(30)]
    for i in range(0, 25, 2):
        docs[i] += ", " + items[i][1].upper() + "! " + write(3)
    docs += [None, "", "...", docs[0], docs[0], items[27][1] or write(1)]
    return docs, items


@pytest.mark.parametrize("shard, block", [(4_000_000, 8_000_000), (300, 200)])
def test_matches_equal_plain_search(spark, make_docs, scratch, corpus, monkeypatch, shard, block):
    """Also with many shards and blocks; some documents are longer than a shard."""
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    texts, items = corpus
    # Items of one or three words hit nearly everywhere; both sides must agree on that too.
    docs = make_docs([(i, t) for i, t in enumerate(texts)])
    benchmark = spark.createDataFrame(items, BENCH)
    found = decontaminate.find_matches(docs, benchmark, scratch)
    wanted = [(i, *row) for i, row in enumerate(expected(texts, items))]
    assert rows_of(found) == wanted
    kept = decontaminate.remove(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [w[0] for w in wanted if not w[2]]


def test_only_long_items_leave_most_documents_alone(spark, make_docs, scratch, prose):
    items = [(i, prose(40, 100 + i)) for i in range(5)]
    texts = [prose(200, i) for i in range(20)]
    texts[4] += " " + items[2][1]
    texts[9] = items[0][1][: len(items[0][1]) // 2] + " " + texts[9]
    docs = make_docs(list(enumerate(texts)))
    found = decontaminate.find_matches(docs, spark.createDataFrame(items, BENCH), scratch)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert {i for i, r in by_id.items() if r["items"]} == {4, 9}
    assert by_id[4]["items"] == ["2"] and by_id[4]["longest"] == len(WORD.findall(items[2][1]))


def test_empty_tables(spark, make_docs, scratch):
    none = spark.createDataFrame([], BENCH)
    docs = make_docs([(1, "a b c"), (2, None)])
    assert rows_of(decontaminate.find_matches(docs, none, scratch)) == [
        (1, 3, 0, [], 0), (2, 0, 0, [], 0),
    ]
    some = spark.createDataFrame([(1, "a b")], BENCH)
    assert decontaminate.find_matches(docs.limit(0), some, scratch).collect() == []
    assert decontaminate.remove(docs.limit(0), some).collect() == []


def test_null_ids_extra_columns_and_repeated_rows(spark, scratch):
    schema = "doc_id long, text string, shard int, row string, items int, sizes int, n_words int"
    rows = [(None, "x a b c", 1, "r", 2, 3, 4)] * 3 + [(7, "nothing", 1, None, None, 3, 4)]
    docs = spark.createDataFrame(rows, schema)
    benchmark = spark.createDataFrame([("q", "A b C", 5)], "item_id string, text string, row int")
    found = decontaminate.find_matches(docs, benchmark, scratch).collect()
    assert sorted((r["doc_id"] or 0, r["items"], r["longest"]) for r in found) == [
        (0, ["q"], 3), (0, ["q"], 3), (0, ["q"], 3), (7, [], 0),
    ]
    assert [tuple(r) for r in decontaminate.remove(docs, benchmark).collect()] == [rows[3]]


def test_very_long_text_and_a_window_shared_by_many_items(spark, make_docs, scratch, prose):
    shared = "one two three four five six seven eight nine ten"
    items = [(i, f"{shared} item{i} end") for i in range(300)]
    docs = make_docs([(1, prose(60_000, 1) + f" {shared} item7 end"), (2, shared)])
    found = decontaminate.find_matches(docs, spark.createDataFrame(items, BENCH), scratch)
    one, two = sorted(found.collect(), key=lambda r: r["doc_id"])
    assert len(one["items"]) == len(two["items"]) == 300
    assert one["longest"] == 12 and two["longest"] == 10

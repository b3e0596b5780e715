"""The cuckoo filter, its index, and exact duplicates."""

import hashlib
import random

import pytest

from oddrow.llm import cuckoo
from oddrow.llm.cuckoo import CuckooFilter, Shard


def digest(i):
    return hashlib.sha256(str(i).encode()).digest()


def test_filter_inserts_and_deletes():
    keys = [Shard.key(digest(i)) for i in range(150)]
    made = CuckooFilter(64)
    assert all(made.insert(k) for k in keys)
    assert all(k in made for k in keys) and made.size == 150
    assert all(made.delete(k) for k in keys[:100])
    assert all(k in made for k in keys[100:]) and made.size == 50
    assert sum(k in made for k in keys[:100]) <= 2
    assert CuckooFilter(state=made.to_bytes()).size == 50


def test_full_filter_says_so_and_a_shard_is_resized():
    made = CuckooFilter(2)
    assert not all(made.insert(Shard.key(digest(i))) for i in range(20))
    shard = Shard()
    hits = sum(shard.add(digest(i)) for i in range(5_000))
    assert shard.filter.buckets >= 5_000 / 4 and hits < 50
    assert all(Shard.key(digest(i)) in shard.filter for i in range(5_000))
    assert all(shard.add(digest(i)) for i in range(5_000))


def test_a_digest_leaves_with_its_last_document():
    shard = Shard()
    shard.add(digest(1), 2)
    assert shard.remove(digest(1)) and Shard.key(digest(1)) in shard.filter
    assert shard.remove(digest(1)) and Shard.key(digest(1)) not in shard.filter
    assert not shard.remove(digest(1)) and shard.filter.size == 0


def brute_force(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        out.append((doc_id, keep, len(ids), doc_id == keep, sha))
    return sorted(out, key=repr)


ROWS = [
    (1, "a"), (2, "a"), (3, "A"), (4, "a "), (5, None), (6, ""), (7, "b"), (7, "b"), (8, "é"),
    (9, "é"), (None, "a"), (None, "only null"), (10, "x" * 100_000), (11, "x" * 100_000),
]


def test_copies_equal_brute_force(make_docs, scratch):
    got = cuckoo.find_copies(make_docs(ROWS).repartition(3), scratch).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(ROWS)


def test_hot_text_and_many_shards(make_docs, scratch, monkeypatch):
    monkeypatch.setattr(cuckoo, "SHARD_KEYS", 40)
    monkeypatch.setattr(cuckoo, "COMBINE_KEYS", 10)
    r = random.Random(2)
    rows = [(i, "hot" if i % 3 == 0 else f"text {r.randrange(200)}") for i in range(600)]
    got = cuckoo.find_copies(make_docs(rows).repartition(7), scratch).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(rows)


def test_false_hits_are_found_out(make_docs, scratch, monkeypatch):
    monkeypatch.setattr(cuckoo, "FINGERPRINT", 1)  # nearly every digest looks like another
    rows = [(i, f"text {i // 2}" if i < 20 else f"own {i}") for i in range(60)]
    got = cuckoo.find_copies(make_docs(rows), scratch).collect()
    assert sorted(map(tuple, got), key=repr) == brute_force(rows)


def test_empty_table(make_docs, scratch):
    assert cuckoo.find_copies(make_docs([]), scratch).collect() == []


def test_rows_that_stay(make_docs, scratch):
    docs = make_docs(ROWS).withColumnRenamed("lang", "keep_id").withColumnRenamed("source", "row")
    kept = cuckoo.drop_copies(docs, scratch)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(
        [2, 3, 4, 6, 7, 8, 9, None, 11], key=repr
    )


@pytest.mark.parametrize("shards", [1, 3])
def test_kept_index(make_docs, shards):
    first = make_docs([(1, "a"), (2, "a"), (3, "b"), (4, None)])
    index = cuckoo.update_index(None, first, shards)
    index = cuckoo.update_index(index, make_docs([(5, "c"), (6, "b")]), shards)
    index = cuckoo.update_index(index, make_docs([(1, "a"), (3, "b"), (6, "b")]), shards, True)
    asked = cuckoo.probe_index(index, make_docs([(7, t) for t in ("a", "b", "c", "", "d")]), shards)
    live = {bytes(r["digest"]).hex(): (r["n"], r["hit"]) for r in asked.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert live[sha("a")] == (1, True) and live[sha("c")] == (1, True)
    assert live[sha("")] == (1, True) and live[sha("b")][0] == 0 and live[sha("d")][0] == 0

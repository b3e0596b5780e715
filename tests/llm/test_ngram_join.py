"""The n-gram join against brute force, and its parts."""

import random
import re

import numpy as np
import pytest

from oddrow.llm import ngram_join as nj
from oddrow.llm.components import connected
from oddrow.llm.shingles import shingle_sets


def brute_force(rows):
    sets = {}
    for i, (_, text) in enumerate(rows):
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        whole = {tuple(words)} if words else set()
        sets[i] = (
            {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else whole
        )
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sets:
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = top(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return sorted(
        (doc_id, len(sets[i]), least.get(top(i))) for i, (doc_id, _) in enumerate(rows)
    )


def near_copies(prose, seed, copies, changes):
    """A text and copies with a growing number of changed words."""
    r = random.Random(seed)
    words = prose(200, seed).split(" ")
    made = [" ".join(words)]
    for k in range(copies):
        own = list(words)
        for _ in range(r.randint(0, changes)):
            own[r.randrange(len(own))] = f"w{r.randrange(1000)}"
        made.append(" ".join(own) + (" End" if k % 3 == 0 else ""))
    return made


@pytest.fixture
def crowd(prose):
    texts = []
    for seed in range(8):
        texts += near_copies(prose, seed, 3 + 5 * (seed % 3), 4 + 4 * (seed % 3))
    texts += near_copies(prose, 99, 60, 16)
    passage = prose(60, 500)
    texts += [prose(40 + 20 * k, 600 + k) + " " + passage for k in range(12)]
    texts += ["One two", "one TWO", "one\ttwo ", "one two three", "É a b c d e", "é a b c d e"]
    texts += [None, "", " \n\t", "x", "X", "a b c d e", "a  b c\nd e", "a b c d e f"]
    texts += [prose(3000, 7), prose(3000, 7) + " more words at the end of it"]
    return [(10 + 3 * i, t) for i, t in enumerate(texts)]


def test_components_equal_brute_force(make_docs, scratch, crowd):
    rows = crowd + crowd[5:8]  # repeated rows
    got = nj.join_near(make_docs(rows).repartition(5), scratch).collect()
    assert sorted(map(tuple, got)) == brute_force(rows)


def test_small_blocks_and_buckets_change_nothing(make_docs, scratch, crowd, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 4)
    monkeypatch.setattr(nj, "BUCKET_TOKENS", 2_000)
    monkeypatch.setattr(nj, "PACKED_TOKENS", 1_500)
    rows = crowd + crowd[3:30]
    got = nj.join_near(make_docs(rows).repartition(3), scratch).collect()
    assert sorted(map(tuple, got)) == brute_force(rows)


def test_null_ids_and_empty_table(make_docs, scratch):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, "lonely words"), (None, None)]
    got = nj.join_near(make_docs(rows), scratch).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None)
    expected = [(4, 2, 4), (None, 0, None), (None, 1, None), (None, 2, 4)]
    assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)


def test_empty_table(make_docs, scratch):
    assert nj.join_near(make_docs([]), scratch).collect() == []


def test_one_of_each_group_stays(make_docs, scratch, crowd):
    docs = make_docs(crowd).withColumnRenamed("lang", "component_id").withColumnRenamed(
        "n_chars", "key"
    )
    kept = nj.keep_one_of_each(docs, scratch)
    assert kept.columns == docs.columns
    expected = {doc_id for doc_id, _, root in brute_force(crowd) if doc_id == root}
    assert {r["doc_id"] for r in kept.collect()} == expected


def test_rows_of_one_id_are_told_apart(make_docs, scratch):
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "g h"), (5, "g h"), (None, "g h"), (6, None)]
    kept = nj.keep_one_of_each(make_docs(rows), scratch).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [
        (3, "a b c d e f"), (5, "g h"), (6, None)
    ]


def test_linked_sets_meet_under_every_order():
    random_ = np.random.default_rng(5)
    for _ in range(200):
        n = int(random_.integers(5, 80))
        base = random_.integers(0, 2**48, n, dtype=np.uint64)
        other = base.copy()
        changed = int(random_.integers(0, max(1, n // 7)) )
        other[:changed] = random_.integers(0, 2**48, changed, dtype=np.uint64)
        common = len(np.intersect1d(base, other))
        if 100 * common < 75 * (2 * n - common):
            continue
        df = {t: 2 + int(t) % 3 for t in np.r_[base, other]}
        for order in range(1, nj.ORDERS + 1):
            first = [
                nj.prefix(x, np.array([df[t] for t in x], np.uint16), n, order)
                for x in (base, other)
            ]
            assert len(np.intersect1d(*first))


def test_shingles_of_short_and_odd_texts():
    sets = shingle_sets(["a b", "A b", "a b c d e", "a b c d e a b c d e", "", None, "É x"])
    assert [len(s.items) for s in sets] == [1, 1, 1, 5, 0, 0, 1]
    assert sets[4].key is None and sets[5].key is None
    assert shingle_sets(["x A b"])[0].key == shingle_sets(["X\na  B"])[0].key


def test_components_of_chains_and_stars(spark, scratch):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 40)]
    loop = [(5000, 5000), (7, 3)]
    edges = spark.createDataFrame(chain + star + loop, "a long, b long")
    found = {r["node"]: r["root"] for r in connected(edges, scratch).collect()}
    assert all(found[i] == 0 for i in range(61))
    assert all(found[1000 + i] == 1000 for i in range(40))
    assert 5000 not in found


def test_buckets_have_no_cap_and_give_whole_tokens_back():
    assert [nj.bucket_bits(n) for n in (0, 1, 2_000_000, 2_000_001, 4_000_001)] == [0, 0, 0, 1, 2]
    assert nj.bucket_bits(2_000_000 << 20) == 20
    tokens = np.array([0, 1 << 63, (1 << 64) - 1, 0x123456789ABCDEF0], np.uint64)
    low = tokens & np.uint64((1 << nj.TOKEN_BITS) - 1)
    for bits in (16, 17, 20):
        high = nj._bucket(tokens, bits).astype(np.uint64) >> np.uint64(bits - 16)
        assert (low | high << np.uint64(nj.TOKEN_BITS)).tolist() == tokens.tolist()
    assert nj._bucket(tokens, 0).tolist() == [0] * 4

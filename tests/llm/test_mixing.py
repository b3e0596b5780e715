"""Weighted fair queueing against a plain queue."""

from functools import partial

import pytest

from oddrow.llm import copies, mixing


def level_targets(sizes):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = float(sum(sizes.values())), dict.fromkeys(names, 0.0), set(names)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        share = {s: target[s] + left * weight[s] / total for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        for s in open_:
            target[s] = min(share[s], 3.0 * sizes[s])
        left = sum(sizes.values()) - sum(target.values())
        open_ -= full
    return target


ROWS = (
    [(i, "w " * (5 + i % 11), "big") for i in range(300)]
    + [(1000 + i, "w " * (1 + i % 7), "ähnlich") for i in range(60)]
    + [(2000 + i, "w " * 9, "small") for i in range(10)]
    + [(3000 + i, "w w", None) for i in range(25)]
    + [(4000, "w " * 400, "long"), (4001, None, "long"), (4002, "", "empty"), (None, "w w w", "big")]
    + [(5000, "same text", "twin")] * 4
)


@pytest.fixture
def taken(make_docs, scratch):
    docs = make_docs(ROWS).withColumnRenamed("lang", "target").withColumnRenamed("n_chars", "_mark")
    return mixing.takes(mixing.queue(docs.repartition(4), scratch, block_rows=20)).collect()


def test_every_row_is_there_with_its_size(taken):
    assert len(taken) == len(ROWS)
    count = lambda t: len((t or "").split())
    assert sorted((r["doc_id"], r["size"]) for r in taken if r["doc_id"]) == sorted(
        (i, count(t)) for i, t, _ in ROWS if i
    )


def test_targets_and_takes(taken):
    sizes = {}
    for r in taken:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    expected = level_targets(sizes)
    got, longest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in taken:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert r["taken"] % max(1, r["size"]) == 0 and 0 <= r["taken"] <= 3 * r["size"]
        got[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    total = sum(sizes.values())
    assert 0 <= total - sum(got.values()) <= max(longest.values())
    for source in sizes:
        slack = longest[source] + max(longest.values()) * expected[source] / total
        assert abs(got[source] - expected[source]) <= slack + 1


def test_order_is_that_of_a_plain_queue(make_docs, scratch):
    rows = sorted(
        (r.asDict() for r in mixing.queue(make_docs(ROWS), scratch, block_rows=7).collect()),
        key=lambda r: r["until"],
    )
    finish = [r["finish"] for r in rows]
    total, budget = 0, sum(len((t or "").split()) for _, t, _ in ROWS)
    assert all(a <= b + 1e-12 for a, b in zip(finish, finish[1:]) )
    for r in (r for r in rows if r["size"]):
        total += r["size"]
        assert r["until"] == total and r["taken"] == (total <= budget)


def test_reruns_and_blocks_agree(make_docs, scratch, taken):
    again = mixing.takes(mixing.queue(make_docs(ROWS[::-1]), scratch)).collect()
    key = lambda r: (r["doc_id"] or 0, r["_copy"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, taken))


def test_mixed_rows(make_docs, scratch, taken):
    docs = make_docs(ROWS).withColumnRenamed("n_chars", "_times")
    mixed = mixing.mix(docs, scratch)
    assert mixed.columns == docs.columns
    times, expected = {}, {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    for r in taken:
        if r["taken"]:
            passes = r["taken"] // r["size"]
            expected[r["doc_id"]] = expected.get(r["doc_id"], 0) + passes
    assert times == expected


def test_empty_and_wordless_tables(make_docs, scratch):
    assert mixing.takes(mixing.queue(make_docs([]), scratch)).collect() == []
    rows = mixing.takes(mixing.queue(make_docs([(1, None), (2, " ")]), scratch)).collect()
    assert [(r["target"], r["taken"]) for r in rows] == [(0.0, 0), (0.0, 0)]


def test_one_row_is_a_third_of_the_table_and_comes_in_chunks(make_docs, scratch, monkeypatch):
    rows = [(i, f"word {i} " * (1 + i % 5), f"s{i % 3}") for i in range(40)]
    rows += [(99, "the same words again", "s1")] * 21
    whole = mixing.takes(mixing.queue(make_docs(rows), scratch)).collect()
    monkeypatch.setattr(mixing, "one_by_one", partial(copies.one_by_one, chunk=4))
    cut = mixing.takes(mixing.queue(make_docs(rows[::-1]), scratch)).collect()
    assert sorted(whole) == sorted(cut) and len(whole) == len(rows)
    total = sum(r["taken"] for r in whole)
    assert total <= sum(r["size"] for r in whole) <= total + 25
    mixed = mixing.mix(make_docs(rows), scratch)
    passes = sum(r["passes"] for r in whole)
    assert mixed.count() == passes

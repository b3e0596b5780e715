"""The divergence audit against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddrow.llm import divergence

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string"


def expected(rows, min_documents=3, top=200):
    """{(lang, source, part, item, value, rank)}."""
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = set()
    f = lambda p, q: (p - q) * (p - q) // q
    for lang, own in sources.items():
        kept = [t for t, n in docs[lang].items() if n >= min_documents]
        share = {}
        total = sum((counts[lang, s] for s in own), Counter())
        for name, c in [(None, total), *((s, counts[lang, s]) for s in own)]:
            n = sum(c[t] for t in kept)
            share[name] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        for s in own:
            pairs = [
                (-sum(f(share[s][t], share[o][t]) for t in kept), o.encode())
                for o in own
                if o != s
            ]
            terms = [
                (-f(share[s][t], share[None][t]), t.encode())
                for t in kept
                if counts[lang, s][t] and share[s][t] > share[None][t]
            ]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                for rank, (value, item) in enumerate(found, 1):
                    out.add((lang, s, part, item.decode(), -value, rank))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], DOCS)


def rows_of(found):
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture
def corpus():
    r = random.Random(2)
    rows = []
    for _ in range(160):
        lang, source = r.choice(["en", "en", "de", None]), r.choice(["a", "b", "ü", None])
        words = [f"w{chr(97 + min(25, int(r.expovariate(0.15))))}" for _ in range(r.randint(0, 60))]
        rows.append((" ".join(words).title() + " né, 3x", lang, source))
    rows += [(None, "en", "a"), ("", "en", "no terms"), ("only once", "xx", "a"), (None, "xx", "b")]
    return rows


def test_audit_equals_plain_python(spark, scratch, corpus):
    assert rows_of(divergence.audit(table(spark, corpus), scratch)) == expected(corpus)


def test_small_tables_of_cells_and_early_flushes(spark, scratch, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "TABLE", 40)
    monkeypatch.setattr(divergence, "HELD_TERMS", 20)
    found = divergence.audit(table(spark, corpus), scratch, top_terms=5)
    assert rows_of(found) == expected(corpus, top=5)


def test_many_terms_fill_several_containers(spark, scratch):
    r = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    terms = ["".join(r.choice(letters) for _ in range(4)) for _ in range(700)]
    rows = [
        (" ".join(r.choices(terms, k=200)) + " the" * r.randint(0, 400), "en", f"s{i % 7}")
        for i in range(90)
    ]
    assert rows_of(divergence.audit(table(spark, rows), scratch)) == expected(rows)


def test_one_source_holds_most_rows_and_rows_repeat(spark, scratch):
    rows = [("hot words again and again", "en", "hot")] * 300 + [("and some words", "en", "b")] * 4
    assert rows_of(divergence.audit(table(spark, rows), scratch)) == expected(rows)


def test_empty_table_and_clashing_columns(spark, scratch, corpus):
    docs = table(spark, corpus)
    assert divergence.audit(docs.limit(0), scratch).collect() == []
    names = ("term", "n", "total", "levels", "number", "value", "item", "words", "id", "p", "rank")
    odd = docs.withColumns({n: F.lit("x") for n in names})
    assert rows_of(divergence.audit(odd, scratch)) == expected(corpus)


def test_very_long_text(spark, scratch, prose):
    rows = [(prose(40_000, 1), "en", "a")] + [(prose(300, 1 + i % 3), "en", "bc"[i % 2]) for i in range(9)]
    assert rows_of(divergence.audit(table(spark, rows), scratch)) == expected(rows)


def test_shares_of_large_counts_are_exact(spark):
    counts = [0, 1, 10**6, 5 * 10**11, 9 * 10**14, 3]
    totals = [1, 7, 10**6 + 1, 10**12 + 3, 9 * 10**14 + 1, 4]
    wanted = [1 + 10**9 * (c + 1) // t for c, t in zip(counts, totals)]
    assert divergence.shares(np.array(counts), np.array(totals)).tolist() == wanted
    rows = spark.createDataFrame(list(zip(counts, totals)), "c long, t long")
    made = divergence.share(F.col("c"), F.col("t") - 1, F.lit(1).cast("long"))
    assert [r[0] for r in rows.select(made).collect()] == wanted

"""Rows of the pipeline's stages against plain Python over what the quality stage kept."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_mixing import level_targets
from test_ngram_join import brute_force

import corpus_pipeline
from oddrow.llm import bpe, mixing

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="needs the generated tables")


def plain_mix(rows):
    """How often each (doc_id, text, source, mark) is taken, by one sorted queue."""
    sizes, queued = defaultdict(int), []
    for row in rows:
        sizes[row[2]] += len(row[1].split())
    target = level_targets(sizes)
    for source in sizes:
        total = 0
        for row in sorted((r for r in rows if r[2] == source), key=lambda r: (r[3], r[0])):
            total += (size := len(row[1].split()))
            queued += [((total + k * sizes[source]) / target[source], row[3], k, size, row) for k in range(3)]
    taken, until = Counter(), 0
    for _, _, _, size, row in sorted(queued, key=lambda q: q[:3]):
        until += size
        if until <= sum(sizes.values()) and size:
            taken[row[0]] += 1
    return taken


def test_rows_after_every_stage(spark, scratch):
    stages, kept = dict(corpus_pipeline.STAGES), {}
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    for name in ("quality_pu", "exact_dedup", "ngram_join", "mixing"):
        docs = scratch.keep(stages[name](spark, docs, str(TABLES)), name)
        mark = F.xxhash64(F.lit(mixing.SEED), "doc_id", "source", "text")
        kept[name] = [tuple(r) for r in docs.select("doc_id", "text", "source", mark).collect()]
    # One of each text, the one of the largest id.
    last = {}
    for row in sorted(kept["quality_pu"]):
        last[row[1]] = row
    assert sorted(kept["exact_dedup"]) == sorted(last.values())
    # One of each component, the one of the smallest id.
    groups = brute_force([r[:2] for r in last.values()])
    firsts = {doc_id for doc_id, _, least in groups if doc_id == least}
    left = [r for r in last.values() if r[0] in firsts]
    assert sorted(kept["ngram_join"]) == sorted(left)
    taken = plain_mix(left)
    mixed = [r for r in left for _ in range(taken[r[0]])]
    assert sorted(kept["mixing"]) == sorted(mixed)
    # Digests of ids by the rank library and of the texts themselves.
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.codec(path).ranks, special_tokens={}
    )
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for doc_id, text, _, _ in mixed:
        ids = library.encode_ordinary(text)
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(text.encode())))
    coded = stages["bpe"](spark, docs, str(TABLES)).collect()
    assert sorted(map(tuple, coded)) == sorted(expected)

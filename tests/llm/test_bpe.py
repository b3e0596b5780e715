"""The BPE codec against the rank library, and its edges."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from oddrow.llm import bpe, chunks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = " \n\t\r\x0b\x0c\x1c\x85\xa0 　ab1'stéñ.,!#日本😀́<|>"


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(PATH)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def odd_texts(n):
    r = random.Random(3)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_same_ids_as_the_rank_library(codec, library, prose):
    texts = odd_texts(5_000) + [prose(500, s) for s in range(10)]
    texts += ["", " ", "  ", "x" * 50_000, " " * 5_000, "don't we'll I'VE", "<|endoftext|>"]
    assert [ids.tolist() for ids in codec.encode(texts)] == [
        library.encode_ordinary(t) for t in texts
    ]


def test_every_character(codec, library):
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(0, 0x3000, 3)]
    assert [ids.tolist() for ids in codec.encode(texts)] == [
        library.encode_ordinary(t) for t in texts
    ]


def test_decoding_is_the_inverse(codec):
    texts = odd_texts(500)
    assert [codec.decode(ids.tolist()).decode() for ids in codec.encode(texts)] == texts
    with pytest.raises(KeyError):
        codec.decode([10**9])


def test_memory_of_few_entries_changes_nothing(codec, library, monkeypatch):
    small = bpe.Codec(codec.ranks)
    small._chunks._chunks.entries = small._chunks._pieces.entries = 20
    texts = odd_texts(300)
    for at in range(0, 300, 7):
        few = texts[at : at + 7]
        assert [i.tolist() for i in small.encode(few)] == [library.encode_ordinary(t) for t in few]


def test_chunks_join_to_the_text():
    for text in odd_texts(500):
        assert " ".join(chunks.cut(text)) == text


def test_a_vocabulary_without_all_bytes_is_refused():
    part = bpe.Codec({b"a": 0, b"b": 1, b"ab": 2})
    assert part.encode(["abab"])[0].tolist() == [2, 2]
    with pytest.raises(ValueError, match="every byte"):
        part.encode(["xy"])


def test_round_trip_of_a_table(make_docs, library):
    rows = [(1, "Hello world"), (1, "Hello world"), (2, None), (3, ""), (None, "é\n\n x")]
    docs = make_docs(rows).withColumnRenamed("lang", "ids").withColumnRenamed("source", "n_tokens")
    got = sorted(map(tuple, bpe.round_trip(docs, PATH).collect()), key=repr)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        listed = ",".join(map(str, ids)).encode()
        expected.append((doc_id, len(ids), sha(listed), sha((text or "").encode())))
    assert got == sorted(expected, key=repr)
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(make_docs(rows[:1]), PATH).collect()}
    assert ids == {1: library.encode_ordinary("Hello world")}


def test_empty_table(make_docs):
    assert bpe.round_trip(make_docs([]), PATH).collect() == []

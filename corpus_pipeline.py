"""Corpus pipeline: quality, exact and near duplicates, mixing, encoding.

Every stage takes what its predecessor kept. The first four return rows of ``documents`` with its
columns; the last returns the digests of the encoded texts. A document that the mix takes twice
is there twice.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from oddrow.llm import bpe, cuckoo, mixing, ngram_join, quality_pu
from oddrow.llm.common import remainder, table
from oddrow.sources.storage import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more; labels of one id in three are never read."""
    labels = table(spark, sf_dir, "labels")
    model = quality_pu.train(docs, labels, remainder("doc_id", 3) != 1)
    return quality_pu.keep_good(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return cuckoo.drop_copies(docs, Scratch(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts."""
    return ngram_join.keep_one_of_each(docs, Scratch(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of the sources takes, as often as it takes them."""
    return mixing.mix(docs, Scratch(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every text."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_pu", quality),
    ("exact_dedup", exact_dedup),
    ("ngram_join", near_dedup),
    ("mixing", mix),
    ("bpe", encode),
]
#: SQL can express neither the trained classifier nor the encoding.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return docs

"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Every sentence gets a probability from the words and word
beginnings in it, and the document's probability is their noisy-or: one offending sentence is
enough. The sentence model is trained from document labels alone, through the noisy-or, and then
says which sentences offend.

The model is fitted on a bounded sample of labelled rows (``MAX_TOXIC``, ``MAX_CLEAN`` different ones,
by hashes of id and text) and holds at most ``MAX_FEATURES`` features, those that best tell the sample's
labels apart; counts are taken, and all documents scored, in Spark tasks.

Defined cases: null and empty texts have no sentence and score 0; a document with any label 1 is
toxic; null labels and ids are left out of training; without documents of both labels every score
is 0; ties and repeated rows get equal scores; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import ids_and_texts, map_batches
from oddrow.llm.samples import sample_ids, sample_texts
from oddrow.sources.storage import Scratch

MAX_TOXIC = 2_000
MAX_CLEAN = 4_000
MAX_FEATURES = 4_096
MIN_DOCUMENTS = 3
BEGINNINGS = (3, 4, 5)
STEPS = 400
RATE = 0.1
PENALTY = 2e-4
START_BIAS = -6.0
WORDS_REMEMBERED = 200_000

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
_WORD = re.compile(r"\w+")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Spans of the sentences with a word."""
    if not text:
        return []
    return [m.span() for m in _SENTENCE.finditer(text) if _WORD.search(m.group())]


def features_of(word: str) -> list[str]:
    """A lower-case word and its beginnings; a mark tells whole words from beginnings."""
    return [f"={word}"] + [f"^{word[:n]}" for n in BEGINNINGS if len(word) > n]


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float


class Scorer:
    """Applies a model, remembering the weight of words."""

    def __init__(self, model: Model) -> None:
        self._model = model
        self._known: dict[str, float] = {}

    def _weight(self, word: str) -> float:
        known = self._known.get(word)
        if known is None:
            if len(self._known) >= WORDS_REMEMBERED:
                self._known.clear()
            weights = self._model.weights
            known = sum(weights.get(f, 0.0) for f in features_of(word))
            self._known[word] = known
        return known

    def sentences(self, text: str | None) -> list[tuple[int, int, float]]:
        """(start, end, probability) of each sentence."""
        if not self._model.weights:
            return []
        found = []
        for start, end in sentences(text):
            words = set(_WORD.findall(text[start:end].lower()))
            margin = self._model.bias + sum(map(self._weight, sorted(words)))
            found.append((start, end, 1 / (1 + float(np.exp(-max(-60.0, min(60.0, margin)))))))
        return found

    def document(self, text: str | None) -> float:
        """Noisy-or of the sentences."""
        return noisy_or(p for _, _, p in self.sentences(text))


def noisy_or(probabilities: Iterable[float]) -> float:
    clean = 0.0
    for p in probabilities:
        clean += np.log1p(-min(p, 1 - 1e-12))
    return float(-np.expm1(clean))


def offending(
    found: list[tuple[int, int, float]], score: float, threshold: float
) -> list[tuple[int, int, float]]:
    """The sentences that reach the threshold, or the likeliest of a document that reaches it."""
    least = threshold
    if found and score >= threshold:
        least = min(threshold, max(p for _, _, p in found))
    return [one for one in found if one[2] >= least]


# ------------------------------------------------------------------------- training


def _bag_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, toxic, n): documents of a batch that have the feature."""
    for batch in batches:
        counts: dict[tuple[str, int], int] = {}
        labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for label, text in zip(labels, texts):
            words = set(_WORD.findall((text or "").lower()))
            for feature in {f for w in words for f in features_of(w)}:
                counts[feature, label] = counts.get((feature, label), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([f for f, _ in counts], pa.string()),
                pa.array([label for _, label in counts], pa.int32()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["feature", "toxic", "n"],
        )


def _telling(chosen: DataFrame, toxic: int, clean: int) -> list[str]:
    """The features whose share among toxic documents differs most from that among clean ones."""
    counts = map_batches(
        chosen.select("toxic", "text"), _bag_features, "feature string, toxic int, n long"
    )
    both = counts.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    share = (F.col("a") + F.col("c")) / float(toxic + clean)
    gap = F.col("a") / float(toxic) - F.col("c") / float(clean)
    strength = gap * gap / (share * (1.001 - share))
    best = (
        both.filter(F.col("a") + F.col("c") >= MIN_DOCUMENTS)
        # Every partition sends its best; the sample is bounded, so a few partitions will do.
        .coalesce(8)
        .orderBy(strength.desc(), "feature")
        .limit(MAX_FEATURES)
    )
    return [r["feature"] for r in best.select("feature").collect()]


def _bags(places: dict[str, int]):
    """(toxic, sizes, items): per document the feature numbers of its sentences, end to end."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, items = [], []
            for text in batch.column(1).to_pylist():
                own_sizes, own_items = [], []
                for start, end in sentences(text):
                    words = set(_WORD.findall(text[start:end].lower()))
                    held = [places[f] for w in words for f in features_of(w) if f in places]
                    own_sizes.append(len(held))
                    own_items += sorted(held)
                sizes.append(own_sizes)
                items.append(own_items)
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, kind), pa.array(items, kind)],
                names=["toxic", "sizes", "items"],
            )

    return run


class Bags:
    """Feature numbers of the sentences of labelled documents, and the loss over them."""

    def __init__(self, labels: np.ndarray, sizes: list[list[int]], items: list[list[int]]):
        self.labels = labels
        self.bag_of = np.repeat(np.arange(len(labels)), [len(s) for s in sizes])
        per_sentence = np.concatenate([np.asarray(s, np.int64) for s in sizes])
        self.n_sentences = len(per_sentence)
        self.sentence_of = np.repeat(np.arange(self.n_sentences), per_sentence)
        self.flat = np.concatenate([np.asarray(i, np.int64) for i in items])
        # Both labels weigh the same.
        share = labels.mean()
        self.of_bag = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)

    def loss(self, weights: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
        """Log loss of the noisy-or with the penalty, and its gradient by weights and bias."""
        labels, n = self.labels, len(self.labels)
        margin = bias + np.bincount(self.sentence_of, weights[self.flat], self.n_sentences)
        p = 1 / (1 + np.exp(-np.clip(margin, -40, 40)))
        clean = np.bincount(self.bag_of, np.log1p(-np.minimum(p, 1 - 1e-12)), n)
        toxic = np.maximum(-np.expm1(clean), 1e-12)
        value = -(self.of_bag * np.where(labels == 1, np.log(toxic), clean)).sum()
        # d loss / d margin: p for clean bags, -p (1 - P) / P for toxic ones.
        slope = np.where(labels == 1, -np.exp(clean) / toxic, 1.0) * self.of_bag
        d_margin = slope[self.bag_of] * p
        g = np.empty(len(weights) + 1)
        g[:-1] = np.bincount(self.flat, d_margin[self.sentence_of], len(weights))
        g[:-1] += PENALTY * weights
        g[-1] = d_margin.sum()
        return float(value + PENALTY / 2 * (weights**2).sum()), g


def fit(labels: np.ndarray, sizes: list[list[int]], items: list[list[int]], width: int):
    """(weights, bias) that minimise the log loss of the noisy-or, by Adam over all bags."""
    bags = Bags(labels, sizes, items)
    weights, bias = np.zeros(width), START_BIAS
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        _, g = bags.loss(weights, bias)
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weights -= move[:width]
        bias -= move[width]
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Fit on the documents that ``allowed``, an expression over doc_id, lets through."""
    of_doc = (
        labels.filter(F.col("toxic").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = [
        sample_ids(of_doc.filter(F.col("toxic") == label), most).withColumn("role", F.lit(label))
        for label, most in ((1, MAX_TOXIC), (0, MAX_CLEAN))
    ]
    wanted = picked[0].union(picked[1])
    scratch = Scratch(docs.sparkSession)
    limits = {1: MAX_TOXIC, 0: MAX_CLEAN}
    chosen = sample_texts(docs, wanted, limits, scratch).withColumnRenamed("role", "toxic")
    by_label = chosen.groupBy("toxic").agg(F.count("*").alias("n"))
    found = {r["toxic"]: r["n"] for r in by_label.collect()}
    if not found.get(0) or not found.get(1):
        scratch.drop()
        return Model({}, START_BIAS)
    names = _telling(chosen, found[1], found[0])
    places = {name: i for i, name in enumerate(names)}
    rows = map_batches(
        chosen.select("toxic", "text"), _bags(places),
        "toxic int, sizes array<int>, items array<int>",
    ).toArrow().to_pylist()
    scratch.drop()
    rows.sort(key=lambda r: (r["toxic"], r["sizes"], r["items"]))
    weights, bias = fit(
        np.array([r["toxic"] for r in rows]),
        [r["sizes"] for r in rows],
        [r["items"] for r in rows],
        len(names),
    )
    return Model({n: float(w) for n, w in zip(names, weights) if w}, bias)


# ------------------------------------------------------------------------- scoring


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.document(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return map_batches(ids_and_texts(docs), run, "doc_id long, score double")


def score_and_locate(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, offending) of every whole text; ``offending`` holds the spans that
    :func:`locate` gives, as (start, end, probability)."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1).to_pylist():
                found = scorer.sentences(text)
                scores.append(noisy_or(p for _, _, p in found))
                spans.append([
                    {"start": s, "end": e, "probability": p}
                    for s, e, p in offending(found, scores[-1], threshold)
                ])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(scores, pa.float64()),
                    pa.array(spans, pa.list_(span)),
                ],
                names=["doc_id", "score", "offending"],
            )

    schema = (
        "doc_id long, score double, "
        "offending array<struct<start: int, end: int, probability: double>>"
    )
    return map_batches(ids_and_texts(docs), run, schema)


def locate(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, start, end, sentence, probability) of the offending sentences.

    These reach the threshold themselves, or are the likeliest of a document that reaches it.
    """
    names = ["doc_id", "start", "end", "sentence", "probability"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = scorer.sentences(text)
                likely = offending(found, noisy_or(p for _, _, p in found), threshold)
                rows += [(doc_id, s, e, text[s:e], p) for s, e, p in likely]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64())
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    schema = "doc_id long, start int, end int, sentence string, probability double"
    return map_batches(ids_and_texts(docs), run, schema)

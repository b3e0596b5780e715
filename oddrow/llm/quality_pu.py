"""Quality classifier by positive-unlabelled learning.

Trusted positives are the documents labelled 1; documents at large are the unlabelled text. A
small network over writing features minimises the non-negative unbiased risk: positives' risk
times the class prior, plus the unlabelled text's risk as negatives less the positives' share of
it; where that second part falls below zero, its gradient is turned round. The class prior is
estimated as the share of 1 among labelled rows.

The model is fitted on a bounded sample (``MAX_POSITIVES``, ``MAX_UNLABELLED`` different rows, chosen
by hashes of id and text) in the driver; features are made, and all documents scored, in Spark tasks.

Defined cases: null texts count as empty and get the score of an empty text; a document whose
labels disagree is not trusted; null labels and ids are left out of training; without trusted
positives, or without text, all scores are the prior (0.5 if that is unknown); ties and repeated
rows get equal scores; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import ids_and_texts, map_batches
from oddrow.llm.samples import sample_ids, sample_texts
from oddrow.llm.text_features import NAMES, describe
from oddrow.sources.storage import Scratch

MAX_POSITIVES = 6_000
MAX_UNLABELLED = 12_000
HIDDEN = 24
STEPS = 1_500
BATCH = 512
RATE = 0.01
DECAY = 1e-4
SEED = 11


class Model(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    shift: float

    def margin(self, features: np.ndarray) -> np.ndarray:
        scaled = np.clip((features - self.centre) / self.scale, -6, 6)
        return np.tanh(scaled @ self.first + self.bias) @ self.second + self.shift

    def score(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(features).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def constant_model(prior: float | None) -> Model:
    level = min(max(0.5 if prior is None else prior, 1e-6), 1 - 1e-6)
    width = len(NAMES)
    return Model(
        np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1),
        float(np.log(level / (1 - level))),
    )


def risk(
    weights: list[np.ndarray], positives: np.ndarray, unlabelled: np.ndarray, prior: float
) -> tuple[float, list[np.ndarray]]:
    """What is minimised in one step, and its gradient.

    With the loss ``1 - out`` of calling a text positive and ``out`` of calling it negative that is
    the unbiased risk; where its negative part is below zero, that part alone, turned round.
    """
    x = np.concatenate([positives, unlabelled])
    n, m = len(positives), len(unlabelled)
    hidden = np.tanh(x @ weights[0] + weights[1])
    out = _sigmoid(hidden @ weights[2] + weights[3])
    on_positives, on_unlabelled = out[:n].mean(), out[n:].mean()
    negative_part = on_unlabelled - prior * on_positives
    d_out = np.empty(n + m)
    if negative_part >= 0:
        value = prior * (1 - on_positives) + negative_part
        d_out[:n] = -2 * prior / n
        d_out[n:] = 1 / m
    else:
        value = -negative_part
        d_out[:n] = prior / n
        d_out[n:] = -1 / m
    value += DECAY / 2 * ((weights[0] ** 2).sum() + (weights[2] ** 2).sum())
    d_margin = d_out * out * (1 - out)
    d_hidden = d_margin[:, None] * weights[2] * (1 - hidden**2)
    return float(value), [
        x.T @ d_hidden + DECAY * weights[0],
        d_hidden.sum(0),
        hidden.T @ d_margin + DECAY * weights[2],
        np.array([d_margin.sum()]),
    ]


def fit(positives: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> Model:
    """Minimise the non-negative risk with the sigmoid loss by Adam."""
    if not len(positives) or not len(unlabelled) or prior is None:
        return constant_model(prior)
    random = np.random.default_rng(SEED)
    everything = np.concatenate([positives, unlabelled])
    centre, scale = everything.mean(0), everything.std(0) + 1e-3
    positives, unlabelled = (
        np.clip((x - centre) / scale, -6, 6) for x in (positives, unlabelled)
    )
    width = positives.shape[1]
    weights = [
        random.normal(0, width**-0.5, (width, HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
    for step in range(1, STEPS + 1):
        p = positives[random.integers(len(positives), size=BATCH)]
        u = unlabelled[random.integers(len(unlabelled), size=BATCH)]
        _, gradients = risk(weights, p, u, prior)
        for w, g, (m, v) in zip(weights, gradients, moments):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(centre, scale, weights[0], weights[1], weights[2], float(weights[3][0]))


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [describe(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(made, pa.list_(pa.float32()))], names=["role", "features"]
        )


def train(docs: DataFrame, labels: DataFrame, allowed: Column) -> Model:
    """Fit on the documents that ``allowed``, an expression over doc_id, lets through."""
    of_doc = (
        labels.filter(F.col("quality").isNotNull() & allowed)
        .groupBy("doc_id")
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    )
    prior = of_doc.agg(F.avg((F.col("low") + F.col("high")) / 2).alias("p")).first()["p"]
    trusted = sample_ids(of_doc.filter("low = 1 AND high = 1"), MAX_POSITIVES)
    at_large = sample_ids(docs.select("doc_id").filter(allowed), MAX_UNLABELLED)
    wanted = trusted.withColumn("role", F.lit(1)).union(at_large.withColumn("role", F.lit(0)))
    scratch = Scratch(docs.sparkSession)
    chosen = sample_texts(docs, wanted, {1: MAX_POSITIVES, 0: MAX_UNLABELLED}, scratch)
    rows = map_batches(
        chosen.select("role", "text"), _features, "role int, features array<float>"
    ).toArrow()
    scratch.drop()
    roles = rows.column("role").to_numpy()
    flat = rows.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    made = flat.reshape(len(roles), len(NAMES)).astype(np.float64)
    # Rows arrive in no order, and training must not depend on one.
    order = np.lexsort((*made.T, roles))
    made, roles = made[order], roles[order]
    return fit(made[roles == 1], made[roles == 0], prior)


def _scores(batch: pa.RecordBatch, model: Model) -> np.ndarray:
    texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
    made = np.array([describe(t) for t in texts], np.float64)
    return model.score(made.reshape(-1, len(NAMES)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): higher where label 1 is likelier."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_scores(batch, model))], names=["doc_id", "score"]
            )

    return map_batches(ids_and_texts(docs), run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_scores(batch, model) >= threshold))

    return map_batches(docs, run, docs.schema)

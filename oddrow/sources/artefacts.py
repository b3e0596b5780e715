"""Run folders and the artefacts in them, as small tables and one-row JSON."""

from __future__ import annotations

import json
import uuid
from dataclasses import replace
from datetime import datetime
from typing import Any

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddrow.errors import ArtifactLoadError, ArtifactNotFoundError, InferenceError
from oddrow.operators.autoencoder import HISTORY_SCHEMA, Autoencoder, EarlyStop, Epoch
from oddrow.operators.features import ColumnScale, Preprocessor
from oddrow.operators.network import Layout, TrainState
from oddrow.operators.threshold import Threshold
from oddrow.sources.storage import exists, finished, make_folder
from oddrow.sources.tables import write_table

WEIGHTS, SCALER, ENCODER, THRESHOLD = "weights", "scaler", "encoder", "threshold.json"
METRICS, PARAMS, HISTORY, SCORES = "metrics.json", "params.json", "history", "scores"
CONFUSION, ROC, HISTOGRAM = "confusion_matrix", "roc_curve", "re_histogram"
PROGRESS, MANIFEST = "progress", "manifest.json"
CRITICAL = (WEIGHTS, SCALER, ENCODER, THRESHOLD)

THRESHOLD_KEYS = ("threshold", "percentile", "mse_mean", "mse_std")


# -- run folders -----------------------------------------------------------------------


def new_run(spark: SparkSession, base: str) -> str:
    """A fresh folder ``YYYYMMDD_HHMMSS_xxxxxx``; the suffix keeps runs of one second apart."""
    name = f"{datetime.now():%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"
    run = f"{base.rstrip('/')}/{name}"
    make_folder(spark, run)
    return run


def latest_run(spark: SparkSession, base: str) -> str:
    """The newest run, by name, that came to its end."""
    base = base.rstrip("/")
    runs = finished(spark, base, MANIFEST)
    if not runs:
        raise ArtifactNotFoundError(f"'{base}' holds no finished run")
    return f"{base}/{runs[-1]}"


def finish_run(spark: SparkSession, run: str) -> None:
    """Write the manifest, which makes a run count; all critical artefacts must be there."""
    check_artefacts(spark, run)
    write_record(spark, f"{run}/{MANIFEST}", {"artefacts": list(CRITICAL)})


def check_artefacts(spark: SparkSession, run: str, names: tuple[str, ...] = CRITICAL) -> None:
    """All of the artefacts or an error that lists exactly the missing ones."""
    missing = [n for n in names if not exists(spark, f"{run}/{n}")]
    if missing:
        raise ArtifactNotFoundError(
            f"missing artefacts in '{run}': {missing}; nothing was loaded"
        )


# -- one-row JSON ----------------------------------------------------------------------


def write_record(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """One JSON object, whatever its nesting, as one line of text."""
    line = spark.createDataFrame([(json.dumps(record),)], "value string")
    write_table(line.coalesce(1), path, "text")


def read_record(spark: SparkSession, path: str, what: str) -> dict[str, Any]:
    """One JSON object from a file or a folder that Spark wrote."""
    if not exists(spark, path):
        raise ArtifactLoadError(f"{what} not found: '{path}'")
    try:
        texts = [r.value for r in spark.read.text(path, wholetext=True).collect()]
        data = json.loads("".join(texts))
    except json.JSONDecodeError as exc:
        raise ArtifactLoadError(f"{what} '{path}' contains invalid JSON: {exc}") from exc
    except (PySparkException, Py4JJavaError) as exc:
        raise ArtifactLoadError(f"{what} '{path}' cannot be read: {type(exc).__name__}") from exc
    if not isinstance(data, dict):
        raise ArtifactLoadError(
            f"{what} '{path}' must hold one JSON object, not a {type(data).__name__}"
        )
    return data


def save_threshold(spark: SparkSession, run: str, found: Threshold) -> None:
    if found is None or found.threshold is None:
        raise InferenceError("threshold not yet computed or loaded")
    record = {key: getattr(found, key) for key in THRESHOLD_KEYS}
    write_record(spark, f"{run}/{THRESHOLD}", record)


def load_threshold(spark: SparkSession, run: str) -> Threshold:
    """The stored threshold; one error names every field that gives no number."""
    path = f"{run}/{THRESHOLD}"
    read_record(spark, path, "threshold artefact")  # one well-formed object, or its error
    schema = ", ".join(f"{key} string" for key in THRESHOLD_KEYS)
    cells = spark.read.schema(schema).option("multiLine", True).json(path)
    numbers = [F.col(key).try_cast("double").alias(key) for key in THRESHOLD_KEYS]
    found = cells.select(*numbers).first().asDict()
    unusable = [k for k, v in found.items() if v is None]
    if unusable:
        raise ArtifactLoadError(f"'{path}' gives no number for {', '.join(unusable)}")
    share = found["percentile"]
    return Threshold(**found | {"percentile": int(share) if share.is_integer() else share})


def record_timing(spark: SparkSession, run: str, seconds: float) -> None:
    """Add the rounded training time to the metrics of a run; nothing without metrics."""
    path = f"{run}/{METRICS}"
    if exists(spark, path):
        metrics = read_record(spark, path, "metrics")
        write_record(spark, path, metrics | {"training_time_secs": round(seconds, 2)})


# -- progress of training ----------------------------------------------------------------


def keep_epoch(spark: SparkSession, run: str, done: Epoch) -> None:
    """Add a finished epoch with its state to a run; the row appears whole or not at all."""
    state = done.state
    row = (*done.line, state.steps, state.seen, bytearray(state.pack()))
    schema = f"{HISTORY_SCHEMA}, steps long, seen long, state binary"
    table = spark.createDataFrame([row], schema).coalesce(1)
    write_table(table, f"{run}/{PROGRESS}/{done.epoch:06d}")


def progress(spark: SparkSession, run: str) -> DataFrame:
    """The epochs finished so far, also while the run is still training or after it has died."""
    found = finished(spark, f"{run}/{PROGRESS}", "")
    schema = f"{HISTORY_SCHEMA}, steps long, seen long, state binary"
    if not found:
        return spark.createDataFrame([], schema)
    paths = [f"{run}/{PROGRESS}/{name}" for name in found]
    return spark.read.schema(schema).parquet(*paths)


def load_progress(
    spark: SparkSession, run: str, layout: Layout, patience: int
) -> list[Epoch]:
    """The finished epochs in order; the last and the best one with their states."""
    table = progress(spark, run)
    lines = sorted(map(tuple, table.drop("steps", "seen", "state").collect()))
    stop = EarlyStop(patience)
    done = [Epoch(*line) for line in lines]
    for epoch in done:
        stop.ends_with(epoch)
    if not done:
        return []
    wanted = [done[-1].epoch, stop.best.epoch]
    rows = table.filter(F.col("epoch").isin(*wanted)).select("epoch", "steps", "seen", "state")
    states = {
        r["epoch"]: TrainState.unpack(
            layout, np.frombuffer(r["state"], layout.dtype), r["steps"], r["seen"]
        )
        for r in rows.collect()
    }
    return [replace(e, state=states.get(e.epoch)) for e in done]


# -- fitted state ----------------------------------------------------------------------


def _rows(spark: SparkSession, path: str, order: list[str]) -> list:
    try:
        return spark.read.parquet(path).orderBy(*order).collect()
    except (PySparkException, Py4JJavaError) as exc:
        raise ArtifactLoadError(f"artefact '{path}' cannot be read: {type(exc).__name__}") from exc


def save_preprocessor(spark: SparkSession, run: str, fitted: Preprocessor | None) -> None:
    """Two tables: categories with their places, and means with deviations."""
    if fitted is None:
        raise InferenceError("no fitted preprocessor to save; fit one first")
    categories = [
        (c, i, place, value)
        for i, (c, values) in enumerate(fitted.categories)
        for place, value in enumerate(values)
    ]
    encoder = spark.createDataFrame(
        categories, "column string, block int, place int, category string"
    )
    scaler = spark.createDataFrame(
        [(s.column, i, s.mean, s.std, s.scale) for i, s in enumerate(fitted.scales)],
        "column string, place int, mean double, std double, scale double",
    )
    write_table(encoder.coalesce(1), f"{run}/{ENCODER}")
    write_table(scaler.coalesce(1), f"{run}/{SCALER}")


def load_preprocessor(spark: SparkSession, run: str) -> Preprocessor:
    check_artefacts(spark, run, (ENCODER, SCALER))
    blocks: dict[str, list[str | None]] = {}
    for row in _rows(spark, f"{run}/{ENCODER}", ["block", "place"]):
        blocks.setdefault(row["column"], []).append(row["category"])
    scales = _rows(spark, f"{run}/{SCALER}", ["place"])
    return Preprocessor(
        tuple((c, tuple(values)) for c, values in blocks.items()),
        tuple(ColumnScale(r["column"], r["mean"], r["std"]) for r in scales),
    )


def weight_table(spark: SparkSession, model: Autoencoder) -> DataFrame:
    """One row per parameter; the layout travels with every row."""
    parts = model.layout.views(model.vector)
    rows = [
        (i, layer, name, list(shape), learned, parts[layer, name].ravel().astype(float).tolist())
        for i, (layer, name, shape, learned) in enumerate(model.layout.parameters)
    ]
    layout = model.layout.to_json()
    return spark.createDataFrame(
        [(*row, layout) for row in rows],
        "place int, layer string, parameter string, shape array<int>, trainable boolean, "
        "values array<double>, layout string",
    )


def save_weights(spark: SparkSession, path: str, model: Autoencoder | None) -> None:
    if model is None:
        raise InferenceError("no model to save; build or train one first")
    write_table(weight_table(spark, model).coalesce(1), path)


def load_weights(spark: SparkSession, path: str, expected: Layout | None = None) -> Autoencoder:
    """The stored model; with ``expected`` its parameters must fit that layout."""
    if not exists(spark, path):
        raise ArtifactNotFoundError(f"model weights not found: '{path}'")
    rows = _rows(spark, path, ["place"])
    if not rows:
        raise ArtifactLoadError(f"model weights '{path}' are empty")
    stored = Layout.from_json(rows[0]["layout"])
    layout = expected or stored
    found = [(r["layer"], r["parameter"], tuple(r["shape"])) for r in rows]
    wanted = [(layer, name, shape) for layer, name, shape, _ in layout.parameters]
    if found != wanted:
        raise InferenceError(
            f"model weights '{path}' do not fit the model: stored input width "
            f"{stored.input_dim}, expected {layout.input_dim}"
        )
    vector = np.concatenate([np.asarray(r["values"], layout.dtype) for r in rows])
    return Autoencoder(layout, vector)

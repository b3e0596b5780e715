"""The jobs of the engine: train, score, evaluate, report, prepare."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddrow.errors import ArtifactNotFoundError, DataLoadError, InferenceError
from oddrow.functions.labels import binary_label, is_normal
from oddrow.functions.scores import anomaly_flag
from oddrow.operators import metrics as M
from oddrow.operators.autoencoder import (
    TrainingResult,
    layout_for,
    make_shards,
    train_autoencoder,
)
from oddrow.operators.dedup import COPIES, dedup, dedup_stored
from oddrow.operators.features import Preprocessor, fit_preprocessor
from oddrow.operators.quality import Quality
from oddrow.operators.selection import (
    ATTACK,
    RANK,
    SPLIT,
    TRAIN,
    Split,
    rank_of,
    rank_place,
    sample_rows,
    split_normal,
)
from oddrow.operators.threshold import fit_threshold
from oddrow.params import JobParams
from oddrow.plans.session import compiled, compiled_methods
from oddrow.profiles import NSL_KDD, NSL_KDD_RAW_HEADER, Profile, get_profile
from oddrow.sources import artefacts
from oddrow.sources.storage import Scratch, exists
from oddrow.sources.tables import (
    BAD_CELLS,
    load_table,
    project,
    read_headerless_csv,
    write_table,
)


@dataclass(frozen=True)
class Prepared:
    """Validated rows with their split, and the state fitted on the training part."""

    rows: DataFrame
    split: Split
    preprocessor: Preprocessor
    quality: Quality

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col(SPLIT) == TRAIN)

    @property
    def normal(self) -> DataFrame:
        return self.rows.filter(F.col(SPLIT) != ATTACK)


def clean(rows: DataFrame, profile: Profile, scratch: Scratch, seed: int) -> DataFrame:
    """Duplicates removed over the required columns, and rows ranked for the split; written
    once for all later passes."""
    rank = {RANK: rank_of(seed, profile.key, profile.required)}
    with compiled_methods(rows.sparkSession):
        return dedup_stored(rows, profile.required, profile.key, scratch, rank)


def preprocess(
    cleaned: DataFrame, profile: Profile, params: JobParams, source: str
) -> Prepared:
    """Check values, split the normal rows, fit on the training part."""
    with compiled_methods(cleaned.sparkSession):
        return _preprocess(cleaned, profile, params, source)


def _preprocess(cleaned: DataFrame, profile: Profile, params: JobParams, source: str) -> Prepared:
    quality = Quality.of(cleaned, profile)
    quality.check_values(source)
    rows = cleaned.drop(COPIES, BAD_CELLS)
    ratios = params.splits
    split = split_normal(rows, is_normal(profile), ratios.train_fraction, ratios.random_seed)
    limit = params.architecture.max_categories
    fitted = fit_preprocessor(split.rows.filter(F.col(SPLIT) == TRAIN), profile, limit)
    return Prepared(split.rows, split, fitted, quality)


def fit_model(
    prepared: Prepared,
    params: JobParams,
    run: str | None = None,
) -> TrainingResult:
    """Train the autoencoder on the normal rows.

    With a run folder every finished epoch is kept there, and epochs that it already holds are
    not trained again.
    """
    spark, training = prepared.rows.sparkSession, params.training
    layout = layout_for(params.architecture, prepared.preprocessor.width, training.precision)
    element = "float" if training.precision == "float32" else "double"
    encoded = prepared.preprocessor.transform(prepared.normal, element)
    place = rank_place() if training.deal_by == "rank" else None
    done = artefacts.load_progress(spark, run, layout, training.patience) if run else []
    scratch = Scratch(spark)
    try:
        with compiled_methods(spark):
            shards = make_shards(
                encoded, F.col(SPLIT) == TRAIN, [RANK], training.shards, training.random_seed,
                scratch, training.precision, training.round_rows, place, training.batch_size,
            )
        keep = partial(artefacts.keep_epoch, spark, run) if run else None
        return train_autoencoder(shards, layout, training, done, keep)
    finally:
        scratch.drop()


@compiled
def train(
    spark: SparkSession,
    params: JobParams | Mapping[str, Any],
    holdout: bool = False,
    keep_scratch: bool = False,
) -> str:
    """Run a training job and return its run folder.

    All rows, the training rows included, are evaluated; ``holdout`` leaves the training rows
    out of the evaluation. Finished epochs can be read with :func:`artefacts.progress` while the
    job runs; if it dies, :func:`resume` goes on.
    """
    params = params if isinstance(params, JobParams) else JobParams.from_mapping(params)
    run = artefacts.new_run(spark, params.output.artefact_dir)
    artefacts.write_record(spark, f"{run}/{artefacts.PARAMS}", params.to_mapping())
    return _train(spark, params, run, holdout, keep_scratch)


@compiled
def resume(
    spark: SparkSession, run: str, holdout: bool = False, keep_scratch: bool = False
) -> str:
    """Go on with a run whose job died: fitted state and finished epochs are taken from its
    folder, the rest is done as the unbroken job would have done it."""
    record = artefacts.read_record(spark, f"{run}/{artefacts.PARAMS}", "run parameters")
    return _train(spark, JobParams.from_mapping(record), run, holdout, keep_scratch)


def _train(
    spark: SparkSession, params: JobParams, run: str, holdout: bool, keep_scratch: bool
) -> str:
    started = time.monotonic()
    profile = get_profile(params.dataset.schema)
    scratch = Scratch(spark)
    try:
        source = params.dataset.path
        loaded = load_table(spark, source, profile, extras=profile.key)
        cleaned = clean(loaded, profile, scratch, params.splits.random_seed)
        prepared = preprocess(cleaned, profile, params, source)
        fitted = [f"{run}/{name}/_SUCCESS" for name in (artefacts.ENCODER, artefacts.SCALER)]
        if all(exists(spark, mark) for mark in fitted):
            prepared = replace(prepared, preprocessor=artefacts.load_preprocessor(spark, run))
        else:
            artefacts.save_preprocessor(spark, run, prepared.preprocessor)

        result = fit_model(prepared, params, run=run)
        artefacts.save_weights(spark, f"{run}/{artefacts.WEIGHTS}", result.model)
        write_table(result.history_table(spark).coalesce(1), f"{run}/{artefacts.HISTORY}")

        # One scoring pass serves the threshold and the evaluation.
        element = "float" if params.training.precision == "float32" else "double"
        scored = result.model.score(prepared.preprocessor.transform(prepared.rows, element))
        kept = [*profile.key, SPLIT, binary_label(profile).alias(M.LABEL), "mse"]
        written = scored.select(*kept)
        write_table(written, f"{run}/{artefacts.SCORES}", partition_by=[SPLIT])
        scores = spark.read.schema(written.schema).parquet(f"{run}/{artefacts.SCORES}")

        train_scores = scores.filter(F.col(SPLIT) == TRAIN)
        threshold = fit_threshold(train_scores, params.threshold.percentile)
        artefacts.save_threshold(spark, run, threshold)
        tested = scores.filter(F.col(SPLIT) != TRAIN) if holdout else scores
        flagged = tested.withColumn(
            M.PREDICTION, anomaly_flag(F.col("mse"), threshold.threshold)
        )
        evaluate(spark, flagged, run)
        artefacts.record_timing(spark, run, time.monotonic() - started)
        artefacts.finish_run(spark, run)
    finally:
        if not keep_scratch:
            scratch.drop()
    return run


@compiled
def evaluate(spark: SparkSession, scored: DataFrame, run: str | None = None) -> dict[str, Any]:
    """Metrics of rows with ``y``, ``prediction`` and ``mse``; with a run folder also the
    tables behind the confusion matrix, ROC and error-histogram charts.

    The rows are read twice: for counts and spans, and for the counts per score, which give the
    area, the curve and the histogram.
    """
    missing = [c for c in (M.LABEL, M.PREDICTION, M.SCORE) if c not in scored.columns]
    if missing:
        raise InferenceError(f"rows to evaluate lack columns: {missing}")
    cells, spans = M.summarise(scored)
    ranked = M.rank_scores(scored)
    found = M.classification_metrics(cells).first().asDict() | {"auc_roc": ranked.auc()}
    if run is not None:
        write_table(M.confusion_matrix(cells).coalesce(1), f"{run}/{artefacts.CONFUSION}")
        write_table(ranked.curve(), f"{run}/{artefacts.ROC}")
        write_table(ranked.histogram(spans).coalesce(1), f"{run}/{artefacts.HISTOGRAM}")
        artefacts.write_record(spark, f"{run}/{artefacts.METRICS}", found)
    ranked.scratch.drop()
    return found


def score(
    spark: SparkSession,
    data: DataFrame | str,
    run: str,
    dedup_rows: bool = True,
    output: str | None = None,
) -> DataFrame:
    """Score new rows with a finished run: the input columns, ``mse`` and ``prediction``.

    ``data`` is a path, or a DataFrame with the columns of the run's profile. The label may be
    absent. A row with a missing or unreadable number has no score (NaN) and is not flagged;
    rows read from CSV show such cells in ``bad_cells``. With ``output`` the scores are written
    there as a table and read back.
    """
    artefacts.check_artefacts(spark, run)
    params = JobParams.from_mapping(
        artefacts.read_record(spark, f"{run}/{artefacts.PARAMS}", "run parameters")
    )
    profile = get_profile(params.dataset.schema)
    if isinstance(data, str):
        rows = load_table(spark, data, profile, label_required=False)
    else:
        rows = project(data, profile, label_required=False)
        if not rows.isStreaming and rows.isEmpty():
            raise InferenceError("cannot score an empty table (0 rows)")
    if dedup_rows:
        subset = [c for c in profile.required if c in rows.columns]
        rows = dedup(rows, subset, profile.key).drop(COPIES)
    result = apply_run(spark, rows.withColumnRenamed(BAD_CELLS, "bad_cells"), run)
    if output is None:
        return result
    write_table(result, output)
    return spark.read.schema(result.schema).parquet(output)


def apply_run(spark: SparkSession, rows: DataFrame, run: str) -> DataFrame:
    """Encode, reconstruct and flag rows with the artefacts of a run; batch or streaming."""
    fitted = artefacts.load_preprocessor(spark, run)
    model = artefacts.load_weights(spark, f"{run}/{artefacts.WEIGHTS}")
    if model.layout.input_dim != fitted.width:
        raise InferenceError(
            f"feature width mismatch: the model expects {model.layout.input_dim} features but "
            f"the fitted encoder gives {fitted.width}"
        )
    threshold = artefacts.load_threshold(spark, run)
    element = "float" if model.layout.dtype == "float32" else "double"
    scored = model.score(fitted.transform(rows, element)).drop("features")
    return scored.withColumn(M.PREDICTION, anomaly_flag(F.col("mse"), threshold.threshold))


def report(spark: SparkSession, run: str) -> DataFrame:
    """Summary of a run as rows (metric, value, normal, anomalous), formatted for reading."""
    path = f"{run}/{artefacts.METRICS}"
    if not exists(spark, path):
        raise ArtifactNotFoundError(f"no report for run '{run}': 'metrics.json' is missing")
    found = artefacts.read_record(spark, path, "metrics")
    limits: dict[str, Any] = {}
    if exists(spark, f"{run}/{artefacts.THRESHOLD}"):
        limits = artefacts.read_record(spark, f"{run}/{artefacts.THRESHOLD}", "threshold artefact")
    return spark.createDataFrame(
        report_rows(found, limits), "metric string, value string, normal string, anomalous string"
    )


def report_rows(
    found: Mapping[str, Any], limits: Mapping[str, Any]
) -> list[tuple[str, str | None, str | None, str | None]]:
    """The lines of a report; absent values read N/A. Labels and formats are fixed values."""

    def shown(value: Any, pattern: str, factor: float = 1.0) -> str:
        return "N/A" if value is None else pattern.format(factor * value)

    def percent(value: Any) -> str:
        return shown(value, "{:.2f}%", 100.0)

    mean, std = limits.get("mse_mean"), limits.get("mse_std")
    rows: list[tuple[str, str | None, str | None, str | None]] = [
        ("Accuracy", percent(found.get("accuracy")), None, None),
        ("AUC-ROC", shown(found.get("auc_roc"), "{:.4f}"), None, None),
        ("Threshold", shown(limits.get("threshold"), "{:.6f}"), None, None),
        ("Percentile", f"{limits.get('percentile', 'N/A')}th pct", None, None),
        ("MSE mean / std", f"{shown(mean, '{:.6f}')} / {shown(std, '{:.6f}')}", None, None),
        ("Training time", shown(found.get("training_time_secs"), "{:.2f}s"), None, None),
    ]
    for name in M.CLASS_METRICS:
        both = (percent(found.get(f"{name}_{c}")) for c in ("normal", "anomalous"))
        rows.append((name.capitalize() if name != "f1" else "F1", None, *both))
    return rows


@dataclass(frozen=True)
class PrepareResult:
    table: str
    sample: str
    total: int
    normal: int
    attack: int


@compiled
def prepare(
    spark: SparkSession,
    raw_path: str,
    table_path: str,
    sample_path: str,
    sample_size: int = 500,
    seed: int = 42,
    profile: Profile = NSL_KDD,
    header: tuple[str, ...] = NSL_KDD_RAW_HEADER,
    fmt: str = "parquet",
    key: tuple[str, ...] = (),
) -> PrepareResult:
    """Raw headerless file to a clean table and a sample of it for scoring."""
    if sample_size < 1:
        raise DataLoadError(f"the sample needs at least 1 row, asked for {sample_size}")
    raw = read_headerless_csv(spark, raw_path, header)
    kept = tuple(c for c in header if c in profile.required)
    rows = project(raw, profile, extras=(), from_text=True, source=raw_path)
    quality = Quality.of(rows, profile)
    quality.check_prepared(raw_path)
    write_table(rows.select(*kept), table_path, fmt)
    if fmt == "parquet":
        table = spark.read.schema(rows.select(*kept).schema).parquet(table_path)
    else:
        table = load_table(spark, table_path, profile).select(*kept)
    write_table(sample_rows(table, sample_size, seed, key), sample_path, fmt)
    return PrepareResult(table_path, sample_path, quality.total, quality.normal, quality.attack)

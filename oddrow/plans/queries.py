"""One query per operator over the TPC-H-like tables; each reads its whole table.

Scores in queries that do not train a model are mean squares of the standard scores, which is
the error of rebuilding every row by the training mean.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import asdict, replace

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddrow.functions.cells import one_row
from oddrow.functions.encoding import one_hot, standard_score
from oddrow.functions.labels import binary_label, is_attack, is_normal
from oddrow.functions.scores import anomaly_flag, mean_square
from oddrow.operators import metrics as M
from oddrow.operators.autoencoder import Autoencoder, TrainingResult
from oddrow.operators.dedup import COPIES, dedup, dedup_counts
from oddrow.operators.features import (
    category_table,
    feature_columns,
)
from oddrow.operators.network import Layout
from oddrow.operators.quality import class_counts, distinct_labels, quality_counts
from oddrow.operators.selection import SPLIT, TRAIN, sample_rows
from oddrow.operators.threshold import Threshold, fit_threshold, score_stats
from oddrow.params import JobParams
from oddrow.plans import jobs
from oddrow.profiles import EMBEDDINGS, EVENTS, LINEITEM, Profile
from oddrow.sources import artefacts
from oddrow.sources.storage import Scratch
from oddrow.sources.tables import load_table, project, write_table

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
PERCENTILE = 95
SAMPLE_SIZE = 500

# The raw table of the prepare queries: its last column is dropped by the job.
RAW_EVENTS = Profile(
    name="raw_events",
    label="event_type",
    normal="view",
    categorical=("event_id", "user_id"),
    numeric=("value",),
    label_map={"view": 0},
)
RAW_EVENTS_HEADER = ("event_id", "user_id", "value", "event_type", "difficulty")


def job_params(profile: Profile, path: str = "table", **training: object) -> JobParams:
    """Small default parameters for queries that need a whole job."""
    return JobParams.from_mapping(
        {
            "dataset": {"path": path, "schema": profile.name},
            "splits": {"train_ratio": 0.7, "val_ratio": 0.1, "test_ratio": 0.2, "random_seed": 42},
            "architecture": {
                "encoder_layers": [32, 16], "bottleneck_dim": 4, "activation": "relu",
                "dropout_rate": 0.0,
            },
            "training": {
                "learning_rate": 0.001, "batch_size": 256, "max_epochs": 3, "patience": 3,
                "lr_schedule": "none", "random_seed": 42,
            } | training,
            "threshold": {"percentile": PERCENTILE},
            "output": {"artefact_dir": "runs"},
        }
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def typed(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Key and required columns of the profile's table."""
    return project(table(spark, sf_dir, profile.name), profile, extras=profile.key)


def prepared(spark: SparkSession, sf_dir: str, profile: Profile) -> jobs.Prepared:
    params = job_params(profile)
    seed = params.splits.random_seed
    rows = jobs.clean(typed(spark, sf_dir, profile), profile, Scratch(spark), seed)
    return jobs.preprocess(rows, profile, params, profile.name)


def rounded(value: Column, name: str) -> Column:
    # Adding zero turns -0.0 into 0.0.
    return (F.round(value, DIGITS) + F.lit(0.0)).alias(name)


def baseline_score(fitted: jobs.Preprocessor) -> Column:
    return mean_square(
        [standard_score(F.col(s.column), s.mean, s.scale) for s in fitted.scales]
    ).alias("mse")


def scored(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Key, split, binary label and baseline score of all deduplicated rows, written once."""
    ready = prepared(spark, sf_dir, profile)
    label, mse = binary_label(profile).alias(M.LABEL), baseline_score(ready.preprocessor)
    rows = ready.rows.select(*profile.key, SPLIT, label, mse)
    return Scratch(spark).keep(rows, "scores")


def threshold_of(scores: DataFrame) -> Threshold:
    return fit_threshold(scores.filter(F.col(SPLIT) == TRAIN), PERCENTILE)


def flagged(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    scores = scored(spark, sf_dir, profile)
    limit = threshold_of(scores).threshold
    return scores.withColumn(M.PREDICTION, anomaly_flag(F.col("mse"), limit))


def _per_profile(
    query: Callable[[SparkSession, str, Profile], DataFrame], profile: Profile
) -> Query:
    return lambda spark, sf_dir: query(spark, sf_dir, profile)


# -- counts, quality, labels -------------------------------------------------------------


def q_class_counts(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return class_counts(typed(spark, sf_dir, profile), profile)


def q_distinct_labels(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return distinct_labels(typed(spark, sf_dir, profile), profile)


def q_quality_gate(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return quality_counts(typed(spark, sf_dir, profile), profile)


def q_binarize_label(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    rows = typed(spark, sf_dir, profile)
    return rows.select(*profile.key, profile.label, binary_label(profile).alias("y"))


def q_normal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, LINEITEM).filter(is_normal(LINEITEM))
    return rows.select(*LINEITEM.key, *LINEITEM.required, F.lit(0).alias("y"))


def q_attack_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, LINEITEM).filter(is_attack(LINEITEM))
    return rows.select(*LINEITEM.key, *LINEITEM.required)


def q_categorical_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(spark, sf_dir, LINEITEM).select(*LINEITEM.key, *LINEITEM.categorical)


def q_numeric_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, EVENTS)
    return rows.select(*EVENTS.key, *[rounded(F.col(c), c) for c in EVENTS.numeric])


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    path = f"{scratch.path}/lineitem_csv"
    lines = typed(spark, sf_dir, LINEITEM)
    odd = F.col(LINEITEM.key[0]) % 2 == 1
    write_table(lines.filter(odd), path, "csv")
    # Files of another column order beside them.
    others = lines.filter(~odd).select(*reversed(lines.columns))
    others.write.mode("append").option("header", True).option("escape", '"').csv(path)
    rows = load_table(spark, path, LINEITEM, extras=LINEITEM.key)
    return rows.select(*[F.col(c).cast("bigint") for c in LINEITEM.key], *LINEITEM.required)


# -- duplicates, split, sample -----------------------------------------------------------


def q_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    kept = dedup(documents, ["text", "lang"], ["doc_id"])
    return kept.withColumnRenamed(COPIES, "copies")


def q_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, LINEITEM)
    return dedup_counts(rows.unionByName(rows.filter(is_attack(LINEITEM))), LINEITEM.required)


def q_dedup_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, LINEITEM)
    repeated = rows.unionByName(rows.filter(is_normal(LINEITEM)))
    return dedup(repeated, LINEITEM.required, LINEITEM.key).withColumnRenamed(COPIES, "copies")


def q_split_train_val(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return prepared(spark, sf_dir, profile).rows.select(*profile.key, SPLIT)


def q_split_sizes(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return prepared(spark, sf_dir, profile).rows.groupBy(SPLIT).agg(
        F.count(F.lit(1)).alias("records")
    )


def q_test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepared(spark, sf_dir, LINEITEM).rows
    return rows.select(*LINEITEM.key, binary_label(LINEITEM).alias("y"))


def q_sample_n(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    rows = typed(spark, sf_dir, profile).select(*profile.key, profile.label)
    return sample_rows(rows, SAMPLE_SIZE, 42, profile.key)


# -- fitted preprocessing ----------------------------------------------------------------


def q_scaler_fit(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    scales = prepared(spark, sf_dir, profile).preprocessor.scales
    fitted = [(s.column, s.mean, s.std, s.scale) for s in scales]
    out = spark.createDataFrame(fitted, "column string, mean double, std double, scale double")
    return out.select("column", *[rounded(F.col(c), c) for c in ("mean", "std", "scale")])


def q_scaler_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir, LINEITEM)
    scaled = [
        rounded(standard_score(F.col(s.column), s.mean, s.scale), s.column)
        for s in ready.preprocessor.scales
    ]
    return ready.rows.select(*LINEITEM.key, *scaled)


def q_ohe_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = prepared(spark, sf_dir, LINEITEM).preprocessor
    rows = [(c, v) for c, values in fitted.categories for v in values]
    return spark.createDataFrame(rows, "column string, category string")


def q_ohe_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir, LINEITEM)
    ((name, categories),) = ready.preprocessor.categories
    rows = ready.rows.withColumn("features", one_hot(F.col(name), categories))
    return rows.select(*LINEITEM.key, name, *feature_columns(rows, len(categories)))


def q_unknown_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed(spark, sf_dir, LINEITEM)
    fit_on = rows.filter(F.col("l_linestatus") == "F")
    categories = [r["category"] for r in category_table(fit_on, ["l_linestatus"]).collect()]
    coded = rows.withColumn("features", one_hot(F.col("l_linestatus"), categories))
    return coded.select(*LINEITEM.key, "l_linestatus", *feature_columns(coded, len(categories)))


def q_assemble_features(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    ready = prepared(spark, sf_dir, profile)
    rows = ready.preprocessor.transform(ready.rows)
    cells = [
        rounded(F.element_at("features", i + 1), f"f{i}") for i in range(ready.preprocessor.width)
    ]
    return rows.select(*profile.key, SPLIT, *cells)


# -- scores, threshold, evaluation -------------------------------------------------------


def q_scores(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    rows = scored(spark, sf_dir, profile)
    return rows.select(*profile.key, SPLIT, "y", rounded(F.col("mse"), "mse"))


def q_threshold(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return threshold_row(spark, threshold_of(scored(spark, sf_dir, profile)))


def threshold_row(spark: SparkSession, found: Threshold) -> DataFrame:
    schema = "threshold double, percentile int, mse_mean double, mse_std double"
    out = one_row(spark, asdict(found), schema)
    return out.select(
        "percentile", *[rounded(F.col(c), c) for c in ("threshold", "mse_mean", "mse_std")]
    )


def q_score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = scored(spark, sf_dir, LINEITEM).filter(F.col(SPLIT) == TRAIN)
    return score_stats(train).select(*[rounded(F.col(c), c) for c in ("mse_mean", "mse_std")])


def q_class_scores(spark: SparkSession, sf_dir: str, y: int) -> DataFrame:
    rows = scored(spark, sf_dir, LINEITEM).filter(F.col("y") == y)
    return rows.select(*LINEITEM.key, rounded(F.col("mse"), "mse"))


def q_predict_flags(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    rows = flagged(spark, sf_dir, profile)
    return rows.select(*profile.key, "y", M.PREDICTION)


def q_confusion_matrix(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    return M.confusion_matrix(flagged(spark, sf_dir, profile))


def q_classification_metrics(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    found = M.classification_metrics(flagged(spark, sf_dir, profile))
    return found.select(*[rounded(F.col(c), c) for c in M.METRIC_NAMES])


def q_auc_roc(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    found = M.auc_roc(scored(spark, sf_dir, profile))
    return found.select(rounded(F.col("auc_roc"), "auc_roc"), "below_warning")


def q_roc_curve(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    points = M.roc_curve(scored(spark, sf_dir, profile))
    # The first point has no finite threshold.
    threshold = F.when(F.col("threshold") < float("inf"), F.col("threshold"))
    return points.select(
        rounded(threshold, "threshold"), *[rounded(F.col(c), c) for c in ("fpr", "tpr")]
    )


def q_error_histogram(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    bins = M.error_histogram(scored(spark, sf_dir, profile))
    return bins.select(
        "label", "bin", *[rounded(F.col(c), c) for c in ("lower", "upper")], "records"
    )


def _evaluation(spark: SparkSession, sf_dir: str) -> tuple[dict, Threshold, DataFrame]:
    scores = scored(spark, sf_dir, LINEITEM)
    limit = threshold_of(scores)
    rows = scores.withColumn(M.PREDICTION, anomaly_flag(F.col("mse"), limit.threshold))
    return jobs.evaluate(spark, rows), limit, rows


def q_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicate, split, fit, score, set the threshold, flag, evaluate: one row."""
    found, limit, rows = _evaluation(spark, sf_dir)
    sizes = rows.agg(
        F.count_if(F.col(SPLIT) == TRAIN).alias("train_rows"),
        F.count_if(F.col(SPLIT) == "val").alias("val_rows"),
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(F.col(M.PREDICTION) == 1).alias("flagged_rows"),
    )
    values = found | {"threshold": limit.threshold}
    return sizes.select("*", *[rounded(F.lit(v), name) for name, v in values.items()])


def q_run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run, from the records in its folder."""
    found, limit, _ = _evaluation(spark, sf_dir)
    run = Scratch(spark).path
    artefacts.write_record(spark, f"{run}/{artefacts.METRICS}", found)
    artefacts.save_threshold(spark, run, limit)
    return jobs.report(spark, run)


# -- the autoencoder ---------------------------------------------------------------------

FIXED_LAYOUT = Layout(3, (4,), 2, activation="relu", dtype="float64")


def fixed_vector(layout: Layout = FIXED_LAYOUT) -> np.ndarray:
    """Parameters by rule: spread over (-0.8, 0.8), variances and scales around one."""
    vector = np.zeros(layout.size)
    for i, ((_, name), part) in enumerate(layout.views(vector).items()):
        values = np.round(0.8 * np.sin(np.arange(part.size) * 1.7 + i), 4)
        if name in ("gamma", "moving_variance"):
            values = 1.0 + values / 4
        part[:] = values.reshape(part.shape)
    return vector


def q_reconstruct_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir, EVENTS)
    model = Autoencoder(FIXED_LAYOUT, fixed_vector())
    rows = model.reconstruct(ready.preprocessor.transform(ready.rows))
    rebuilt = [
        rounded(F.element_at("reconstruction", i + 1), f"r{i}")
        for i in range(FIXED_LAYOUT.input_dim)
    ]
    return rows.select(*EVENTS.key, *rebuilt, rounded(F.col("mse"), "mse"))


def q_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready = prepared(spark, sf_dir, EVENTS)
    model = Autoencoder(FIXED_LAYOUT, fixed_vector())
    rows = model.predict(ready.preprocessor.transform(ready.rows), 1.0)
    return rows.select(*EVENTS.key, rounded(F.col("mse"), "mse"), "prediction")


def q_train_score(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Train on the normal rows, take the threshold from them, flag all rows."""
    ready = prepared(spark, sf_dir, profile)
    result = jobs.fit_model(ready, job_params(profile))
    rows = result.model.score(ready.preprocessor.transform(ready.rows, "float"))
    rows = rows.select(*profile.key, SPLIT, binary_label(profile).alias(M.LABEL), "mse")
    scores = Scratch(spark).keep(rows, "scores")
    limit = threshold_of(scores).threshold
    return scores.withColumn(M.PREDICTION, anomaly_flag(F.col("mse"), limit))


# Training that SQL can follow: in every round each shard takes one Adam step over all its rows,
# in doubles, and rows are dealt by their rank.
STEP_LAYERS, STEP_BOTTLENECK, STEP_ACTIVATION = (4,), 2, "tanh"
STEP_SHARDS, STEP_ROUNDS, STEP_EPOCHS = 4, 2, 3
STEP_RATE = 0.01
WHOLE_BATCH = 1 << 40


def step_params(profile: Profile, n_train: int = 1, path: str = "table") -> JobParams:
    """One step per shard and round, and ``STEP_ROUNDS`` rounds whatever the size of the table."""
    made = job_params(
        profile, path, learning_rate=STEP_RATE, batch_size=WHOLE_BATCH, max_epochs=STEP_EPOCHS,
        shards=STEP_SHARDS, precision="float64", deal_by="rank",
        round_rows=max(1, -(-n_train // (STEP_SHARDS * STEP_ROUNDS))),
    )
    layers = replace(
        made.architecture, encoder_layers=list(STEP_LAYERS), bottleneck_dim=STEP_BOTTLENECK,
        activation=STEP_ACTIVATION,
    )
    return replace(made, architecture=layers)


def stepped(ready: jobs.Prepared, profile: Profile) -> TrainingResult:
    return jobs.fit_model(ready, step_params(profile, ready.split.n_train))


def q_training_history(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Losses and rate of every epoch."""
    history = stepped(prepared(spark, sf_dir, profile), profile).history_table(spark)
    columns = ("loss", "val_loss", "learning_rate")
    return history.select("epoch", *[rounded(F.col(c), c) for c in columns])


def q_train_epoch(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Every parameter of the best model after the last epoch."""
    model = stepped(prepared(spark, sf_dir, profile), profile).model
    weights = artefacts.weight_table(spark, model)
    cells = weights.select("layer", "parameter", F.posexplode("values").alias("cell", "value"))
    return cells.select("layer", "parameter", "cell", rounded(F.col("value"), "value"))


def q_train_steps_score(spark: SparkSession, sf_dir: str, profile: Profile) -> DataFrame:
    """Train, take the threshold from the training rows, flag all rows."""
    ready = prepared(spark, sf_dir, profile)
    model = stepped(ready, profile).model
    rows = model.score(ready.preprocessor.transform(ready.rows))
    kept = rows.select(*profile.key, SPLIT, binary_label(profile).alias(M.LABEL), "mse")
    scores = Scratch(spark).keep(kept, "scores")
    flag = anomaly_flag(F.col("mse"), threshold_of(scores).threshold).alias(M.PREDICTION)
    return scores.select(*profile.key, SPLIT, "y", rounded(F.col("mse"), "mse"), flag)


# -- stored artefacts --------------------------------------------------------------------


def q_threshold_artefact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold as read back from a run folder."""
    run = Scratch(spark).path
    found = threshold_of(scored(spark, sf_dir, LINEITEM))
    artefacts.save_threshold(spark, run, found)
    return threshold_row(spark, artefacts.load_threshold(spark, run))


def q_scaler_artefact(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Scratch(spark).path
    artefacts.save_preprocessor(spark, run, prepared(spark, sf_dir, LINEITEM).preprocessor)
    rows = spark.read.parquet(f"{run}/{artefacts.SCALER}")
    return rows.select("column", *[rounded(F.col(c), c) for c in ("mean", "std", "scale")])


def q_encoder_artefact(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = Scratch(spark).path
    artefacts.save_preprocessor(spark, run, prepared(spark, sf_dir, LINEITEM).preprocessor)
    return spark.read.parquet(f"{run}/{artefacts.ENCODER}").select("column", "place", "category")


def q_score_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring job on a stored run: fitted preprocessing, fixed weights, fitted threshold."""
    run = Scratch(spark).path
    ready = prepared(spark, sf_dir, EVENTS)
    model = Autoencoder(FIXED_LAYOUT, fixed_vector())
    artefacts.write_record(spark, f"{run}/{artefacts.PARAMS}", job_params(EVENTS).to_mapping())
    artefacts.save_preprocessor(spark, run, ready.preprocessor)
    artefacts.save_weights(spark, f"{run}/{artefacts.WEIGHTS}", model)
    train = model.score(ready.preprocessor.transform(ready.train)).select("mse")
    written = Scratch(spark).keep(train, "train-scores")
    artefacts.save_threshold(spark, run, fit_threshold(written, PERCENTILE))
    rows = jobs.score(spark, table(spark, sf_dir, "events"), run)
    return rows.select(*EVENTS.key, rounded(F.col("mse"), "mse"), M.PREDICTION)


def q_train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run from a table to flags: train, find the run again, score the table with it."""
    base = f"{Scratch(spark).path}/runs"
    plan = step_params(EVENTS, WHOLE_BATCH, f"{sf_dir}/events.parquet").to_mapping()
    jobs.train(spark, plan | {"output": {"artefact_dir": base}})
    run = artefacts.latest_run(spark, base)
    rows = jobs.score(spark, table(spark, sf_dir, "events"), run)
    return rows.select(*EVENTS.key, rounded(F.col("mse"), "mse"), M.PREDICTION)


# -- preparing raw files -----------------------------------------------------------------


def _prepare_events(spark: SparkSession, sf_dir: str) -> jobs.PrepareResult:
    scratch = Scratch(spark)
    raw = f"{scratch.path}/raw"
    events = table(spark, sf_dir, "events")
    columns = ["event_id", "user_id", "value", "event_type", F.lit(1).alias("difficulty")]
    events.select(*columns).write.csv(raw)
    return jobs.prepare(
        spark, raw, f"{scratch.path}/table", f"{scratch.path}/sample", SAMPLE_SIZE,
        profile=RAW_EVENTS, header=RAW_EVENTS_HEADER, key=("event_id",),
    )


def q_prepare_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_prepare_events(spark, sf_dir).table)


def q_prepare_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(_prepare_events(spark, sf_dir).sample)


def q_prepare_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asdict(_prepare_events(spark, sf_dir))
    return one_row(spark, found, "total bigint, normal bigint, attack bigint")


def all_queries() -> dict[str, Query]:
    named: dict[str, Query] = {
        "normal_rows": q_normal_rows,
        "attack_rows": q_attack_rows,
        "categorical_columns": q_categorical_columns,
        "numeric_columns": q_numeric_columns,
        "csv_scan": q_csv_scan,
        "dedup_rows": q_dedup_rows,
        "dedup_report": q_dedup_report,
        "dedup_lineitem": q_dedup_lineitem,
        "test_rows": q_test_rows,
        "scaler_transform": q_scaler_transform,
        "ohe_fit": q_ohe_fit,
        "ohe_transform": q_ohe_transform,
        "unknown_category_zero_block": q_unknown_category,
        "score_stats": q_score_stats,
        "normal_scores": lambda spark, sf_dir: q_class_scores(spark, sf_dir, 0),
        "attack_scores": lambda spark, sf_dir: q_class_scores(spark, sf_dir, 1),
        "anomaly_end_to_end": q_end_to_end,
        "run_report": q_run_report,
        "reconstruct_fixed_weights": q_reconstruct_fixed,
        "score_fixed_weights": q_score_fixed,
        "threshold_artefact": q_threshold_artefact,
        "scaler_artefact": q_scaler_artefact,
        "encoder_artefact": q_encoder_artefact,
        "score_job": q_score_job,
        "train_job": q_train_job,
        "prepare_dataset": q_prepare_dataset,
        "prepare_sample": q_prepare_sample,
        "prepare_summary": q_prepare_summary,
    }
    for name, query, profiles in (
        ("class_counts", q_class_counts, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("distinct_labels", q_distinct_labels, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("quality_gate", q_quality_gate, (LINEITEM, EVENTS)),
        ("binarize_label", q_binarize_label, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("split_train_val", q_split_train_val, (LINEITEM, EVENTS)),
        ("split_sizes", q_split_sizes, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("sample_n", q_sample_n, (LINEITEM, EVENTS)),
        ("scaler_fit", q_scaler_fit, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("assemble_features", q_assemble_features, (LINEITEM, EVENTS, EMBEDDINGS)),
        ("scores", q_scores, (LINEITEM, EVENTS)),
        ("threshold_percentile", q_threshold, (LINEITEM, EVENTS)),
        ("predict_flags", q_predict_flags, (LINEITEM, EVENTS)),
        ("confusion_matrix", q_confusion_matrix, (LINEITEM, EVENTS)),
        ("classification_metrics", q_classification_metrics, (LINEITEM, EVENTS)),
        ("auc_roc", q_auc_roc, (LINEITEM, EVENTS)),
        ("roc_curve", q_roc_curve, (LINEITEM, EVENTS)),
        ("error_histogram", q_error_histogram, (LINEITEM, EVENTS)),
        ("autoencoder_train_score", q_train_score, (EMBEDDINGS, LINEITEM)),
        ("training_history", q_training_history, (EMBEDDINGS, LINEITEM)),
        ("train_epoch", q_train_epoch, (EVENTS, LINEITEM)),
        ("train_steps_score", q_train_steps_score, (EVENTS, LINEITEM)),
    ):
        for profile in profiles:
            named[f"{name}_{profile.name}"] = _per_profile(query, profile)
    return {name: _quiet(query) for name, query in named.items()}


def _quiet(query: Query) -> Query:
    """The tables' labels are random, so the low-AUC warning says nothing here."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with warnings.catch_warnings():
            warnings.filterwarnings("ignore", message="low AUC")
            return query(spark, sf_dir)

    return run

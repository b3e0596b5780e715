"""Whole jobs: train, score, evaluate, report, prepare, and scoring on a stream."""

import json
import math
import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from samples import connections, job
from pyspark.sql import functions as F

from oddrow import (
    ArtifactNotFoundError,
    ConfigurationError,
    DataLoadError,
    InferenceError,
    JobParams,
    SchemaValidationError,
)
from oddrow.operators import metrics as M
from oddrow.plans import jobs
from oddrow.profiles import CICIDS2017, NSL_KDD, NSL_KDD_RAW_HEADER, UNSW_NB15
from oddrow.sources import artefacts
from oddrow.streaming.scoring import score_stream

ARTEFACTS = (
    "weights", "scaler", "encoder", "threshold.json", "confusion_matrix", "roc_curve",
    "re_histogram", "metrics.json", "params.json", "history", "scores", "progress",
    "manifest.json",
)

pytestmark = pytest.mark.filterwarnings("ignore:low AUC")


LEFT_BEHIND: set[Path] = set()


def shared_files(spark):
    """Files in the shared folder, but for the package itself."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return {p for p in folder.rglob("*") if p.is_file() and "oddrow-package" not in str(p)}


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("jobs")
    connections(300, 100).to_csv(base / "train.csv", index=False)
    params = job(str(base / "train.csv"), str(base / "runs"))
    before = shared_files(spark)
    made = jobs.train(spark, params)
    LEFT_BEHIND.update(shared_files(spark) - before)
    return made


def test_training_leaves_only_its_run_folder(run):
    assert not LEFT_BEHIND


def test_a_run_holds_all_artefacts(spark, run):
    for name in ARTEFACTS:
        assert (Path(run) / name).exists(), name
    metrics = artefacts.read_record(spark, f"{run}/metrics.json", "metrics")
    for name in (*M.METRIC_NAMES, "auc_roc"):
        assert 0.0 <= metrics[name] <= 1.0
    assert metrics["training_time_secs"] > 0
    assert artefacts.latest_run(spark, str(Path(run).parent)) == run


def test_parameters_are_kept(spark, run):
    stored = artefacts.read_record(spark, f"{run}/params.json", "params")
    assert JobParams.from_mapping(stored).dataset.path.endswith("train.csv")


def test_scores_cover_all_rows(spark, run):
    scores = spark.read.parquet(f"{run}/scores")
    sizes = {r["split"]: r["count"] for r in scores.groupBy("split").count().collect()}
    assert sizes == {"train": 262, "val": 38, "attack": 100}
    threshold = artefacts.load_threshold(spark, run)
    train = [r.mse for r in scores.filter("split = 'train'").collect()]
    assert math.isclose(threshold.threshold, np.percentile(train, 95), rel_tol=1e-12)
    assert math.isclose(threshold.mse_std, np.std(train), rel_tol=1e-9)


def test_chart_tables(spark, run):
    cells = spark.read.parquet(f"{run}/confusion_matrix").toPandas()
    assert len(cells) == 4 and cells["records"].sum() == 400
    bins = spark.read.parquet(f"{run}/re_histogram").groupBy("label").agg(
        F.count("bin").alias("bins"), F.sum("records").alias("records")
    )
    assert {tuple(r) for r in bins.collect()} == {(0, 30, 300), (1, 30, 100)}
    curve = spark.read.parquet(f"{run}/roc_curve").toPandas()
    assert curve["fpr"].max() == curve["tpr"].max() == 1.0
    history = spark.read.parquet(f"{run}/history").orderBy("epoch").collect()
    assert [h.epoch for h in history] == [1, 2, 3]


def test_progress_is_the_history(spark, run):
    lines = ["epoch", "loss", "val_loss", "learning_rate"]
    kept = sorted(map(tuple, artefacts.progress(spark, run).select(*lines).collect()))
    history = spark.read.parquet(f"{run}/history").select(*lines)
    assert kept == sorted(map(tuple, history.collect())) and len(kept) == 3


def weights_of(spark, run):
    return artefacts.load_weights(spark, f"{run}/weights").vector


def test_a_run_whose_driver_died_goes_on(spark, make_csv, tmp_path, monkeypatch):
    path = make_csv(connections(200, 60))
    plan = job(path, str(tmp_path / "runs"), max_epochs=5, shards=2)
    whole = jobs.train(spark, plan)

    class Died(Exception):
        pass

    keep = artefacts.keep_epoch

    def dies_after_two(spark, run, done):
        assert artefacts.progress(spark, run).count() == done.epoch - 1  # readable meanwhile
        keep(spark, run, done)
        if done.epoch == 2:
            raise Died

    with monkeypatch.context() as patched:
        patched.setattr(artefacts, "keep_epoch", dies_after_two)
        with pytest.raises(Died):
            jobs.train(spark, plan | {"output": {"artefact_dir": str(tmp_path / "broken")}})
    (broken,) = (str(p) for p in (tmp_path / "broken").iterdir())
    with pytest.raises(ArtifactNotFoundError, match="no finished run"):
        artefacts.latest_run(spark, str(tmp_path / "broken"))
    assert jobs.resume(spark, broken) == broken
    assert artefacts.latest_run(spark, str(tmp_path / "broken")) == broken
    assert np.array_equal(weights_of(spark, broken), weights_of(spark, whole))
    same = [spark.read.parquet(f"{r}/history").orderBy("epoch").collect() for r in (whole, broken)]
    assert same[0] == same[1] and len(same[0]) > 2
    assert artefacts.progress(spark, broken).count() == len(same[0])


def test_a_run_that_fails_after_its_weights_does_not_count(
    spark, make_csv, tmp_path, monkeypatch
):
    base = str(tmp_path / "runs")
    plan = job(make_csv(connections(120, 40)), base, max_epochs=1, shards=2)
    first = jobs.train(spark, plan)

    def fails(*_, **__):
        raise OSError("no space")

    with monkeypatch.context() as patched:
        patched.setattr(artefacts, "save_threshold", fails)
        with pytest.raises(OSError, match="no space"):
            jobs.train(spark, plan)
    broken = max(p for p in Path(base).iterdir() if str(p) != first)
    assert (broken / "weights" / "_SUCCESS").exists()
    assert artefacts.latest_run(spark, base) == first
    jobs.resume(spark, str(broken))
    assert artefacts.latest_run(spark, base) == max(first, str(broken))


@pytest.mark.parametrize("with_label", [True, False])
def test_scoring_new_rows(spark, run, make_csv, with_label):
    table = connections(20, 10, seed=7).assign(note=[f"row {i}" for i in range(30)])
    if not with_label:
        table = table.drop(columns="label")
    path = make_csv(table)
    scored = jobs.score(spark, path, run)
    rows = scored.collect()
    assert len(rows) == 30 == len({r.note for r in rows})
    threshold = artefacts.load_threshold(spark, run).threshold
    assert all(r.mse >= 0 and r.prediction == int(r.mse >= threshold) for r in rows)
    assert {"mse", "prediction", "note", *NSL_KDD.features} <= set(scored.columns)
    assert "features" not in scored.columns


def test_scores_match_those_of_training(spark, run, make_csv):
    """Artefacts read back give the scores that training wrote."""
    scored = jobs.score(spark, make_csv(connections(300, 100)), run)
    again = sorted(r.mse for r in scored.collect())
    stored = sorted(r.mse for r in spark.read.parquet(f"{run}/scores").collect())
    assert np.allclose(again, stored, rtol=1e-6)


def test_scoring_drops_copies_unless_told_otherwise(spark, run, make_csv, tmp_path):
    table = connections(10, 5, seed=3)
    path = make_csv(pd.concat([table, table.head(4)]))
    assert jobs.score(spark, path, run).count() == 15
    output = f"{tmp_path}/scored"
    assert jobs.score(spark, path, run, dedup_rows=False, output=output).count() == 19
    assert spark.read.parquet(output).count() == 19


def test_unreadable_cells_give_no_score(spark, run, make_csv):
    table = connections(4, 1, seed=13).astype({"duration": object})
    table.loc[2, "duration"] = "oops"
    rows = jobs.score(spark, make_csv(table), run).collect()
    assert [(math.isnan(r.mse), r.prediction) for r in rows if r.bad_cells] == [(True, 0)]
    assert sum(math.isnan(r.mse) for r in rows) == 1


def test_scoring_a_frame(spark, run):
    rows = spark.createDataFrame(connections(8, 2, seed=5))
    assert jobs.score(spark, rows, run).count() == 10
    with pytest.raises(InferenceError, match="empty"):
        jobs.score(spark, rows.filter("false"), run)
    with pytest.raises(SchemaValidationError, match="duration"):
        jobs.score(spark, rows.drop("duration"), run)


def test_scoring_needs_a_complete_run(spark, tmp_path, make_csv):
    with pytest.raises(ArtifactNotFoundError, match="weights.*scaler.*encoder.*threshold.json"):
        jobs.score(spark, make_csv(connections(3, 1)), str(tmp_path))


def test_mismatched_artefacts_are_refused(spark, run, tmp_path):
    fitted = artefacts.load_preprocessor(spark, run)
    for name in ("weights", "threshold.json"):
        source = Path(run) / name
        target = tmp_path / name
        target.mkdir()
        for part in source.iterdir():
            (target / part.name).write_bytes(part.read_bytes())
    narrower = type(fitted)(fitted.categories, fitted.scales[:-1])
    artefacts.save_preprocessor(spark, str(tmp_path), narrower)
    rows = spark.createDataFrame(connections(3, 1))
    with pytest.raises(InferenceError, match="expects 55 features.*gives 54"):
        jobs.apply_run(spark, rows, str(tmp_path))


def test_scoring_a_stream(spark, run, tmp_path):
    rows = spark.createDataFrame(connections(12, 4, seed=11))
    rows.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    query = (
        score_stream(spark, stream, run)
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = sorted(r.mse for r in spark.read.parquet(f"{tmp_path}/out").collect())
    batch = sorted(r.mse for r in jobs.score(spark, rows, run, dedup_rows=False).collect())
    assert np.allclose(got, batch) and len(got) == 16


def test_same_seed_gives_the_same_run(spark, make_csv, tmp_path):
    path = make_csv(connections(60, 20))
    runs = [
        jobs.train(spark, job(path, f"{tmp_path}/r{i}", max_epochs=2, shards=2)) for i in range(2)
    ]
    one, two = (artefacts.load_weights(spark, f"{r}/weights") for r in runs)
    assert np.array_equal(one.vector, two.vector)
    assert artefacts.load_threshold(spark, runs[0]) == artefacts.load_threshold(spark, runs[1])


def test_shifted_attacks_are_found(spark, make_csv, tmp_path):
    path = make_csv(connections(600, 150, shift=3.0))
    params = job(path, f"{tmp_path}/runs", max_epochs=12, learning_rate=0.005)
    run = jobs.train(spark, params, holdout=True)
    metrics = artefacts.read_record(spark, f"{run}/metrics.json", "metrics")
    assert metrics["auc_roc"] > 0.95 and metrics["recall_anomalous"] > 0.9
    cells = spark.read.parquet(f"{run}/confusion_matrix").toPandas()
    assert cells["records"].sum() == 75 + 150


def test_copies_do_not_leak_into_training(spark, make_csv, tmp_path):
    table = connections(100, 20)
    path = make_csv(pd.concat([table, table]))
    run = jobs.train(spark, job(path, f"{tmp_path}/runs", max_epochs=1))
    assert spark.read.parquet(f"{run}/scores").count() == 120


@pytest.mark.parametrize("value", [np.nan, np.inf])
def test_training_stops_at_gaps(spark, make_csv, tmp_path, value):
    table = connections(20, 5)
    table.loc[3, "hot"] = value
    with pytest.raises(SchemaValidationError, match="hot"):
        jobs.train(spark, job(make_csv(table), f"{tmp_path}/runs"))


def test_training_needs_normal_rows(spark, make_csv, tmp_path):
    with pytest.raises(DataLoadError, match="at least 2"):
        jobs.train(spark, job(make_csv(connections(1, 5)), f"{tmp_path}/runs"))


def test_bad_parameters_start_nothing(spark, tmp_path):
    raw = job("nowhere.csv", f"{tmp_path}/runs")
    raw["threshold"]["percentile"] = 0
    with pytest.raises(ConfigurationError):
        jobs.train(spark, raw)
    assert not (tmp_path / "runs").exists()


@pytest.mark.parametrize("profile", [CICIDS2017, UNSW_NB15])
def test_other_profiles_train_end_to_end(spark, make_csv, tmp_path, profile):
    rng = np.random.default_rng(1)
    table = pd.DataFrame(rng.normal(size=(90, len(profile.numeric))), columns=profile.numeric)
    for c in profile.categorical:
        table[c] = rng.choice(["a", "b", "c"], 90)
    other = "DoS" if isinstance(profile.normal, str) else 1
    table[profile.label] = [profile.normal] * 60 + [other] * 30
    path = make_csv(table)
    if profile is CICIDS2017:
        # The distribution repeats this header without the suffix.
        text = Path(path).read_text().replace("Fwd Header Length.1", "Fwd Header Length", 1)
        Path(path).write_text(text)
    params = job(path, f"{tmp_path}/runs", max_epochs=1)
    params["dataset"]["schema"] = profile.name
    run = jobs.train(spark, params)
    assert jobs.score(spark, path, run).count() == 90
    assert artefacts.load_preprocessor(spark, run).width == len(profile.numeric) + 3 * len(
        profile.categorical
    )


def test_evaluation_needs_its_columns(spark):
    with pytest.raises(InferenceError, match="prediction"):
        jobs.evaluate(spark, spark.createDataFrame([(1, 0.5)], "y int, mse double"))


# -- report ----------------------------------------------------------------------------


def test_report_text(spark, tmp_path):
    metrics = {
        "precision_normal": 0.91, "recall_normal": 0.94, "f1_normal": 0.92,
        "precision_anomalous": 0.93, "recall_anomalous": 0.90, "f1_anomalous": 0.91,
        "accuracy": 0.92, "auc_roc": 0.97, "training_time_secs": 18.3,
    }
    limits = {"threshold": 0.35, "percentile": 95, "mse_mean": 0.21, "mse_std": 5.5}
    (tmp_path / "metrics.json").write_text(json.dumps(metrics, indent=2))
    (tmp_path / "threshold.json").write_text(json.dumps(limits))
    got = {r.metric: r for r in jobs.report(spark, str(tmp_path)).collect()}
    assert got["Accuracy"].value == "92.00%" and got["AUC-ROC"].value == "0.9700"
    assert got["Threshold"].value == "0.350000" and got["Percentile"].value == "95th pct"
    assert got["MSE mean / std"].value == "0.210000 / 5.500000"
    assert got["Training time"].value == "18.30s"
    assert (got["Precision"].normal, got["Precision"].anomalous) == ("91.00%", "93.00%")
    assert (got["F1"].normal, got["F1"].anomalous) == ("92.00%", "91.00%")


def test_report_without_some_values(spark, tmp_path):
    with pytest.raises(ArtifactNotFoundError, match="metrics.json"):
        jobs.report(spark, str(tmp_path))
    (tmp_path / "metrics.json").write_text("{}")
    rows = jobs.report(spark, str(tmp_path)).collect()
    assert {r.value or r.normal for r in rows} == {"N/A", "N/Ath pct", "N/A / N/A"}


def test_report_of_a_run(spark, run):
    assert jobs.report(spark, run).count() == 9


# -- prepare ---------------------------------------------------------------------------


def raw_file(tmp_path, table):
    raw = table.assign(difficulty=21)[list(NSL_KDD_RAW_HEADER)]
    raw.to_csv(tmp_path / "raw.csv", index=False, header=False)
    return str(tmp_path / "raw.csv")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_prepare(spark, tmp_path, fmt):
    table = connections(70, 30)
    out = jobs.prepare(
        spark, raw_file(tmp_path, table), f"{tmp_path}/table.{fmt}", f"{tmp_path}/sample.{fmt}",
        sample_size=12, fmt=fmt,
    )
    assert (out.total, out.normal, out.attack) == (100, 70, 30)
    read = spark.read.parquet if fmt == "parquet" else (
        lambda p: spark.read.csv(p, header=True, inferSchema=True)
    )
    clean = read(out.table)
    assert clean.columns == list(NSL_KDD_RAW_HEADER[:-1])
    assert np.allclose(sorted(clean.toPandas()["duration"]), sorted(table["duration"]))
    sample = read(out.sample)
    assert sample.count() == 12 and sample.subtract(clean).count() == 0
    again = jobs.prepare(
        spark, raw_file(tmp_path, table), f"{tmp_path}/t2", f"{tmp_path}/s2", sample_size=12
    )
    assert sorted(spark.read.parquet(again.sample).toPandas()["duration"]) == pytest.approx(
        sorted(sample.toPandas()["duration"])
    )


def test_prepare_gate(spark, tmp_path):
    places = (f"{tmp_path}/t", f"{tmp_path}/s")
    with pytest.raises(SchemaValidationError, match="normal and attack"):
        jobs.prepare(spark, raw_file(tmp_path, connections(5, 0)), *places)
    gap = connections(5, 5)
    gap.loc[2, "land"] = np.nan
    with pytest.raises(SchemaValidationError, match="land"):
        jobs.prepare(spark, raw_file(tmp_path, gap), *places)
    assert not Path(places[0]).exists()
    with pytest.raises(DataLoadError, match="at least 1"):
        jobs.prepare(spark, raw_file(tmp_path, gap), *places, sample_size=0)
    (tmp_path / "narrow.csv").write_text("1,2\n")
    with pytest.raises(SchemaValidationError, match="expected 43"):
        jobs.prepare(spark, str(tmp_path / "narrow.csv"), *places)


def test_prepared_data_trains(spark, tmp_path):
    out = jobs.prepare(
        spark, raw_file(tmp_path, connections(50, 20)), f"{tmp_path}/t.parquet", f"{tmp_path}/s"
    )
    run = jobs.train(spark, job(out.table, f"{tmp_path}/runs", max_epochs=1))
    assert spark.read.parquet(f"{run}/scores").count() == 70


# -- speed -----------------------------------------------------------------------------


def test_warm_scoring_of_ten_thousand_rows_takes_under_five_seconds(spark, run):
    rows = spark.createDataFrame(connections(10_000, 0, seed=9)).cache()
    rows.count()
    scored = jobs.apply_run(spark, rows, run)
    sink = scored.write.format("noop").mode("overwrite")
    sink.save()
    started = time.perf_counter()
    sink.save()
    assert time.perf_counter() - started < 5.0

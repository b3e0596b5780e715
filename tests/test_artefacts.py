"""Run folders and stored state."""

import json
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oddrow import ArtifactLoadError, ArtifactNotFoundError, ArtifactWriteError, InferenceError
from oddrow.operators.autoencoder import Autoencoder
from oddrow.operators.features import ColumnScale, Preprocessor
from oddrow.operators.network import Layout
from oddrow.operators.threshold import Threshold
from oddrow.sources import artefacts
from oddrow.sources.storage import Scratch, exists

GOOD = {"threshold": 0.5, "percentile": 95, "mse_mean": 0.1, "mse_std": 0.2}


def put(folder, value):
    (folder / "threshold.json").write_text(
        value if isinstance(value, str) else json.dumps(value, indent=2), encoding="utf-8"
    )
    return str(folder)


def test_threshold_round_trip(spark, tmp_path):
    found = Threshold(0.1 + 0.2, 95, 1e-17, 3.0)
    artefacts.save_threshold(spark, str(tmp_path), found)
    assert artefacts.load_threshold(spark, str(tmp_path)) == found
    stored = artefacts.read_record(spark, f"{tmp_path}/threshold.json", "x")
    assert set(stored) == {"threshold", "percentile", "mse_mean", "mse_std"}


def test_plain_indented_file_is_read(spark, tmp_path):
    assert artefacts.load_threshold(spark, put(tmp_path, GOOD)) == Threshold(0.5, 95, 0.1, 0.2)
    text = {**GOOD, "threshold": "0.25"}
    assert artefacts.load_threshold(spark, put(tmp_path, text)).threshold == 0.25


@pytest.mark.parametrize(
    ("content", "words"),
    [
        ({"threshold": 0.5, "percentile": 95}, "no number for mse_mean, mse_std"),
        ({**GOOD, "threshold": "abc", "mse_std": None}, "no number for threshold, mse_std"),
        ({"threshold": "abc", "mse_mean": 1}, "no number for threshold, percentile, mse_std"),
        ("{not json", "invalid JSON"),
        ("", "invalid JSON"),
        ([1, 2], "one JSON object, not a list"),
        ("3", "one JSON object, not a int"),
    ],
)
def test_bad_threshold_files(spark, tmp_path, content, words):
    with pytest.raises(ArtifactLoadError, match=words):
        artefacts.load_threshold(spark, put(tmp_path, content))


@given(st.sets(st.sampled_from(sorted(GOOD)), min_size=1))
@settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_every_missing_field_is_reported(spark, tmp_path, gone):
    content = {k: v for k, v in GOOD.items() if k not in gone}
    with pytest.raises(ArtifactLoadError) as error:
        artefacts.load_threshold(spark, put(tmp_path, content))
    assert all(k in str(error.value) for k in gone)


def test_absent_threshold(spark, tmp_path):
    with pytest.raises(ArtifactLoadError, match="not found"):
        artefacts.load_threshold(spark, str(tmp_path))
    with pytest.raises(InferenceError, match="not yet computed"):
        artefacts.save_threshold(spark, str(tmp_path), None)


FITTED = Preprocessor(
    (("c", ("a", "é", None)), ("d", ("x",))), (ColumnScale("n", 0.1 + 0.2, 2.0),)
)


def test_preprocessor_round_trip(spark, tmp_path):
    artefacts.save_preprocessor(spark, str(tmp_path), FITTED)
    assert artefacts.load_preprocessor(spark, str(tmp_path)) == FITTED
    plain = Preprocessor((), (ColumnScale("n", 1.0, 0.0),))
    artefacts.save_preprocessor(spark, f"{tmp_path}/b", plain)
    assert artefacts.load_preprocessor(spark, f"{tmp_path}/b") == plain


def test_preprocessor_errors(spark, tmp_path):
    with pytest.raises(ArtifactNotFoundError, match="encoder.*scaler|scaler.*encoder"):
        artefacts.load_preprocessor(spark, str(tmp_path))
    with pytest.raises(InferenceError):
        artefacts.save_preprocessor(spark, str(tmp_path), None)


def test_weights_round_trip(spark, tmp_path):
    layout = Layout(4, (3,), 2, "tanh", 0.1)
    model = Autoencoder(layout, layout.initial(1))
    artefacts.save_weights(spark, f"{tmp_path}/w", model)
    back = artefacts.load_weights(spark, f"{tmp_path}/w")
    assert back.layout == layout and np.array_equal(back.vector, model.vector)
    assert back.vector.dtype == np.float32
    with pytest.raises(InferenceError, match="stored input width 4, expected 5"):
        artefacts.load_weights(spark, f"{tmp_path}/w", Layout(5, (3,), 2))
    with pytest.raises(ArtifactNotFoundError):
        artefacts.load_weights(spark, f"{tmp_path}/none")
    with pytest.raises(InferenceError):
        artefacts.save_weights(spark, f"{tmp_path}/w", None)


def test_unwritable_destination(spark, tmp_path):
    blocker = tmp_path / "file"
    blocker.write_text("x")
    with pytest.raises(ArtifactWriteError, match="file"):
        artefacts.write_record(spark, f"{blocker}/metrics.json", {"a": 1})
    with pytest.raises(ArtifactWriteError):
        artefacts.new_run(spark, str(blocker))


@given(st.sets(st.sampled_from(artefacts.CRITICAL)))
@settings(
    max_examples=16, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_exactly_the_missing_artefacts_are_listed(spark, tmp_path_factory, gone):
    run = tmp_path_factory.mktemp("run")
    for name in set(artefacts.CRITICAL) - gone:
        (run / name).mkdir()
    if not gone:
        artefacts.check_artefacts(spark, str(run))
        return
    with pytest.raises(ArtifactNotFoundError) as error:
        artefacts.check_artefacts(spark, str(run))
    listed = str(error.value).split(": ")[1]
    assert {n for n in artefacts.CRITICAL if f"'{n}'" in listed} == gone


def test_run_folders(spark, tmp_path):
    base = f"{tmp_path}/runs"
    with pytest.raises(ArtifactNotFoundError, match="holds no finished run"):
        artefacts.latest_run(spark, base)
    first, second = artefacts.new_run(spark, base), artefacts.new_run(spark, base)
    assert first != second and Path(first).is_dir()
    name = Path(first).name
    assert len(name) == 22 and name[8] == name[15] == "_"


def test_latest_run_prefers_finished_ones(spark, tmp_path):
    with pytest.raises(ArtifactNotFoundError, match="holds no finished run"):
        artefacts.latest_run(spark, str(tmp_path))
    for name in ("20240101_000000", "20240201_000000", "20240301_000000", "20240401_000000"):
        (tmp_path / name).mkdir()
    with pytest.raises(ArtifactNotFoundError, match="holds no finished run"):
        artefacts.latest_run(spark, str(tmp_path))
    for name in ("20240101_000000", "20240201_000000"):
        (tmp_path / name / "manifest.json").mkdir()
        (tmp_path / name / "manifest.json" / "_SUCCESS").touch()
    # Died while writing the manifest; died after the weights.
    (tmp_path / "20240301_000000" / "manifest.json" / "_temporary").mkdir(parents=True)
    (tmp_path / "20240401_000000" / "weights").mkdir()
    (tmp_path / "20240401_000000" / "weights" / "_SUCCESS").touch()
    assert artefacts.latest_run(spark, str(tmp_path)).endswith("20240201_000000")


def test_timing_needs_metrics(spark, tmp_path):
    artefacts.record_timing(spark, str(tmp_path), 1.234)
    assert not (tmp_path / "metrics.json").exists()
    artefacts.write_record(spark, f"{tmp_path}/metrics.json", {"accuracy": 0.5})
    artefacts.record_timing(spark, str(tmp_path), 1.2345)
    stored = artefacts.read_record(spark, f"{tmp_path}/metrics.json", "metrics")
    assert stored == {"accuracy": 0.5, "training_time_secs": 1.23}


def test_scratch_tables_live_in_the_shared_folder(spark):
    scratch = Scratch(spark)
    assert scratch.path.startswith(spark.conf.get("spark.checkpoint.dir"))
    kept = scratch.keep(spark.range(5), "five")
    assert kept.count() == 5 and exists(spark, scratch.path)
    scratch.drop()
    assert not exists(spark, scratch.path)

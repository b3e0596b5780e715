"""Parameter ranges and profile invariants."""

import copy
import json
import math

import pytest
from samples import job
from hypothesis import given
from hypothesis import strategies as st

from oddrow import ConfigurationError, JobParams, Profile, get_profile, load_params
from oddrow.params import ArchitectureParams, SplitParams, TrainingParams
from oddrow.profiles import (
    CICIDS2017,
    NSL_KDD,
    NSL_KDD_RAW_HEADER,
    UNSW_NB15,
    profile_names,
    register_profile,
)


@pytest.mark.parametrize(
    ("profile", "categorical", "numeric"),
    [(NSL_KDD, 3, 38), (CICIDS2017, 0, 80), (UNSW_NB15, 3, 46)],
)
def test_profile_widths(profile, categorical, numeric):
    assert (len(profile.categorical), len(profile.numeric)) == (categorical, numeric)
    assert profile.feature_count == categorical + numeric
    assert len(profile.required) == profile.feature_count + 1 == len(set(profile.required))
    assert profile.label not in profile.features
    assert profile.label_map[profile.normal] == 0
    assert [f.name for f in profile.schema] == list(profile.required)


def test_label_maps():
    assert len(NSL_KDD.label_map) == 42
    assert sum(v == 0 for v in NSL_KDD.label_map.values()) == 1
    assert dict(CICIDS2017.label_map) == {"BENIGN": 0}
    assert dict(UNSW_NB15.label_map) == {0: 0, 1: 1}


def test_raw_header():
    assert len(NSL_KDD_RAW_HEADER) == 43
    assert NSL_KDD_RAW_HEADER[:4] == ("duration", "protocol_type", "service", "flag")
    assert NSL_KDD_RAW_HEADER[-2:] == ("label", "difficulty")
    assert set(NSL_KDD_RAW_HEADER[:-1]) == set(NSL_KDD.required)


def test_lookup_and_registry():
    assert get_profile("unsw_nb15") is UNSW_NB15
    with pytest.raises(ConfigurationError, match="nope"):
        get_profile("nope")
    mine = Profile("mine", "y", 0, (), ("a",), {0: 0})
    assert register_profile(mine) is mine and "mine" in profile_names()
    register_profile(mine)
    with pytest.raises(ConfigurationError):
        register_profile(Profile("mine", "y", 0, (), ("b",), {0: 0}))


@pytest.mark.parametrize(
    "broken",
    [
        {"numeric": ("a", "a")},
        {"numeric": ("y",)},
        {"numeric": ()},
        {"label_map": {1: 1}},
        {"label_map": {0: 0, 1: 2}},
    ],
)
def test_broken_profiles(broken):
    good = {
        "name": "p", "label": "y", "normal": 0, "categorical": (), "numeric": ("a",),
        "label_map": {0: 0},
    }
    with pytest.raises(ConfigurationError):
        Profile(**(good | broken))


def test_valid_parameters_round_trip():
    params = JobParams.from_mapping(job("x.csv", "runs"))
    assert JobParams.from_mapping(json.loads(json.dumps(params.to_mapping()))) == params
    assert params.splits.train_fraction == 0.7 / (0.7 + 0.1)


@given(st.sampled_from(["dataset", "splits", "architecture", "training", "threshold", "output"]))
def test_missing_section_is_named(section):
    raw = job("x.csv", "runs")
    del raw[section]
    with pytest.raises(ConfigurationError, match=section):
        JobParams.from_mapping(raw)


def test_missing_key_is_named():
    for section, values in job("x.csv", "runs").items():
        for key in values:
            raw = copy.deepcopy(job("x.csv", "runs"))
            del raw[section][key]
            with pytest.raises(ConfigurationError, match=f"{section}.{key}"):
                JobParams.from_mapping(raw)


@pytest.mark.parametrize(
    ("section", "key", "value"),
    [
        ("dataset", "path", " "),
        ("dataset", "path", 3),
        ("dataset", "schema", "iris"),
        ("splits", "train_ratio", 0.0),
        ("splits", "val_ratio", 1.0),
        ("splits", "test_ratio", 0.3),
        ("splits", "train_ratio", "0.7"),
        ("splits", "random_seed", 1.5),
        ("splits", "random_seed", True),
        ("architecture", "encoder_layers", []),
        ("architecture", "encoder_layers", [32, 0]),
        ("architecture", "encoder_layers", 32),
        ("architecture", "encoder_layers", [32, True]),
        ("architecture", "bottleneck_dim", 0),
        ("architecture", "bottleneck_dim", 16),
        ("architecture", "activation", ""),
        ("architecture", "activation", "warp"),
        ("architecture", "dropout_rate", 1.0),
        ("architecture", "dropout_rate", -0.1),
        ("training", "learning_rate", 0.0),
        ("training", "learning_rate", math.nan),
        ("training", "learning_rate", True),
        ("training", "batch_size", 0),
        ("training", "batch_size", True),
        ("training", "max_epochs", 0),
        ("training", "patience", 0),
        ("training", "lr_schedule", "warm"),
        ("training", "random_seed", "a"),
        ("training", "shards", 0),
        ("threshold", "percentile", 0),
        ("threshold", "percentile", 100),
        ("threshold", "percentile", 95.0),
        ("output", "artefact_dir", ""),
    ],
)
def test_out_of_range_values_are_named(section, key, value):
    raw = job("x.csv", "runs")
    raw[section][key] = value
    with pytest.raises(ConfigurationError, match=section):
        JobParams.from_mapping(raw)


@pytest.mark.parametrize(
    "ratios", [(0.0, 0.5, 0.5), (0.5, 0.0, 0.5), (0.5, 0.5, 0.0), (1.0, 0.0, 0.0), (1.2, 0.3, -0.5)]
)
def test_bad_ratios(ratios):
    with pytest.raises(ConfigurationError):
        SplitParams(*ratios)


def test_sections_check_themselves():
    with pytest.raises(ConfigurationError, match="bottleneck_dim"):
        ArchitectureParams((8, 4), 4)
    with pytest.raises(ConfigurationError, match="patience"):
        TrainingParams(patience=0)
    with pytest.raises(ConfigurationError):
        JobParams.from_mapping([1])
    with pytest.raises(ConfigurationError, match="splits"):
        JobParams.from_mapping(job("x", "y") | {"splits": 3})


def test_load_params_from_file(tmp_path):
    path = tmp_path / "job.yaml"
    path.write_text(json.dumps(job("x.csv", "runs")), encoding="utf-8")
    assert load_params(str(path)).dataset.path == "x.csv"

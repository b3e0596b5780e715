"""One-hot encoding and scaling."""

import math

import numpy as np
import pytest
from samples import CATEGORIES, connections
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oddrow import ConfigurationError, InferenceError, Profile
from oddrow.operators import features as FE
from oddrow.profiles import NSL_KDD


def encoded(fitted, rows):
    return np.array([r.features for r in fitted.transform(rows).select("features").collect()])


def test_layout_of_features(spark):
    table = connections(60, 20)
    rows = spark.createDataFrame(table)
    fitted = FE.fit_preprocessor(rows, NSL_KDD)
    assert dict(fitted.categories) == {c: tuple(sorted(v)) for c, v in CATEGORIES.items()}
    assert fitted.width == 3 + 7 + 7 + 38 == len(fitted.names)
    got = encoded(fitted, rows)
    assert got.shape == (80, 55)
    numbers = table[list(NSL_KDD.numeric)].to_numpy()
    scaled = (numbers - numbers.mean(0)) / numbers.std(0)
    assert np.allclose(got[:, 17:], scaled, atol=1e-12)
    assert np.allclose(got[:, 17:].mean(0), 0, atol=0.01)
    assert np.allclose(got[:, 17:].std(0), 1, atol=0.01)
    at = 0
    for c in NSL_KDD.categorical:
        options = sorted(CATEGORIES[c])
        block = np.array([[float(v == o) for o in options] for v in table[c]])
        assert np.array_equal(got[:, at : at + len(options)], block)
        at += len(options)


def test_array_type_and_codegen(spark):
    rows = spark.createDataFrame(connections(20, 5)).repartition(2)
    out = FE.fit_preprocessor(rows, NSL_KDD).transform(rows)
    assert out.schema["features"].dataType.simpleString() == "array<double>"


@given(st.sampled_from(["GRE", "AH", "ESP", "IPV6", None, ""]))
@settings(max_examples=6, deadline=None)
def test_unseen_category_is_a_zero_block(spark, value):
    rows = spark.createDataFrame(connections(40, 5))
    fitted = FE.fit_preprocessor(rows, NSL_KDD)
    one = rows.limit(1).withColumn("protocol_type", F.lit(value).cast("string"))
    got = encoded(fitted, one)[0]
    assert not got[:3].any() and got[3:10].sum() == 1 and got[10:17].sum() == 1


SMALL = Profile("small_cats", "y", 0, ("c", "d"), ("x",), {0: 0})


def test_missing_category_seen_in_training_has_its_own_slot(spark):
    rows = spark.createDataFrame(
        [("b", "k", 1.0), (None, "k", 2.0), ("a", "k", 6.0)], "c string, d string, x double"
    )
    fitted = FE.fit_preprocessor(rows, SMALL)
    assert dict(fitted.categories) == {"c": ("a", "b", None), "d": ("k",)}
    assert encoded(fitted, rows)[:, :4].tolist() == [[0, 1, 0, 1], [0, 0, 1, 1], [1, 0, 0, 1]]


def test_categories_sort_by_code_point(spark):
    rows = spark.createDataFrame([(c, "k", 1.0) for c in "aZé1"], "c string, d string, x double")
    assert dict(FE.fit_preprocessor(rows, SMALL).categories)["c"] == ("1", "Z", "a", "é")


NUMBERS = Profile("numbers_only", "y", 0, (), ("x", "k"), {0: 0})


def test_constant_column_is_only_centred(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "x double, k double")
    fitted = FE.fit_preprocessor(rows, NUMBERS)
    new = spark.createDataFrame([(4.0, 9.0)], "x double, k double")
    got = encoded(fitted, new)[0]
    assert got[1] == 4.0
    assert math.isclose(got[0], (4 - 7 / 3) / np.std([1, 2, 4]))


def test_rounding_noise_is_constant_but_small_spreads_are_not():
    assert FE.scale_of(0.1, 1e-17) == 1.0
    assert FE.scale_of(0.0, 0.0) == 1.0
    assert FE.scale_of(1.4e9, 2.0) == 2.0
    assert FE.scale_of(0.0, 1e-9) == 1e-9


def test_missing_numbers_do_not_count(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 3.0)], "x double, k double")
    fitted = FE.fit_preprocessor(rows, NUMBERS)
    assert (fitted.scales[0].mean, fitted.scales[0].std) == (2.0, 1.0)


def test_fit_errors(spark):
    empty = spark.createDataFrame([], "x double, k double")
    with pytest.raises(InferenceError, match="zero rows"):
        FE.fit_preprocessor(empty, NUMBERS)
    blank = spark.createDataFrame([(None, 1.0)], "x double, k double")
    with pytest.raises(InferenceError, match="'x'"):
        FE.fit_preprocessor(blank, NUMBERS)
    fitted = FE.fit_preprocessor(spark.createDataFrame([(1.0, 2.0)], "x double, k double"), NUMBERS)
    with pytest.raises(InferenceError, match="'k'"):
        fitted.transform(spark.createDataFrame([(1.0,)], "x double"))


def test_too_many_categories(spark):
    rows = spark.range(30).selectExpr("cast(id as string) c", "'k' d", "1.0D x")
    with pytest.raises(ConfigurationError, match=r"more than 10 categories: {'c': 30}"):
        FE.fit_preprocessor(rows, SMALL, max_categories=10)
    assert FE.fit_preprocessor(rows, SMALL, max_categories=30).width == 32


def test_fitted_state_is_a_projection(spark):
    rows = spark.createDataFrame(connections(20, 5))
    out = FE.fit_preprocessor(rows, NSL_KDD).transform(rows).select("features")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan

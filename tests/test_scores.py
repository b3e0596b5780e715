"""Threshold, flags and metrics against brute force."""

import math
import warnings

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oddrow import InferenceError
from oddrow.functions.scores import anomaly_flag
from oddrow.operators import metrics as M
from oddrow.operators.threshold import exact_percentile, fit_threshold, kth_smallest
from oddrow.plans import jobs


def frame(spark, scores, y=None, prediction=None):
    data = {"mse": np.asarray(scores, float)}
    if y is not None:
        data["y"] = np.asarray(y, np.int32)
    if prediction is not None:
        data["prediction"] = np.asarray(prediction, np.int32)
    return spark.createDataFrame(pd.DataFrame(data))


# -- threshold -------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("scores", "p"),
    [
        ([0.1, 0.2, 0.3, 0.4, 1.0, 2.0, 3.0], 95),
        ([1.0, 2.0, 3.0, 4.0, 5.0], 90),
        (list(range(1, 101)), 1),
        (list(range(1, 101)), 99),
        ([2.5], 50),
    ],
)
def test_threshold_matches_numpy(spark, scores, p):
    found = fit_threshold(frame(spark, scores), p)
    assert math.isclose(found.threshold, np.percentile(scores, p), abs_tol=1e-9)
    assert math.isclose(found.mse_mean, np.mean(scores), abs_tol=1e-9)
    assert math.isclose(found.mse_std, np.std(scores), abs_tol=1e-9)
    assert fit_threshold(frame(spark, scores), p) == found


@given(
    st.lists(st.floats(0, 1e6) | st.sampled_from([1.0, 2.0]), min_size=1, max_size=200),
    st.integers(1, 99),
)
@settings(max_examples=10, deadline=None)
def test_search_matches_numpy(spark, scores, p):
    got = exact_percentile(frame(spark, scores), F.col("mse"), p, fetch_rows=3)
    assert math.isclose(got, np.percentile(scores, p), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize(
    "column",
    [
        "cast(id as double)",
        "cast(id % 3 as double)",  # heavy ties everywhere
        "case when id % 3 = 0 then 5.0D else cast(id as double) end",
        "case when id < 3000 then 0.0D when id > 6000 then 1.0D else id / 1e4D end",
        "exp(rand(1) * 200)",  # a very long tail
        "case when id < 8999 then 1.0D else 1e300D end",
    ],
)
@pytest.mark.parametrize("p", [1, 50, 95])
def test_search_on_awkward_distributions(spark, column, p):
    rows = spark.range(9_000).selectExpr(f"{column} AS mse")
    values = np.array([r.mse for r in rows.collect()])
    got = exact_percentile(rows, F.col("mse"), p, fetch_rows=20)
    assert math.isclose(got, np.percentile(values, p), rel_tol=1e-12)


def test_kth_smallest(spark):
    values = spark.range(5_000).selectExpr("cast(hash(id) % 700 as double) AS x").cache()
    expected = sorted(r.x for r in values.collect())
    for k in (0, 1, 2_500, 4_998, 4_999):
        assert kth_smallest(values, k, 5_000, fetch_rows=5) == expected[k]


def test_search_with_a_working_sample(spark):
    """Sizes at which the sample gives true intervals, several rounds deep."""
    values = spark.range(200_000).selectExpr("exp(rand(3) * 20) AS x").cache()
    expected = np.sort(values.toPandas()["x"].to_numpy())
    for k in (0, 17, 100_000, 190_000, 199_999):
        assert kth_smallest(values, k, 200_000, fetch_rows=2_000) == expected[k]


def test_missing_scores_are_left_out(spark):
    rows = frame(spark, [1.0, math.nan, 3.0])
    assert fit_threshold(rows, 50).threshold == 2.0
    with pytest.raises(InferenceError, match="not computed"):
        fit_threshold(rows.filter("false"), 95)
    assert exact_percentile(rows.filter("false"), F.col("mse"), 50) is None


def test_flag_is_inclusive_and_ignores_nan(spark):
    rows = spark.createDataFrame([(0.9,), (1.0,), (1.1,), (math.nan,), (None,)], "mse double")
    assert [r[0] for r in rows.select(anomaly_flag(F.col("mse"), 1.0)).collect()] == [0, 1, 1, 0, 0]
    assert [r[0] for r in rows.select(anomaly_flag(F.col("mse"), F.lit(1.1))).collect()] == [
        0, 0, 1, 0, 0,
    ]


# -- confusion matrix and rates --------------------------------------------------------


def brute_metrics(y, p):
    out = {}
    for c, name in ((0, "normal"), (1, "anomalous")):
        hit = sum(a == c and b == c for a, b in zip(y, p, strict=True))
        said, real = sum(b == c for b in p), sum(a == c for a in y)
        out[f"precision_{name}"] = hit / said if said else 0.0
        out[f"recall_{name}"] = hit / real if real else 0.0
        total = said + real
        out[f"f1_{name}"] = 2 * hit / total if total else 0.0
    out["accuracy"] = sum(a == b for a, b in zip(y, p, strict=True)) / len(y)
    return out


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=1, max_size=40))
@settings(max_examples=8, deadline=None)
def test_rates_match_brute_force(spark, pairs):
    y, p = zip(*pairs, strict=True)
    got = M.classification_metrics(frame(spark, [0.0] * len(y), y, p)).first().asDict()
    expected = brute_metrics(y, p)
    assert set(got) == set(expected) == set(M.METRIC_NAMES)
    assert all(math.isclose(got[k], expected[k], abs_tol=1e-12) for k in expected)
    assert all(0.0 <= v <= 1.0 for v in got.values())


def test_confusion_matrix_keeps_empty_cells(spark):
    rows = frame(spark, [0, 0, 0], [0, 0, 0], [0, 0, 1])
    assert [tuple(r) for r in M.confusion_matrix(rows).collect()] == [
        (0, 0, 2), (0, 1, 1), (1, 0, 0), (1, 1, 0),
    ]


def test_all_correct(spark):
    got = M.classification_metrics(frame(spark, [0] * 4, [0, 0, 1, 1], [0, 0, 1, 1])).first()
    assert set(got) == {1.0}


# -- ROC and AUC -----------------------------------------------------------------------


def brute_auc(y, s):
    pos = [b for a, b in zip(y, s, strict=True) if a == 1]
    neg = [b for a, b in zip(y, s, strict=True) if a == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def brute_roc(y, s, drop):
    y, s = np.asarray(y), np.asarray(s, float)
    points = []
    for t in sorted(set(s), reverse=True):
        points.append((t, int(((s >= t) & (y == 0)).sum()), int(((s >= t) & (y == 1)).sum())))
    if drop and len(points) > 2:
        fps, tps = np.array([p[1] for p in points]), np.array([p[2] for p in points])
        bend = (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0)
        points = [p for p, keep in zip(points, [True, *bend, True], strict=True) if keep]
    n, p = int((y == 0).sum()), int((y == 1).sum())
    return [(math.inf, 0.0, 0.0)] + [(t, f / n, h / p) for t, f, h in points]


def test_auc_of_separable_scores(spark):
    rows = frame(spark, [0.1, 0.2, 0.3, 5, 6, 7], [0, 0, 0, 1, 1, 1])
    assert M.rank_scores(rows).auc() == 1.0


def test_auc_with_ties(spark):
    y, s = [0, 1, 0, 1, 0, 1], [1.0, 1.0, 1.0, 2.0, 2.0, 3.0]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert M.rank_scores(frame(spark, s, y)).auc() == brute_auc(y, s) == 6.5 / 9


def test_low_auc_warns(spark):
    rows = frame(spark, [9, 8, 7, 0.1, 0.2, 0.3], [0, 0, 0, 1, 1, 1])
    with pytest.warns(UserWarning, match="below 0.80"):
        assert M.rank_scores(rows).auc() == 0.0
    with pytest.warns(UserWarning):
        assert tuple(M.auc_roc(rows).first()) == (0.0, True)


def test_one_class_has_no_auc(spark):
    rows = frame(spark, [1.0, 2.0], [0, 0])
    assert tuple(M.auc_roc(rows).first()) == (None, None)
    assert [(r.threshold, r.fpr, r.tpr) for r in M.roc_curve(rows).collect()] == [
        (math.inf, 0.0, None), (2.0, 0.5, None), (1.0, 1.0, None),
    ]


def assert_points(got, expected):
    assert len(got) == len(expected)
    assert np.allclose(np.array(got), np.array(expected))


SCORES = st.lists(
    st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.5, 0.9, 1.5]) | st.floats(0, 2)),
    min_size=2, max_size=60,
).filter(lambda rows: len({y for y, _ in rows}) == 2)


@given(SCORES, st.sampled_from([7, None]), st.booleans())
@settings(max_examples=12, deadline=None)
@pytest.mark.filterwarnings("ignore:low AUC")
def test_roc_matches_brute_force(spark, rows, ranges, drop):
    y, s = zip(*rows, strict=True)
    ranked = M.rank_scores(frame(spark, s, y), ranges)
    assert math.isclose(ranked.auc(), brute_auc(y, s), abs_tol=1e-12)
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in ranked.curve(drop).collect()), reverse=True)
    assert_points(got, brute_roc(y, s, drop))


@pytest.mark.filterwarnings("ignore:low AUC")
def test_one_score_on_a_third_of_the_rows(spark):
    rows = spark.range(6_000).selectExpr(
        "cast(hash(id) % 2 = 0 as int) AS y",
        "case when id % 3 = 0 then 100.0D else cast(hash(id, 1) % 1000 as double) end AS mse",
    )
    local = rows.toPandas()
    ranked = M.rank_scores(rows, ranges=12)
    assert len(ranked.ranges) > 3
    assert math.isclose(ranked.auc(), brute_auc(local["y"], local["mse"]), abs_tol=1e-12)
    got = sorted(((r.threshold, r.fpr, r.tpr) for r in ranked.curve().collect()), reverse=True)
    assert_points(got, brute_roc(local["y"], local["mse"], True))


def test_no_user_function_ranks_scores(spark):
    rows = frame(spark, [float(i) for i in range(50)], [i % 2 for i in range(50)])
    ranked = M.rank_scores(rows, ranges=4)
    assert len(ranked.ranges) == 4
    for made in (ranked.groups, ranked.curve()):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "UDF" not in plan and "Window" not in plan and "Exchange hash" not in plan


@pytest.mark.filterwarnings("ignore:low AUC")
def test_evaluation_reads_the_scores_twice(spark, tmp_path):
    """Every read of the rows passes through a function that counts them."""
    seen, n = spark.sparkContext.accumulator(0), 400
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, n), rng.random(n).round(2)
    flags = (s > 0.9).astype(int)
    plain = spark.createDataFrame(
        [(int(a), float(b), int(c)) for a, b, c in zip(y, s, flags)],
        "y int, mse double, prediction int",
    )

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = plain.mapInArrow(counted, plain.schema)
    found = jobs.evaluate(spark, rows, str(tmp_path))
    assert seen.value == 2 * n
    assert math.isclose(found["auc_roc"], brute_auc(y.tolist(), s.tolist()), abs_tol=1e-12)
    bins = spark.read.parquet(f"{tmp_path}/re_histogram")
    direct = M.error_histogram(plain)
    key = lambda r: (r.label, r.bin)
    assert sorted(bins.collect(), key=key) == sorted(direct.collect(), key=key)


# -- histogram -------------------------------------------------------------------------


def check_histogram(spark, y, s):
    got = M.error_histogram(frame(spark, s, y)).collect()
    for label in (0, 1):
        scores = np.array([b for a, b in zip(y, s, strict=True) if a == label])
        mine = sorted((r for r in got if r.label == label), key=lambda r: r.bin)
        if not len(scores):
            assert not mine
            continue
        counts, edges = np.histogram(scores, bins=30)
        assert [r.records for r in mine] == counts.tolist()
        assert np.allclose([r.lower for r in mine] + [mine[-1].upper], edges)


@given(st.lists(st.tuples(st.integers(0, 1), st.floats(0, 10)), min_size=1, max_size=80))
@settings(max_examples=12, deadline=None)
def test_histogram_matches_numpy(spark, rows):
    y, s = zip(*rows, strict=True)
    spans = [b - a for a, b in ((min(v), max(v)) for v in
             ([q for p, q in rows if p == c] or [0] for c in (0, 1)))]
    if all(w == 0 or w > 1e-9 for w in spans):
        check_histogram(spark, y, s)


def test_histogram_of_equal_scores_and_edges(spark):
    check_histogram(spark, [0] * 5 + [1] * 31, [2.0] * 5 + [i / 10 for i in range(31)])
    check_histogram(spark, [1, 1], [0.0, 3.0])


def test_histogram_without_scores(spark):
    rows = frame(spark, [math.nan], [0])
    assert M.error_histogram(rows).count() == 0


def test_histogram_counts_infinite_scores_apart(spark):
    scores = [1.0, 2.0, math.inf, 5.0, -math.inf, math.nan, None]
    rows = M.error_histogram(frame(spark, scores, [0, 0, 0, 1, 1, 1, 1]), bins=2).collect()
    got = {(r.label, r.bin): (r.lower, r.upper, r.records) for r in rows}
    assert got == {
        (0, 0): (1.0, 1.5, 1), (0, 1): (1.5, 2.0, 1), (0, 2): (math.inf, math.inf, 1),
        (1, 0): (4.5, 5.0, 0), (1, 1): (5.0, 5.5, 1), (1, -1): (-math.inf, -math.inf, 1),
    }
    only = M.error_histogram(frame(spark, [math.inf, math.inf], [0, 0])).collect()
    assert [(r.bin, r.records) for r in only] == [(M.HISTOGRAM_BINS, 2)]

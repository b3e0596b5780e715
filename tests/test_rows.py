"""Duplicates, labels, class counts, the quality gate, split and sample."""

import hashlib

import pandas as pd
import pytest
from samples import connections
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oddrow import DataLoadError, SchemaValidationError
from oddrow.functions.labels import binary_label, is_attack, is_normal
from oddrow.operators import selection as S
from oddrow.operators.dedup import COPIES, dedup, dedup_counts, dedup_report, dedup_stored
from oddrow.operators.quality import Quality, class_counts, distinct_labels
from oddrow.profiles import NSL_KDD, UNSW_NB15


def test_dedup_removes_copies_and_reports(spark):
    table = connections(10, 0)
    rows = spark.createDataFrame(pd.concat([table, table.head(5)]))
    kept = dedup(rows, NSL_KDD.required)
    assert kept.count() == 10
    assert dedup_report(kept).first().asDict() == {
        "rows_before": 15, "rows_removed": 5, "rows_after": 10,
    }
    assert dedup_counts(rows, NSL_KDD.required).first() == dedup_report(kept).first()
    again = dedup(kept.drop(COPIES), NSL_KDD.required)
    assert again.count() == 10 and dedup_report(again).first()["rows_removed"] == 0


def test_dedup_keeps_the_first_by_order(spark):
    rows = spark.createDataFrame(
        [("a", 1.0, 3, "z"), ("a", 1.0, 2, "y"), ("a", 1.0, 2, "x"), ("b", None, 9, "w"),
         ("b", None, 8, "v")],
        "c string, x double, id int, extra string",
    )
    kept = dedup(rows, ["c", "x"], ["id"])
    assert kept.columns == ["c", "x", "id", "extra", COPIES]
    assert {tuple(r) for r in kept.collect()} == {("a", 1.0, 2, "x", 3), ("b", None, 8, "v", 2)}


def test_dedup_joins_signed_zeros(spark):
    rows = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "x double, id int")
    assert [tuple(r) for r in dedup(rows, ["x"], ["id"]).collect()] == [(0.0, 1, 2)]


def test_dedup_aggregates_copies_before_the_shuffle(spark):
    # A third of the rows are one row: the map side must collapse it.
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id"
    )
    kept = dedup(rows, ["k"], ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")
    assert kept.filter("k = -1").first()[COPIES] == 10_000
    assert kept.count() == 20_001


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_dedup_picks_only_among_copies(spark, scratch):
    rows = spark.createDataFrame(
        [("a", 0.0, 3, 1), ("a", -0.0, 2, 9), ("a", 0.0, 2, 8), ("b", None, 9, 1),
         ("b", None, 8, 2), ("c", 1.0, 5, 5), (None, 1.0, 5, 5)],
        "c string, x double, id int, n int",
    )
    extra = {"twice": F.col("id") * 2}
    kept = dedup_stored(rows, ["c", "x"], ["id"], scratch, extra)
    assert kept.columns == ["c", "x", "id", "n", COPIES, "twice"]
    found = {tuple(r) for r in kept.collect()}
    # Least columns of a key taken alone would make the row ("a", 0.0, 2, 1), which is none.
    assert found == {
        ("a", 0.0, 2, 8, 3, 4), ("b", None, 8, 2, 2, 16), ("c", 1.0, 5, 5, 1, 10),
        (None, 1.0, 5, 5, 1, 10),
    }
    plain = dedup(rows, ["c", "x"], ["id"]).withColumns(extra)
    assert found == {tuple(r) for r in plain.select(kept.columns).collect()}


def test_stored_dedup_sorts_nothing(spark, scratch, monkeypatch):
    plans = []
    keep = type(scratch).keep
    monkeypatch.setattr(
        type(scratch), "keep", lambda self, df, name: plans.append(explained(df)) or keep(self, df, name)
    )
    rows = spark.range(1_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("id"))
    kept = dedup_stored(rows, ["k"], ["id"], scratch)
    assert kept.count() == 1_000 and len(plans) == 1
    assert "HashAggregate" in plans[0] and "Sort" not in plans[0]


def test_stored_dedup_with_texts_takes_one_stage(spark, scratch):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "k int, text string")
    kept = dedup_stored(rows, ["k"], [], scratch)
    assert {tuple(r) for r in kept.collect()} == {(1, "a", 2), (2, "c", 1)}


def test_a_small_sample_is_one_scan(spark):
    rows = spark.range(5_000).withColumn("x", F.col("id") % 7)
    plan = explained(S.sample_rows(rows, 50, 42, ["id"]))
    assert "TakeOrdered" in plan and "Exchange" not in plan and plan.count("Range (") == 1


@pytest.mark.parametrize("n", [0, 50, 1_001])
def test_small_and_large_samples_agree(spark, monkeypatch, n):
    rows = spark.range(1_500).withColumn("x", F.col("id") % 7)
    chosen = []
    for most in (0, 10_000):
        monkeypatch.setattr(S, "HEAP_ROWS", most)
        chosen.append({tuple(r) for r in S.sample_rows(rows, n, 42, ["id"]).collect()})
    assert chosen[0] == chosen[1] and len(chosen[0]) == n


LABELS = [("normal",), ("neptune",), ("brand_new",), (None,)]


def test_unknown_and_missing_labels_are_attacks(spark):
    rows = spark.createDataFrame(LABELS, "label string")
    assert [r[0] for r in rows.select(binary_label(NSL_KDD)).collect()] == [0, 1, 1, 1]
    assert [r[0] for r in rows.select(is_normal(NSL_KDD)).collect()] == [True, False, False, False]
    assert rows.filter(is_attack(NSL_KDD)).count() == 3
    numbers = spark.createDataFrame([(0,), (1,), (7,), (None,)], "label int")
    assert [r[0] for r in numbers.select(binary_label(UNSW_NB15)).collect()] == [0, 1, 1, 1]


def test_counts_add_up(spark):
    labels = [("normal",)] * 80 + [("neptune",)] * 19 + [(None,)]
    rows = spark.createDataFrame(labels, "label string")
    assert tuple(class_counts(rows, NSL_KDD).first()) == (100, 80, 20)
    assert {tuple(r) for r in distinct_labels(rows, NSL_KDD).collect()} == {
        ("normal", 80), ("neptune", 19), (None, 1),
    }


@pytest.mark.parametrize(
    ("change", "error", "words"),
    [
        (lambda t: t.head(0), DataLoadError, "empty"),
        (lambda t: t.assign(label=[None, *t["label"][1:]]), SchemaValidationError, "label column"),
        (lambda t: t.assign(label="normal"), SchemaValidationError, "normal and attack"),
        (lambda t: t.assign(label="neptune"), SchemaValidationError, "normal and attack"),
        (lambda t: t.assign(flag=[None, *t["flag"][1:]]), SchemaValidationError, "flag"),
    ],
)
def test_gate_on_prepared_data(spark, change, error, words):
    rows = spark.createDataFrame(change(connections(6, 4)), _schema())
    with pytest.raises(error, match=words):
        Quality.of(rows, NSL_KDD).check_prepared("data")


def _schema():
    columns = [*NSL_KDD.numeric, *NSL_KDD.categorical, "label"]
    return ", ".join(f"{c} {'double' if c in NSL_KDD.numeric else 'string'}" for c in columns)


def test_gate_passes_clean_data(spark):
    quality = Quality.of(spark.createDataFrame(connections(6, 4), _schema()), NSL_KDD)
    quality.check_prepared("data")
    assert (quality.total, quality.normal, quality.attack) == (10, 6, 4)


def _order(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}|{i}".encode()).hexdigest())


@given(
    st.integers(1, 400), st.integers(0, 450), st.integers(0, 5), st.sampled_from([1, 20, 10_000])
)
@settings(max_examples=12, deadline=None)
def test_cut_equals_sorting(spark, n, k, seed, fetch):
    rows = spark.range(n)
    cut = S.find_cut(rows, S.row_ranks(rows, seed, ["id"]), lambda _: k, fetch_rows=fetch)
    chosen = {r.id for r in rows.filter(cut.chosen).collect()}
    assert cut.tie is None and chosen == set(_order(range(n), seed)[:k])
    assert (cut.total, cut.taken) == (n, min(n, k))


def test_split_sizes_and_order(spark):
    rows = spark.range(550).withColumn("normal", F.col("id") < 500)
    split = S.split_normal(rows, F.col("normal"), 0.7 / (0.7 + 0.1), 42, ["id"])
    assert (split.n_train, split.n_val) == (437, 63)
    found = {r.id: r.split for r in split.rows.collect()}
    ordered = _order(range(500), 42)
    assert {i for i in found if found[i] == "train"} == set(ordered[:437])
    assert {i for i in found if found[i] == "val"} == set(ordered[437:])
    assert {i for i in found if found[i] == "attack"} == set(range(500, 550))
    again = S.split_normal(rows.repartition(7), F.col("normal"), 0.7 / (0.7 + 0.1), 42, ["id"])
    assert {r.id: r.split for r in again.rows.collect()} == found


@given(st.floats(0.1, 0.8), st.floats(0.1, 0.8))
@settings(max_examples=8, deadline=None)
def test_split_sizes_are_in_proportion(spark, train, val):
    split = S.split_normal(spark.range(500), F.lit(True), train / (train + val), 1, ["id"])
    target = round(500 * train / (train + val))
    assert abs(split.n_train - target) <= 1 and split.n_train + split.n_val == 500


@pytest.mark.parametrize("n", [0, 1])
def test_split_needs_two_normal_rows(spark, n):
    with pytest.raises(DataLoadError, match="at least 2"):
        S.split_normal(spark.range(n), F.lit(True), 0.875, 42, ["id"])


def test_split_may_not_be_empty(spark):
    with pytest.raises(DataLoadError, match="empty"):
        S.split_normal(spark.range(3), F.lit(True), 0.2, 42, ["id"])


def test_one_key_on_a_third_of_the_rows(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("key"), "id"
    )
    for k in (1, 500, 1_400, 2_999):
        cut = S.find_cut(rows, S.row_ranks(rows, 3, ["key"]), lambda _, k=k: k, fetch_rows=50)
        assert rows.filter(cut.chosen).count() == k


@pytest.mark.parametrize("k", [0, 1, 333, 999, 1_000, 2_000])
def test_identical_rows_still_give_exact_sizes(spark, k):
    rows = spark.range(1_500).select(
        F.when(F.col("id") < 1_000, 0).otherwise(F.col("id")).alias("x"), F.lit("a").alias("y")
    )
    sample = S.sample_rows(rows, k, 5)
    assert sample.count() == min(k, 1_500)
    everything = rows.groupBy("x").count().collect()
    allowed = {r.x: r["count"] for r in everything}
    assert all(r["count"] <= allowed[r.x] for r in sample.groupBy("x").count().collect())


def test_identical_rows_split_exactly(spark, monkeypatch):
    monkeypatch.setattr(S, "REPLICA_CHUNK", 100)
    rows = spark.range(1_010).select((F.col("id") < 1_000).alias("normal"), F.lit(1.5).alias("x"))
    split = S.split_normal(rows, F.col("normal"), 0.875, 42)
    counts = {r["split"]: r["count"] for r in split.rows.groupBy("split").count().collect()}
    assert counts == {"train": 875, "val": 125, "attack": 10}


def test_sample_size(spark):
    rows = spark.range(100)
    assert S.sample_rows(rows, 500, 42, ["id"]).count() == 100
    chosen = {r.id for r in S.sample_rows(rows, 10, 42, ["id"]).collect()}
    assert chosen == set(_order(range(100), 42)[:10])


def test_ranking_shuffles_no_rows(spark):
    rows = spark.range(1_000)
    split = S.split_normal(rows, F.lit(True), 0.5, 1, ["id"])
    assert "Exchange" not in split.rows._jdf.queryExecution().executedPlan().toString()


def test_stored_rank_gives_the_same_split(spark):
    rows = spark.range(400).withColumn("x", F.col("id") * 2)
    plain = S.split_normal(rows, F.lit(True), 0.6, 9, ["id"]).rows
    stored = S.split_normal(S.with_rank(rows, 9, ["id"]), F.lit(True), 0.6, 9).rows
    assert {(r.id, r.split) for r in plain.collect()} == {(r.id, r.split) for r in stored.collect()}



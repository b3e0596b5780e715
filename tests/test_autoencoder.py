"""Scoring and training as Spark jobs, against the same work done in plain NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddrow import ConfigurationError, DataLoadError, InferenceError
from oddrow.operators import autoencoder as A
from oddrow.operators import network as N
from oddrow.operators.network import Layout, TrainState
from oddrow.params import ArchitectureParams, TrainingParams
from oddrow.sources.storage import Scratch

LAYOUT = Layout(6, (5, 4), 2, "relu", 0.0)


def table(spark, n=300, n_val=60, width=6, seed=0, partitions=3):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, width)).astype("float32").astype(float)
    rows = [(i, values[i].tolist(), i >= n_val) for i in range(n)]
    schema = "id bigint, features array<double>, is_train boolean"
    return spark.createDataFrame(rows, schema).repartition(partitions), values


def shards_of(spark, count=1, round_rows=100_000, rows=None, seed=1, **options):
    rows = table(spark, **options)[0] if rows is None else rows
    return A.make_shards(
        rows, F.col("is_train"), ["id"], count, seed, Scratch(spark), round_rows=round_rows
    )


def rows_by_shard(shards):
    """{(round, shard): (features, is_train)} in the order of the files."""
    found = {}
    for r in shards.table.collect():
        found.setdefault((r.round, r.shard), []).append((r.features, r.is_train))
    return found


def params(**changes):
    return TrainingParams(
        **({"batch_size": 32, "max_epochs": 3, "patience": 5, "random_seed": 4} | changes)
    )


def random_model(layout=LAYOUT, seed=3):
    rng = np.random.default_rng(seed)
    vector = layout.initial(seed) + rng.normal(scale=0.05, size=layout.size).astype(layout.dtype)
    return A.Autoencoder(layout, vector.astype(layout.dtype))


def test_scores_equal_plain_numpy(spark):
    rows, values = table(spark)
    model = random_model()
    x = values.astype("float32")
    expected = N.row_errors(x, N.Forward(LAYOUT, model.vector)(x))
    got = {r.id: r.mse for r in model.score(rows).select("id", "mse").collect()}
    assert len(got) == len(values)
    assert np.allclose([got[i] for i in range(len(values))], expected, rtol=1e-5)
    assert min(got.values()) >= 0


def test_reconstruction(spark):
    rows, values = table(spark, n=20)
    model = random_model()
    out = model.reconstruct(rows).collect()
    expected = N.Forward(LAYOUT, model.vector)(values.astype("float32"))
    for r in out:
        assert np.allclose(r.reconstruction, expected[r.id], atol=1e-5)
        assert math.isclose(r.mse, np.mean((values[r.id] - expected[r.id]) ** 2), rel_tol=1e-4)


def test_predictions_follow_the_threshold(spark):
    rows, _ = table(spark)
    scored = random_model().predict(rows, 1.1).collect()
    assert {r.prediction for r in scored} == {0, 1}
    assert all(r.prediction == int(r.mse >= 1.1) for r in scored)


def test_width_errors_name_both_widths(spark):
    rows, _ = table(spark, width=4)
    with pytest.raises(Exception, match="expected 6 features but got 4"):
        random_model().score(rows).collect()


def test_missing_features(spark):
    with pytest.raises(InferenceError, match="features"):
        random_model().score(spark.range(3))
    rows = spark.createDataFrame([([1.0] * 6,), (None,)], "features array<double>")
    first, second = (r.mse for r in random_model().score(rows).collect())
    assert first >= 0 and math.isnan(second)
    rows = spark.createDataFrame([([1.0] * 5 + [None],)], "features array<double>")
    assert math.isnan(random_model().score(rows).first().mse)


def test_scoring_is_map_only(spark):
    rows, _ = table(spark)
    before = rows._jdf.queryExecution().executedPlan().toString().count("Exchange")
    plan = random_model().predict(rows, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == before


def test_shards_have_fixed_places(spark):
    rows, _ = table(spark)
    first = shards_of(spark, 4, rows=rows)
    second = shards_of(spark, 4, rows=rows.repartition(9))
    assert (first.count, first.rounds) == (4, 1)
    assert rows_by_shard(first) == rows_by_shard(second)
    assert set(rows_by_shard(first)) == {(r, s) for r in (-1, 0) for s in range(4)}
    assert rows_by_shard(first) != rows_by_shard(shards_of(spark, 4, rows=rows, seed=2))


def test_rounds_are_files_that_a_pass_reads_alone(spark):
    shards = shards_of(spark, 2, round_rows=20)
    assert shards.rounds == 6
    held = rows_by_shard(shards)
    assert sum(len(v) for (r, _), v in held.items() if r >= 0) == 240
    assert all(t == (r >= 0) for (r, _), v in held.items() for _, t in v)
    assert all(5 <= len(v) <= 40 for (r, _), v in held.items() if r >= 0)
    files = shards.table.inputFiles()
    assert len(files) == len(held)
    plan = shards.round(3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(round" in plan or "PartitionFilters: [(round" in plan
    assert "features" in plan and "Exchange" not in plan
    assert len(shards.round(3).collect()) == len(held[3, 0]) + len(held[3, 1])


def sequential(shards, hyper, epochs):
    """The same training without Spark: one replica, row blocks as the shard gives them."""
    shard = [row for rows in rows_by_shard(shards).values() for row in rows]
    x = np.array([features for features, _ in shard], "float32")
    train = np.array([is_train for _, is_train in shard])
    state = TrainState.fresh(LAYOUT, hyper.random_seed)
    history = []
    for epoch in range(epochs):
        rng = np.random.default_rng([hyper.random_seed, epoch, 0, 0])
        rows = x[train]
        rows = rows[rng.permutation(len(rows))]
        losses = []
        for at in range(0, len(rows), hyper.batch_size):
            batch = rows[at : at + hyper.batch_size]
            loss = N.train_step(
                LAYOUT, state, batch, rng, hyper.learning_rate, hyper.lr_schedule
            )
            losses.append(loss * len(batch))
        rebuilt = N.Forward(LAYOUT, state.vector)(x[~train])
        history.append((sum(losses) / len(rows), N.row_errors(x[~train], rebuilt).mean()))
    return state, history


@pytest.mark.parametrize("schedule", ["none", "step_decay", "cosine_annealing"])
def test_one_shard_is_sequential_training(spark, schedule):
    shards = shards_of(spark)
    hyper = params(lr_schedule=schedule)
    result = A.train_autoencoder(shards, LAYOUT, hyper)
    state, history = sequential(shards, hyper, 3)
    assert [h[0] for h in result.history] == [1, 2, 3]
    assert np.allclose([h[1] for h in result.history], [h[0] for h in history], rtol=1e-5)
    assert np.allclose([h[2] for h in result.history], [h[1] for h in history], rtol=1e-5)
    if result.best_epoch == 3:
        assert np.allclose(result.model.vector, state.vector, atol=1e-6)


@pytest.mark.parametrize("count", [1, 5])
def test_same_seed_same_weights(spark, count):
    runs = [
        A.train_autoencoder(shards_of(spark, count), LAYOUT, params(random_seed=s))
        for s in (4, 4, 5)
    ]
    assert np.array_equal(runs[0].model.vector, runs[1].model.vector)
    assert runs[0].history == runs[1].history
    assert not np.array_equal(runs[0].model.vector, runs[2].model.vector)


def test_a_round_averages_replicas_by_rows(spark):
    shards = shards_of(spark, 4, round_rows=35)
    assert shards.rounds == 2
    hyper, state = params(), TrainState.fresh(LAYOUT, 4)
    merged = A.training_pass(shards, LAYOUT, state, hyper, 0, 1)
    total, n = np.zeros(LAYOUT.size), 0
    for (turn, shard), part in rows_by_shard(shards).items():
        if turn != 1:
            continue
        own = state.copy()
        rng = np.random.default_rng([4, 0, shard, turn])
        rows = np.array([features for features, _ in part], "float32")
        rows = rows[rng.permutation(len(rows))]
        for at in range(0, len(rows), 32):
            N.train_step(LAYOUT, own, rows[at : at + 32], rng, 0.001, "none", 4)
        total += own.vector.astype(float) * len(rows)
        n += len(rows)
    got = TrainState.unpack(LAYOUT, np.frombuffer(merged["state"], "float32"), 0, 0)
    assert merged["n"] == n and merged["val_n"] == 0
    assert np.allclose(got.vector, total / n, atol=1e-6)
    first = A.training_pass(shards, LAYOUT, state, hyper, 0, 0)
    assert first["n"] == 240 - n and first["val_n"] == 60


def test_averaging_in_a_tree_equals_averaging_at_once(spark, monkeypatch):
    shards = shards_of(spark, 9)
    hyper, state = params(), TrainState.fresh(LAYOUT, 4)
    flat = A.training_pass(shards, LAYOUT, state, hyper, 0)
    monkeypatch.setattr(A, "MERGE_REPLICAS", 2)
    nested = A.training_pass(shards, LAYOUT, state, hyper, 0)
    assert (flat["n"], flat["val_n"], flat["steps"]) == (
        nested["n"], nested["val_n"], nested["steps"],
    )
    assert np.allclose(
        np.frombuffer(flat["state"], "float32"), np.frombuffer(nested["state"], "float32"),
        atol=1e-6,
    )


def test_many_shards_learn_about_as_much_as_one(spark):
    """Rows lie near a plane; with rounds of 25 rows replicas meet after about two steps."""
    rng = np.random.default_rng(1)
    hidden = rng.normal(size=(1200, 2))
    values = (hidden @ rng.normal(size=(2, 6)) + 0.1 * rng.normal(size=(1200, 6))).tolist()
    rows = spark.createDataFrame(
        [(i, v, i >= 200) for i, v in enumerate(values)],
        "id bigint, features array<double>, is_train boolean",
    )
    layout = Layout(6, (12,), 2, "tanh", 0.0)
    hyper = params(max_epochs=12, batch_size=16, learning_rate=0.01, patience=12)
    losses = {}
    for count in (1, 4, 8):
        shards = shards_of(spark, count, round_rows=25 if count > 1 else 1000, rows=rows)
        result = A.train_autoencoder(shards, layout, hyper)
        losses[count] = min(h[2] for h in result.history)
    assert losses[4] <= 1.1 * losses[1] and losses[8] <= 1.1 * losses[1]


def test_resumed_training_equals_unbroken_training(spark):
    shards, hyper = shards_of(spark, 3, round_rows=30), params(max_epochs=5)
    kept = []
    whole = A.train_autoencoder(shards, LAYOUT, hyper, keep=kept.append)
    assert [e.line for e in kept] == whole.history
    for after in (1, 3, 5):
        again = A.train_autoencoder(shards, LAYOUT, hyper, done=kept[:after])
        assert again.history == whole.history and again.best_epoch == whole.best_epoch
        assert np.array_equal(again.model.vector, whole.model.vector)


def test_resuming_after_the_last_epoch_trains_no_further(spark):
    hyper = params(max_epochs=40, patience=2, learning_rate=0.05)
    shards, kept = shards_of(spark), []
    whole = A.train_autoencoder(shards, LAYOUT, hyper, keep=kept.append)
    assert len(kept) < 40
    again = A.train_autoencoder(shards, LAYOUT, hyper, done=kept, keep=pytest.fail)
    assert again.history == whole.history
    assert np.array_equal(again.model.vector, whole.model.vector)


def test_empty_shards_do_no_harm(spark):
    result = A.train_autoencoder(shards_of(spark, 40, n=12, n_val=3), LAYOUT, params())
    assert len(result.history) == 3 and all(math.isfinite(h[2]) for h in result.history)


def test_no_training_rows(spark):
    with pytest.raises(DataLoadError, match="no normal records"):
        A.train_autoencoder(shards_of(spark, 2, n=10, n_val=10), LAYOUT, params())


def test_early_stopping_keeps_the_best(spark):
    hyper = params(max_epochs=200, patience=3, batch_size=16, learning_rate=0.05)
    layout = Layout(6, (16, 8), 5, "relu", 0.0)
    result = A.train_autoencoder(shards_of(spark, n=120, n_val=30), layout, hyper)
    losses = [h[2] for h in result.history]
    assert 1 <= len(losses) < 200
    assert result.best_epoch == int(np.argmin(losses)) + 1
    assert len(losses) == result.best_epoch + 3


@pytest.mark.parametrize("count", [1, 3])
def test_model_does_not_depend_on_batch_lengths(spark, count, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 20)
    shards = shards_of(spark, count)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    histories = []
    try:
        for length in ("7", "1000"):
            spark.conf.set(key, length)
            histories.append(A.train_autoencoder(shards, LAYOUT, params(max_epochs=2)).history)
    finally:
        spark.conf.set(key, before)
    # Sums of the validation loss are taken batch by batch and may round differently.
    for one, other in zip(*histories):
        assert one == pytest.approx(other, rel=1e-6)


def test_recut_blocks():
    blocks = [np.arange(n, dtype=float)[:, None] for n in (3, 0, 8, 1)]
    cut = list(A._recut(blocks, 5))
    assert [len(b) for b in cut] == [5, 5, 2]
    assert (np.concatenate(cut) == np.concatenate(blocks)).all()


def test_schedule_counts_the_mini_batches_of_all_shards(spark):
    hyper = params(max_epochs=3, batch_size=4, lr_schedule="step_decay", learning_rate=0.001)
    rates = []
    for count in (1, 4):
        shards = shards_of(spark, count, n=80, n_val=20)
        rates.append([h[3] for h in A.train_autoencoder(shards, LAYOUT, hyper).history])
    assert rates[0] == pytest.approx(rates[1], rel=5e-3)
    assert rates[1][2] == pytest.approx(0.001 * 0.9 ** (30 / 1000), rel=5e-3)


def test_number_of_shards_is_a_parameter():
    assert TrainingParams().shards == 8 and TrainingParams(shards=3).shards == 3


def test_too_large_a_model_is_refused():
    with pytest.raises(ConfigurationError, match="bytes per replica"):
        A.layout_for(ArchitectureParams((4096, 2048), 16), 20_000)


def test_learns_to_tell_shifted_rows(spark):
    rng = np.random.default_rng(0)
    mix = rng.normal(size=(2, 6))
    normal = rng.normal(size=(400, 2)) @ mix
    odd = rng.normal(size=(60, 6)) * 2
    rows = [(i, r.tolist(), i % 8 != 0) for i, r in enumerate(normal)]
    schema = "id bigint, features array<double>, is_train boolean"
    shards = shards_of(spark, 2, rows=spark.createDataFrame(rows, schema))
    hyper = params(max_epochs=25, learning_rate=0.01, batch_size=16)
    model = A.train_autoencoder(shards, Layout(6, (8,), 3, "tanh", 0.0), hyper).model
    both = spark.createDataFrame(
        [(0, r.tolist()) for r in normal] + [(1, r.tolist()) for r in odd],
        "y int, features array<double>",
    )
    by_class = model.score(both).groupBy("y").agg(F.avg("mse").alias("mean"))
    means = {r.y: r["mean"] for r in by_class.collect()}
    assert means[1] > 3 * means[0]


def test_empty_tables_are_refused(spark):
    model = A.Autoencoder(LAYOUT, LAYOUT.initial(0))
    empty = spark.createDataFrame([], "id bigint, features array<double>")
    with pytest.raises(InferenceError, match="0 rows"):
        model.reconstruct(empty)
    with pytest.raises(InferenceError, match="0 rows"):
        model.predict(empty, 1.0)


@pytest.mark.parametrize("layers", [(5,), (5, 4)])
def test_sums_over_blocks_give_the_gradient_of_the_batch(layers):
    layout = Layout(6, layers, 2, "tanh", 0.0, "float64")
    rows = np.random.default_rng(1).normal(size=(50, 6))
    start = TrainState(random_model(layout).vector, *np.zeros((2, layout.trainable)))
    whole, swept, known = start.copy(), start.copy(), N.BatchSums.unknown()
    loss = N.train_step(layout, whole, rows, None, 0.01, "none", 3)
    for sweep in range(N.BatchSums.sweeps(layout)):
        found = [N.block_sums(layout, swept.vector, b, None, known) for b in np.split(rows, [7, 30])]
        parts = [(n, sums) for n, (_, sums) in zip((7, 23, 20), found)]
        n, sums = N.add_sums(parts, moments=sweep < 2 * len(layers))
        if sweep < N.BatchSums.sweeps(layout) - 1:
            known.learn(layout, n, sums)
    N.whole_step(layout, swept, sums, known, 0.01, "none", 3)
    assert sum(part for part, _ in found) / rows.size == pytest.approx(loss, rel=1e-12)
    assert np.allclose(np.frombuffer(swept.pack()), np.frombuffer(whole.pack()), rtol=1e-9, atol=1e-12)
    assert (swept.steps, swept.seen) == (whole.steps, whole.seen) == (1, 3)


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_a_batch_of_a_whole_round_is_never_held(spark, monkeypatch, dropout):
    """Rounds of one mini-batch go through in blocks, with the result of the batch at once."""
    layout = Layout(6, (5, 4), 2, "tanh", dropout, "float64")
    hyper = params(batch_size=1 << 40, max_epochs=2, precision="float64", learning_rate=0.01)

    def trained():
        shards = A.make_shards(
            table(spark)[0], F.col("is_train"), ["id"], 3, 1, Scratch(spark), "float64", 40,
            batch_size=hyper.batch_size,
        )
        return shards, A.train_autoencoder(shards, layout, hyper)

    at_once, whole = trained()
    assert not at_once.whole and at_once.rounds == 2
    monkeypatch.setattr(A, "BLOCK_ROWS", 16)
    monkeypatch.setattr(A, "MERGE_BYTES", 1)
    shards, swept = trained()
    assert shards.whole and shards.rounds == 2
    again = A.train_autoencoder(shards, layout, hyper)
    assert np.array_equal(again.model.vector, swept.model.vector)
    if not dropout:
        for one, other in zip(whole.history, swept.history, strict=True):
            assert one == pytest.approx(other, rel=1e-9)
        assert np.allclose(swept.model.vector, whole.model.vector, rtol=1e-8, atol=1e-10)

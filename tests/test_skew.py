"""Keys, values and copies that make up a third of a table."""

import pytest
from samples import connections
from pyspark.sql import functions as F

from oddrow import JobParams, Profile
from oddrow.operators.autoencoder import make_shards
from oddrow.operators.dedup import COPIES
from oddrow.operators.selection import RANK, SPLIT, TRAIN
from oddrow.plans import jobs
from oddrow.plans.session import METHOD_LIMIT, compiled_methods
from oddrow.profiles import NSL_KDD, register_profile
from oddrow.sources.storage import Scratch
from oddrow.sources.tables import project

HOT = register_profile(
    Profile("hot_key", "y", 0, ("c",), ("x",), {0: 0}, key=("k",))
)


@pytest.fixture
def hot_rows(spark):
    """9,000 rows; one key on a third of them, one category on most, each x distinct."""
    return spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 10 < 9, "common").otherwise("rare").alias("c"),
        F.col("id").cast("double").alias("x"),
        (F.col("id") % 9 == 8).cast("int").alias("y"),
    )


def params():
    return JobParams.from_mapping(
        {
            "dataset": {"path": "t", "schema": "hot_key"},
            "splits": {"train_ratio": 0.7, "val_ratio": 0.1, "test_ratio": 0.2, "random_seed": 1},
            "architecture": {
                "encoder_layers": [4], "bottleneck_dim": 2, "activation": "tanh",
                "dropout_rate": 0.0,
            },
            "training": {
                "learning_rate": 0.01, "batch_size": 64, "max_epochs": 1, "patience": 1,
                "lr_schedule": "none", "random_seed": 1, "shards": 6,
            },
            "threshold": {"percentile": 95},
            "output": {"artefact_dir": "runs"},
        }
    )


def test_hot_key_splits_exactly_and_shards_evenly(spark, hot_rows):
    scratch = Scratch(spark)
    cleaned = jobs.clean(project(hot_rows, HOT), HOT, scratch, 1)
    ready = jobs.preprocess(cleaned, HOT, params(), "t")
    normal = 8_000
    assert ready.split.n_train == int(0.7 / (0.7 + 0.1) * normal)
    sizes = {r[SPLIT]: r["count"] for r in ready.rows.groupBy(SPLIT).count().collect()}
    assert sizes == {"train": ready.split.n_train, "val": ready.split.n_val, "attack": 1_000}
    encoded = ready.preprocessor.transform(ready.normal, "float")
    shards = make_shards(encoded, F.col(SPLIT) == TRAIN, [RANK], 6, 1, scratch)
    per_shard = [r["count"] for r in shards.table.groupBy("shard").count().collect()]
    assert sum(per_shard) == normal and max(per_shard) < 1.3 * normal / 6
    result = jobs.fit_model(ready, params())
    assert len(result.history) == 1
    scratch.drop()


def test_copies_on_a_third_of_the_rows(spark):
    table = spark.createDataFrame(connections(200, 100))
    one = table.limit(1)
    many = one.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("n")
    scratch = Scratch(spark)
    cleaned = jobs.clean(project(table.unionByName(many), NSL_KDD), NSL_KDD, scratch, 1)
    assert cleaned.count() == 300
    assert cleaned.agg(F.max(COPIES)).first()[0] == 151
    scratch.drop()


def test_split_does_not_depend_on_copies_or_partitions(spark):
    table = spark.createDataFrame(connections(120, 10))
    scratch = Scratch(spark)
    kept = []
    for rows in (table, table.unionByName(table), table.repartition(5)):
        cleaned = jobs.clean(project(rows, NSL_KDD), NSL_KDD, scratch, 3)
        raw = params().to_mapping() | {"dataset": {"path": "t", "schema": "nsl_kdd"}}
        ready = jobs.preprocess(cleaned, NSL_KDD, JobParams.from_mapping(raw), "t")
        kept.append({r.duration for r in ready.train.collect()})
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 105
    scratch.drop()


def test_session_setting_is_restored(spark):
    before = spark.conf.get(METHOD_LIMIT)
    with pytest.raises(ValueError), compiled_methods(spark):
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        raise ValueError
    assert spark.conf.get(METHOD_LIMIT) == before
    spark.conf.set(METHOD_LIMIT, "4000")
    try:
        with compiled_methods(spark):
            assert spark.conf.get(METHOD_LIMIT) == "4000"
    finally:
        spark.conf.set(METHOD_LIMIT, before)

"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import importlib.util
import math
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
TABLES = Path("/root/testdata/sf0.001")
spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
driver = importlib.util.module_from_spec(spec)
spec.loader.exec_module(driver)

pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="needs the generated tables")
# Mini-batches are shuffled by the tasks, which SQL cannot follow.
NOT_SQL = {f"autoencoder_train_score_{table}" for table in ("embeddings", "lineitem")}
ORACLES, QUERIES = driver.all_oracles(), driver.all_queries()
# DuckDB types that hold the same values as the Spark type on the left.
SAME_TYPES = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"},
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_only_training_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == NOT_SQL
    assert set(ORACLES) <= set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, str(TABLES))
    names = sorted(result.columns)
    got = [tuple(_plain(r[c]) for c in names) for r in result.collect()]
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    kinds = {d[0]: str(d[1]) for d in answer.description}
    for c, kind in result.dtypes:
        assert kinds[c] in SAME_TYPES[kind], (c, kind, kinds[c])
    at = [columns.index(c) for c in names]
    expected = [tuple(_plain(r[i]) for i in at) for r in answer.fetchall()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", sorted(NOT_SQL))
def test_training_queries(spark, name):
    rows = QUERIES[name](spark, str(TABLES)).collect()
    assert rows
    assert all(r.mse >= 0 and r.prediction in (0, 1) for r in rows)


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["train_rows"] + rows[0]["val_rows"] > 0

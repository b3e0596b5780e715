"""Registered queries: against their SQL, or their columns and rows; and the pipeline."""

import importlib.util
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from oddrow.llm.oracles import ORACLES
from oddrow.llm.queries import QUERIES

ROOT = Path(__file__).resolve().parents[2]
TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.is_dir(), reason="needs the generated tables")
COLUMNS = {
    "op2_quality_pu": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op3_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
    "op4_html_text": "page_id:bigint url:string text:string n_chars:bigint",
    "op5_token_files": "doc_id:bigint start:bigint n_tokens:bigint ids_crc32:bigint",
    "op9_mixing": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op10_toxicity_mil": "doc_id:bigint held_out:boolean score:double predicted:int offending:string",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    spec = importlib.util.spec_from_file_location("entry", ROOT / "__spark_entry__.py")
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) - set(ORACLES) == set(COLUMNS)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, str(TABLES))
    names = sorted(result.columns)
    answer = duck.execute(ORACLES[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == names
    expected = [tuple(r[columns.index(c)] for c in names) for r in answer.fetchall()]
    got = [tuple(r[c] for c in names) for r in result.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_rows(spark, name):
    result = QUERIES[name](spark, str(TABLES))
    assert " ".join(f"{c}:{t}" for c, t in result.dtypes) == COLUMNS[name]
    source = "pages" if name == "op4_html_text" else "documents"
    assert result.count() == spark.read.parquet(f"{TABLES}/{source}.parquet").count()


def test_pipeline_stages(spark, scratch):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, str(TABLES)), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3]
    name, stage = corpus_pipeline.STAGES[-1]
    coded = stage(spark, docs, str(TABLES))
    assert coded.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = sorted(map(tuple, coded.collect()))
    assert len(got) == counts[4]
    assert got == sorted(map(tuple, corpus_pipeline.run(spark, str(TABLES)).collect()))

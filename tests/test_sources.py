"""Reading tables: names, types, missing values, errors."""

import gzip

import numpy as np
import pandas as pd
import pytest
from samples import connections
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oddrow import DataLoadError, SchemaValidationError
from oddrow.operators.quality import Quality
from oddrow.profiles import CICIDS2017, EVENTS, LINEITEM, NSL_KDD, UNSW_NB15
from oddrow.sources import storage, tables
from oddrow.sources.tables import (
    BAD_CELLS,
    MALFORMED,
    load_table,
    project,
    read_headerless_csv,
    write_table,
)


def test_reads_by_name_whatever_the_order(spark, make_csv):
    table = connections(20, 5)
    shuffled = table[list(reversed(table.columns))]
    rows = load_table(spark, make_csv(shuffled), NSL_KDD).toPandas()
    assert list(rows.columns) == [*NSL_KDD.required, BAD_CELLS]
    for c in NSL_KDD.numeric:
        assert np.array_equal(rows[c].to_numpy(), table[c].to_numpy())
    assert list(rows["label"]) == list(table["label"])


def test_extra_columns_pass_through(spark, make_csv):
    table = connections(5, 2).assign(note="x", Label="other")
    rows = load_table(spark, make_csv(table), NSL_KDD)
    assert "note" in rows.columns
    # A column that differs from a required one only in case keeps out of its way.
    clash = [c for c in rows.columns if c.startswith("Label")]
    assert len(clash) == 1 and clash[0] != "Label"
    assert {r["label"] for r in rows.select("label").collect()} == {"normal", "neptune"}
    assert load_table(spark, make_csv(table), NSL_KDD, extras=()).columns == [
        *NSL_KDD.required, BAD_CELLS,
    ]
    with pytest.raises(SchemaValidationError, match="absent"):
        load_table(spark, make_csv(table), NSL_KDD, extras=("absent",))


def test_missing_columns_are_all_named(spark, make_csv):
    gone = ["duration", "src_bytes", "flag"]
    with pytest.raises(SchemaValidationError) as error:
        load_table(spark, make_csv(connections(10, 0).drop(columns=gone)), NSL_KDD)
    assert all(c in str(error.value) for c in gone)


def test_column_check_minds_case(spark, make_csv):
    table = connections(5, 1).rename(columns={"duration": "Duration"})
    with pytest.raises(SchemaValidationError, match="duration"):
        load_table(spark, make_csv(table), NSL_KDD)


def test_label_is_optional_for_scoring(spark, make_csv):
    path = make_csv(connections(5, 1).drop(columns="label"))
    with pytest.raises(SchemaValidationError, match="label"):
        load_table(spark, path, NSL_KDD)
    assert "label" not in load_table(spark, path, NSL_KDD, label_required=False).columns


def test_header_only_is_empty_before_the_column_check(spark, make_csv):
    with pytest.raises(DataLoadError, match="empty"):
        load_table(spark, make_csv(pd.DataFrame(columns=["just", "two"])), NSL_KDD)


def test_file_without_content(spark, tmp_path):
    path = tmp_path / "nothing.csv"
    path.write_text("")
    with pytest.raises(DataLoadError, match="no parseable data"):
        load_table(spark, str(path), NSL_KDD)


@given(st.text(alphabet=st.characters(min_codepoint=65, max_codepoint=122), min_size=1))
@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_missing_path_is_named(spark, tmp_path, name):
    path = f"{tmp_path}/{name}"
    with pytest.raises(DataLoadError) as error:
        load_table(spark, path, NSL_KDD)
    assert path in str(error.value)


def test_missing_parquet(spark, tmp_path):
    with pytest.raises(DataLoadError, match="not found"):
        load_table(spark, f"{tmp_path}/none.parquet", NSL_KDD)


@pytest.mark.parametrize("name", ["a[1].csv", "b{x}.csv", "c*.csv"])
def test_glob_characters_in_real_names(spark, make_csv, name):
    assert load_table(spark, make_csv(connections(3, 1), name), NSL_KDD).count() == 4


def test_glob_pattern_reads_several_files(spark, make_csv, tmp_path):
    make_csv(connections(3, 1, seed=1), "part1.csv")
    make_csv(connections(3, 1, seed=2), "part2.csv")
    assert load_table(spark, f"{tmp_path}/part*.csv", NSL_KDD).count() == 8


def test_every_file_is_read_under_its_own_header(spark, make_csv, tmp_path):
    one, two = connections(4, 1, seed=1), connections(3, 2, seed=2)
    (tmp_path / "parts").mkdir()
    make_csv(one, "parts/a b.csv")
    make_csv(two[sorted(two.columns)], "parts/b%20.csv")
    make_csv(two.head(1)[two.columns[::-1]], "parts/c.csv")
    rows = load_table(spark, f"{tmp_path}/parts", NSL_KDD).toPandas()
    expected = pd.concat([one, two, two.head(1)])[list(rows.columns[:-1])]
    order = list(expected.columns[:6])
    assert rows.pop(BAD_CELLS).sum() == 0
    pd.testing.assert_frame_equal(
        rows.sort_values(order).reset_index(drop=True),
        expected.sort_values(order).reset_index(drop=True),
        check_dtype=False,
    )


def test_files_with_other_columns_are_named(spark, make_csv, tmp_path):
    make_csv(connections(3, 1), "x1.csv")
    make_csv(connections(3, 1).drop(columns="hot"), "x2.csv")
    with pytest.raises(SchemaValidationError, match="'hot'.*x1.csv.*x2.csv"):
        load_table(spark, f"{tmp_path}/x*.csv", NSL_KDD)


@pytest.mark.parametrize(
    ("raw", "named"),
    [
        (["a", "a", "a.1"], ["a", "a.2", "a.1"]),
        (["a", "a", "a"], ["a", "a.1", "a.2"]),
        (["a.1", "a", "a", "a.1", None], ["a.1", "a", "a.2", "a.1.1", "Unnamed: 4"]),
    ],
)
def test_header_numbers_do_not_collide(spark, tmp_path, raw, named):
    assert tables._header(raw) == named
    path = tmp_path / "h.csv"
    path.write_text(",".join(n or "" for n in raw) + "\n" + ",".join("1" for _ in raw) + "\n")
    assert tables.read_csv_text(spark, str(path)).columns[:-1] == named


def test_parquet_folders_of_any_name(spark, tmp_path):
    written = spark.createDataFrame(connections(6, 2))
    written.write.partitionBy("label").parquet(f"{tmp_path}/plain")
    rows = load_table(spark, f"{tmp_path}/plain", NSL_KDD)
    assert rows.count() == 8 and BAD_CELLS not in rows.columns


def test_missing_spellings_and_bad_numbers(spark, make_csv):
    table = connections(6, 0).astype({"duration": object})
    table["duration"] = ["NA", "None", "", "oops", "nan", "1.5"]
    table["service"] = ["NA", "None", "", "http", "null", "Na"]
    rows = load_table(spark, make_csv(table), NSL_KDD).toPandas()
    assert rows["duration"].isna().sum() == 5 and rows["duration"].iloc[5] == 1.5
    assert list(rows[BAD_CELLS]) == [0, 0, 0, 1, 0, 0]
    assert list(rows["service"].dropna()) == ["http", "Na"]


def test_quality_names_the_columns(spark, make_csv):
    table = connections(6, 2)
    table.loc[0, "duration"] = np.nan
    table.loc[1, "src_bytes"] = np.inf
    quality = Quality.of(load_table(spark, make_csv(table), NSL_KDD), NSL_KDD)
    assert quality.missing == {"duration": 1} and quality.infinite == {"src_bytes": 1}
    with pytest.raises(SchemaValidationError, match="duration.*src_bytes"):
        quality.check_values("data")


def test_quotes_and_commas_survive(spark, make_csv):
    table = connections(3, 0)
    table["service"] = ['a "quoted" word', "with, comma", "plain"]
    rows = load_table(spark, make_csv(table), NSL_KDD).toPandas()
    assert list(rows["service"]) == list(table["service"])


def test_duplicate_headers_are_numbered(spark, tmp_path):
    names = list(CICIDS2017.numeric)
    header = [n.removesuffix(".1") for n in names] + ["Label"]
    lines = [",".join(header)]
    lines += [",".join(str(i * 100 + j) for j in range(len(names))) + ",BENIGN" for i in range(3)]
    path = tmp_path / "flows.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = load_table(spark, str(path), CICIDS2017).toPandas()
    first, second = names.index("Fwd Header Length"), names.index("Fwd Header Length.1")
    assert list(rows["Fwd Header Length"]) == [first, 100 + first, 200 + first]
    assert list(rows["Fwd Header Length.1"]) == [second, 100 + second, 200 + second]


def test_integer_labels(spark, make_csv):
    table = pd.DataFrame(
        np.arange(4 * len(UNSW_NB15.features)).reshape(4, -1), columns=list(UNSW_NB15.features)
    ).assign(label=["0", "1", "0.0", "0.5"])
    rows = load_table(spark, make_csv(table), UNSW_NB15).toPandas()
    assert list(rows["label"].fillna(-1)) == [0, 1, 0, -1]


def test_headerless_file(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("1,2\n3,4\n")
    rows = read_headerless_csv(spark, str(path), ["a", "b"])
    assert [tuple(r) for r in rows.collect()] == [("1", "2", None), ("3", "4", None)]
    assert rows.columns == ["a", "b", MALFORMED]
    with pytest.raises(SchemaValidationError, match="expected 3"):
        read_headerless_csv(spark, str(path), ["a", "b", "c"])
    with pytest.raises(DataLoadError, match="not found"):
        read_headerless_csv(spark, f"{tmp_path}/none.csv", ["a"])


def test_csv_and_parquet_sinks(spark, tmp_path, make_csv):
    rows = load_table(spark, make_csv(connections(9, 3)), NSL_KDD, extras=()).drop(BAD_CELLS)
    for fmt in ("csv", "parquet"):
        path = f"{tmp_path}/out.{fmt}"
        write_table(rows, path, fmt)
        back = load_table(spark, path, NSL_KDD, extras=()).drop(BAD_CELLS)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_nan_in_parquet_becomes_null(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1, 1, "O", 1.0, float("nan"), 0.1, 0.2, "N")],
        [*LINEITEM.key, "l_linestatus", *LINEITEM.numeric, "l_returnflag"],
    )
    assert project(rows, LINEITEM).first()["l_extendedprice"] is None


def test_derived_columns(spark):
    rows = spark.sql(
        "SELECT 1L event_id, TIMESTAMP '2024-01-01 13:30:00' ts, 'view' event_type, 2.0D value, "
        "'{\"k\": 7}' props"
    )
    got = project(rows, EVENTS, extras=EVENTS.key).first()
    assert (got["props_k"], got["hour"], got["value"], got["event_id"]) == (7.0, 13.0, 2.0, 1)


def test_rows_with_a_wrong_number_of_fields_are_counted(spark, make_csv):
    path = make_csv(connections(4, 1))
    lines = open(path).read().splitlines()
    lines[2] += ",surplus"
    lines[4] = lines[4].rsplit(",", 1)[0]
    with open(path, "w") as out:
        out.write("\n".join(lines) + "\n")
    rows = load_table(spark, path, NSL_KDD, extras=())
    assert sorted(r[BAD_CELLS] for r in rows.collect()) == [0, 0, 0, 1, 1]
    with pytest.raises(SchemaValidationError, match="wrong length"):
        Quality.of(rows, NSL_KDD).check_values(path)


def test_headers_are_read_from_the_heads_of_files(spark, tmp_path, monkeypatch):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("x,label\n" + "1,normal\n" * 50_000)
    (folder / "b b.csv").write_text("\n\nlabel,x\nnormal,2\n")
    (folder / "c.csv").write_text("x,label\r\n3,neptune\r\n")
    (folder / "empty.csv").write_text("")
    with gzip.open(folder / "d.csv.gz", "wt") as out:
        out.write("label,x\nneptune,4\n")
    read = []
    real = storage.first_line
    monkeypatch.setattr(tables, "first_line", lambda s, f: read.append(f) or real(s, f, 16))
    rows = tables.read_csv_text(spark, str(folder))
    assert len(read) == 5
    counts = {(r["x"], r["label"]): r["count"] for r in rows.groupBy("x", "label").count().collect()}
    assert counts == {
        ("1", "normal"): 50_000, ("2", "normal"): 1, ("3", "neptune"): 1, ("4", "neptune"): 1,
    }


def test_first_line_longer_than_what_is_read_at_once(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text(",".join(f"c{i}" for i in range(2_000)) + "\n1\n")
    assert storage.first_line(spark, str(path), 100) == path.read_bytes().split(b"\n")[0]

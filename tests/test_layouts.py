"""Sheets by layout: scans, one write for all outputs, nested types, rejects, and appended checkpoints."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesieve.operators import (
    OUTPUT_TAG, SHEET_TAG, converted, layouts_of, merged_type, prepare_layout, union_sheets, united_outputs,
)
from lakesieve.plans import LakeSchema, sheets_job, workbooks
from lakesieve.queries.views import SHEET_SCHEMA, sheet_files, sheet_folder
from lakesieve.sinks import ChangeLog, files, replace_each
from lakesieve.sources import read_layouts, read_sheet_dir

AS_OF = datetime(2024, 5, 6, 7, 8, 9)


def scans(df):
    return len(re.findall(r"FileScan", df._jdf.queryExecution().executedPlan().toString()))


def test_all_sheets_of_a_layout_are_one_scan(spark, small):
    folders = sheet_folder(spark, small)
    layout, = read_layouts(spark, folders)
    assert len(folders) > 15 and set(layout.sheets) == set(folders)
    assert scans(layout.rows) == 1
    assert scans(read_sheet_dir(spark, sheet_files(spark, small), SHEET_SCHEMA)) == 1
    outputs, rejected = united_outputs([prepare_layout(layout)], {s: s[:3] for s in layout.sheets})
    assert len(outputs) == 1 and not rejected and scans(outputs[0].rows) == 1


def test_sheet_names_come_from_paths(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a b+c%é"))
    spark.range(3).selectExpr("CAST(id AS INT) AS id").write.parquet(str(tmp_path / "other"))
    spark.range(5).write.parquet(str(tmp_path / "third"))
    found = read_layouts(spark, {"One": str(tmp_path / "a b+c%é"), "Two": str(tmp_path / "other"), "Three": f"{tmp_path}/third/"})
    assert [x.sheets for x in found] == [("One", "Three"), ("Two",)]
    counts = {r[SHEET_TAG]: r["count"] for x in found for r in x.rows.groupBy(SHEET_TAG).count().collect()}
    assert counts == {"One": 2, "Two": 3, "Three": 5}
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "a+b c.csv").write_text("n\n1\n")
    assert read_sheet_dir(spark, str(tmp_path / "csv"), "n int", "csv", header="true").first()["sheet"] == "a+b c"


def test_outputs_are_one_write(spark, tmp_path, monkeypatch):
    rows = spark.range(1_000).selectExpr("id", "concat('o', id % 3) AS out", "'kept' AS other")
    paths = {f"o{i}": f"{tmp_path}/t/o{i}/" for i in range(4)}
    (tmp_path / "t" / "o1").mkdir(parents=True)
    (tmp_path / "t" / "o1" / "old.parquet").write_text("gone after the swap")
    writes = []
    swap = files.swap_in
    monkeypatch.setattr(files, "swap_in", lambda s, a, b: (writes.append(re.search(r"outputs-[0-9a-f]+", a)), swap(s, a, b)))
    counts = replace_each(rows, "out", paths)
    assert counts == {"o0": 334, "o1": 333, "o2": 333, "o3": 0}
    assert len({w.group() for w in writes if w}) == 1 and sum(w is None for w in writes) == 1  # the empty one
    for name, n in counts.items():
        stored = spark.read.parquet(paths[name])
        assert stored.columns == ["id", "other"] and stored.count() == n
        assert stored.where(f"concat('o', id % 3) <> '{name}'").isEmpty()
    assert list((tmp_path / "t" / "_lakesieve_work").glob("*outputs*")) == []


def test_outputs_with_different_columns(spark):
    sheets = {
        "FY1": spark.sql("SELECT 1 a, 'x' b"), "FY2": spark.sql("SELECT 2L A, 'y' b"), "Gift FY1": spark.sql("SELECT 3 c"),
        "FY3": spark.sql("SELECT 1 a"), "Gift FY2": spark.sql("SELECT 0.5D c"),
    }
    outputs, rejected = united_outputs(layouts_of(sheets), {s: "gift" if "Gift" in s else "fy" for s in sheets})
    assert rejected == [("FY3", "missing b")]
    assert {o.outputs: sorted(map(tuple, o.rows.collect())) for o in outputs} == {
        ("fy",): [(1, "x", "fy"), (2, "y", "fy")], ("gift",): [(0.5, "gift"), (3.0, "gift")]}
    assert outputs[0].rows.columns == ["a", "b", OUTPUT_TAG]
    outputs, rejected = united_outputs(layouts_of(sheets), dict.fromkeys(sheets, "all"), allow_missing=True)
    assert not rejected and outputs[0].rows.columns == ["a", "b", "c", OUTPUT_TAG] and outputs[0].rows.count() == 5


TYPES = [
    (["struct<a:int>", "struct<a:bigint>"], "struct<a:bigint>"),
    (["struct<a:int,b:string>", "struct<B:string,a:int,c:date>"], "struct<a:int,b:string,c:date>"),
    (["array<int>", "array<double>"], "array<double>"),
    (["array<struct<a:int>>", "array<struct<a:bigint,b:int>>"], "array<struct<a:bigint,b:int>>"),
    (["map<string,int>", "map<string,bigint>"], "map<string,bigint>"),
    (["map<int,array<int>>", "map<bigint,array<bigint>>"], "map<bigint,array<bigint>>"),
    (["struct<a:struct<b:date>>", "struct<a:struct<b:timestamp_ntz>>"], "struct<a:struct<b:timestamp_ntz>>"),
    (["struct<a:int>", "array<int>"], "string"), (["array<void>", "array<int>"], "array<int>"),
]


@pytest.mark.parametrize("types, expected", TYPES)
def test_nested_types_are_merged(spark, types, expected):
    kinds = [T._parse_datatype_string(t) for t in types]
    assert merged_type(kinds).simpleString() == expected
    rows, _ = union_sheets({str(i): spark.createDataFrame([(None,)], T.StructType([T.StructField("x", k)])) for i, k in enumerate(kinds)})
    assert rows.schema["x"].dataType.simpleString() == expected and rows.count() == len(types)


def test_nested_values_are_kept(spark):
    one = spark.sql("SELECT named_struct('a', 1, 'in', named_struct('x', 2)) v, array(named_struct('k', 1), NULL) l, map(1, array(1, NULL)) m")
    two = spark.sql("SELECT named_struct('IN', named_struct('y', 'z', 'x', 9007199254740993L), 'a', 5L) v, "
                    "array(named_struct('k', 2L)) l, map(7L, array(8L)) m")
    rows = union_sheets({"1": one, "2": two, "3": one.selectExpr("IF(v.a = 1, NULL, v) v", "IF(v.a = 1, NULL, l) l", "IF(v.a = 1, NULL, m) m")})[0]
    assert [r.asDict(recursive=True) for r in rows.collect()] == [
        {"v": {"a": 1, "in": {"x": 2, "y": None}}, "l": [{"k": 1}, None], "m": {1: [1, None]}},
        {"v": {"a": 5, "in": {"x": 9007199254740993, "y": "z"}}, "l": [{"k": 2}], "m": {7: [8]}},
        {"v": None, "l": None, "m": None}]
    assert converted(F.col("x"), T.IntegerType(), T.IntegerType()) is not None


def test_job_over_layouts(spark, small, tmp_path):
    layouts = read_layouts(spark, sheet_folder(spark, small))
    written, _, rejected = sheets_job(layouts, "lake", "items", str(tmp_path), AS_OF, "me", mode="category",
                                      warehouse=LakeSchema(spark, f"{tmp_path}/wh"), checkpoint_path=f"{tmp_path}/cp")
    lines = {r["category"]: r["row_count"] for r in written.collect()}
    assert set(lines) == {"accepted", "returned", "FY"} and rejected.isEmpty()
    assert sum(lines.values()) == spark.read.parquet(f"{small}/lineitem.parquet").count()
    for category, n in lines.items():
        assert spark.read.parquet(f"{tmp_path}/items/{category}/").count() == n
        assert LakeSchema(spark, f"{tmp_path}/wh").count(f"lake_items_{category.lower()}") == n


def test_a_name_clash_rejects_the_later_sheet(spark, tmp_path):
    sheets = {"My Sheet": spark.range(2), "my-sheet": spark.range(3), "Other": spark.range(4)}
    written, _, rejected = sheets_job(sheets, "lake", "misc", str(tmp_path), AS_OF, "me")
    assert sorted((r["category"], r["row_count"]) for r in written.collect()) == [("my-sheet", 2), ("other", 4)]
    assert [tuple(r) for r in rejected.collect()] == [("my-sheet", "two sheets would be written as 'my-sheet'")]


def test_an_output_that_breaks_holds_up_no_other(spark, tmp_path):
    good, bad = spark.range(3), spark.range(3).selectExpr("id + raise_error('broken row') AS id")
    written, _, rejected = sheets_job({"Good": good, "Bad": bad}, "lake", "misc", str(tmp_path), AS_OF, "me")
    assert [(r["category"], r["row_count"]) for r in written.collect()] == [("good", 3)]
    assert [r["sheet"] for r in rejected.collect()] == ["bad"]


def test_errors_that_are_not_the_data_stop_the_job(spark, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError("no cluster")

    monkeypatch.setattr(workbooks, "replace_each", broken)
    with pytest.raises(RuntimeError, match="no cluster"):
        sheets_job({"A": spark.range(1)}, "lake", "misc", str(tmp_path), AS_OF, "me")

    def lost(*_):
        raise ConnectionRefusedError("no gateway")

    monkeypatch.setattr(workbooks, "replace_each", lost)
    with pytest.raises(ConnectionRefusedError):
        sheets_job({"A": spark.range(1)}, "lake", "misc", str(tmp_path), AS_OF, "me")


def test_change_log(spark, tmp_path):
    schema = T._parse_datatype_string("g string, code string, upto int, by string, first string")
    log = ChangeLog(spark, str(tmp_path / "log"), schema, ("g", "code"), ("upto", "by"))
    assert log.read().isEmpty() and log.read().schema == schema
    spark.createDataFrame([("g", "old", 1, "plain", "f")], schema).write.parquet(log.path)  # a table as stored before
    log.append(spark.createDataFrame([("g", "a", 1, "x", "f1"), ("g", "old", 2, "y", "f2"), (None, "n", 1, "x", "f1")], schema))
    log.append(spark.createDataFrame([("g", "a", None, "z", "f3"), (None, "n", 2, "z", "f3")], schema))
    expected = {("g", "a", None, "z", "f1"), ("g", "old", 2, "y", "f"), (None, "n", 1, "x", "f1"), (None, "n", 2, "z", "f3")}
    assert {tuple(r) for r in log.read().collect()} == expected
    log.compact()
    assert {tuple(r) for r in log.read().collect()} == expected
    assert spark.read.parquet(log.path).count() == 4
    log.append(spark.createDataFrame([("g", "a", 9, "w", "f4")], schema))
    assert ("g", "a", 9, "w", "f1") in {tuple(r) for r in log.read().collect()}
    assert "partial_max_by" in log.read()._jdf.queryExecution().executedPlan().toString()

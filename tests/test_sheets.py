from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakesieve.contracts import CHECKPOINT
from lakesieve.operators import each_sheet, prepare_sheet, union_by_category, union_sheets
from lakesieve.plans import LakeSchema, sheets_job
from lakesieve.plans.workbooks import update_checkpoints
from lakesieve.sources import read_sheet_dir, read_sheets


def sheet(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_first_sheet_fixes_order_and_odd_sheets_are_listed(spark):
    rows, rejected = union_sheets({
        "one": sheet(spark, [(1, "x")], "a int, b string"),
        "two": sheet(spark, [("y", 2)], "B string, a int"),
        "three": sheet(spark, [(3,)], "a int"),
        "four": sheet(spark, [(4, "z", 1)], "a int, b string, c int"),
    })
    assert rows.columns == ["a", "b"]
    assert sorted(map(tuple, rows.collect())) == [(1, "x"), (2, "y")]
    assert {tuple(r) for r in rejected.collect()} == {("three", "missing b"), ("four", "unexpected c")}


def test_allow_missing(spark):
    rows, rejected = union_sheets({"one": sheet(spark, [(1,)], "a int"), "two": sheet(spark, [(2, 3)], "a int, b int")}, allow_missing=True)
    assert sorted(map(tuple, rows.collect())) == [(1, None), (2, 3)] and rejected.isEmpty()


@pytest.mark.parametrize("types,expected", [
    (["int", "bigint"], "bigint"), (["int", "double"], "double"), (["int", "string"], "string"), (["date", "string"], "string"),
    (["int", "decimal(10,2)"], "decimal(38,2)"), (["void", "int"], "int"), (["double", "boolean"], "string"),
    (["date", "timestamp_ntz"], "timestamp_ntz"), (["void", "void"], "void"),
])
def test_types_are_harmonized(spark, types, expected):
    sheets = {str(i): spark.range(1).select(F.lit(None).cast(t).alias("x") if t != "void" else F.lit(None).alias("x"))
              for i, t in enumerate(types)}
    rows, _ = union_sheets(sheets)
    assert rows.dtypes == [("x", expected)]
    assert rows.count() == len(types)


def test_text_and_numbers_union_without_failing(spark):
    rows, _ = union_sheets({"n": sheet(spark, [(1,)], "x bigint"), "t": sheet(spark, [("one",)], "x string")})
    assert sorted(r["x"] for r in rows.collect()) == ["1", "one"]


def test_categories(spark):
    one = sheet(spark, [(1,)], "a int")
    by_category, rejected = union_by_category(
        {"FY17": one, "Donation FY18": one, "donation FY19": one, "Notes": one, "FY18": sheet(spark, [(1,)], "b int")})
    assert {c: df.count() for c, df in by_category.items()} == {"FY": 1, "donation": 2, "OTHERS": 1}
    assert [r["sheet"] for r in rejected.collect()] == ["FY18"]


def test_each_sheet(spark):
    one = spark.range(1)
    assert list(each_sheet({"My Sheet!": one, "B": one})) == ["my-sheet", "b"]
    with pytest.raises(ValueError, match="my-sheet"):
        each_sheet({"My Sheet": one, "my-sheet": one})


def test_prepare(spark):
    df = spark.sql("SELECT 1 AS `Order No`, DATE '2024-01-02' AS `Ship.Date`")
    assert prepare_sheet(df, {"Order No": "no"}, {"year": "FY24"}).collect()[0].asDict() == {
        "no": 1, "ship_date": "2024-01-02", "year": "FY24"}


def test_read_sheets(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "b"))
    sheets = read_sheets(spark, {"A 1": str(tmp_path / "a"), "B": str(tmp_path / "b")})
    assert {n: (df.count(), df.first()["sheet"]) for n, df in sheets.items()} == {"A 1": (2, "A 1"), "B": (3, "B")}


def test_read_sheet_dir(spark, tmp_path):
    (tmp_path / "Gift FY20.csv").write_text("n\n1\n2\n")
    (tmp_path / "FY21.csv").write_text("n\n3\n")
    rows = read_sheet_dir(spark, str(tmp_path), "n int", "csv", header="true")
    assert sorted((r["sheet"].replace("%20", " "), r["n"]) for r in rows.collect()) == [("FY21", 3), ("Gift FY20", 1), ("Gift FY20", 2)]


AS_OF = datetime(2024, 5, 6, 7, 8, 9)


def test_job_with_labels(spark, tmp_path):
    sheets = {
        "Hart FY20": sheet(spark, [("2020-01-02", 5)], "eventdate string, `Rev` int"),
        "Alma FY21": sheet(spark, [("never", 6)], "eventdate string, `Rev` int"),
    }
    warehouse = LakeSchema(spark, str(tmp_path / "wh"))
    written, checkpoints, rejected = sheets_job(
        sheets, "lake", "final-attendance", str(tmp_path / "silver"), AS_OF, "me", mode="labelled", warehouse=warehouse)
    assert [tuple(r) for r in written.collect()] == [("", f"{tmp_path}/silver/final-attendance/", 2)]
    assert rejected.isEmpty()
    rows = warehouse.read("lake_final_attendance")
    assert sorted((r["event_date"], r["revenue"], r["museum_code"], r["fiscal_year"]) for r in rows.collect() if r["event_date"]) == [
        (datetime(2020, 1, 2), 5, "Hart", "FY20")]
    assert rows.count() == 2
    assert checkpoints.schema == CHECKPOINT or checkpoints.dtypes == [(f.name, f.dataType.simpleString()) for f in CHECKPOINT]
    assert sorted((r["group_name"], r["code"], r["data_upto_ts"]) for r in checkpoints.collect()) == [
        ("Loading", "loading.lake.final_attendance", AS_OF), ("Transformation", "transformation.lake.final_attendance", AS_OF)]


def test_job_moves_existing_checkpoints(spark, tmp_path):
    sheets = {"FY20": sheet(spark, [(1,)], "n int"), "FY21": sheet(spark, [(2,)], "n int")}
    args = (sheets, "lake", "sales", str(tmp_path / "silver"))
    _, first, _ = sheets_job(*args, AS_OF, "me", mode="all")
    later = AS_OF.replace(year=2025)
    written, second, _ = sheets_job(*args, later, "you", mode="all", checkpoints=first)
    row = second.first()
    assert second.count() == 1 and written.first()["row_count"] == 2
    assert (row["created_at"], row["created_by"], row["updated_at"], row["updated_by"], row["name"], row["note"]) == (
        AS_OF, "me", later, "you", None, "")
    assert spark.read.parquet(written.first()["path"]).select("fiscal_year").distinct().count() == 2
    assert update_checkpoints(second, second).count() == 1


def test_job_each_and_unknown_mode(spark, tmp_path):
    sheets = {"A b": sheet(spark, [(1,)], "n int"), "C": sheet(spark, [(2,)], "other int")}
    written, _, rejected = sheets_job(sheets, "lake", "misc", str(tmp_path), AS_OF, "me")
    assert {r["category"] for r in written.collect()} == {"a-b", "c"} and rejected.count() == 0
    with pytest.raises(ValueError, match="mode"):
        sheets_job(sheets, "lake", "misc", str(tmp_path), AS_OF, "me", mode="magic")


def test_a_sheet_keeps_its_own_column(spark, tmp_path):
    spark.createDataFrame([(1, "mine")], "id int, Sheet string").write.parquet(str(tmp_path / "a"))
    with pytest.raises(ValueError, match="name_column"):
        read_sheets(spark, {"A": str(tmp_path / "a")})
    row = read_sheets(spark, {"A": str(tmp_path / "a")}, name_column=None)["A"].first()
    assert row["Sheet"] == "mine"


def test_no_digit_is_lost_between_types(spark):
    united, _ = union_sheets({"a": spark.sql("SELECT 9007199254740993 n"), "b": spark.sql("SELECT 0.5D n")})
    assert {r["n"] for r in united.collect()} == {"9007199254740993", "0.5"}

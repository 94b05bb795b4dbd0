from pathlib import Path

import pytest
from lakesieve.contracts import COPY_OUTCOME, RULE_RESULT, SCORECARD
from lakesieve.operators import load_rules
from lakesieve.plans import LakeSchema, append_schema, clean_to_silver, land_and_clean, load_job, quality_job, rules_job
from lakesieve.sinks import read_results, write_table
from lakesieve.sources import LayerSource


def lake(spark, root, **tables):
    for name, df in tables.items():
        write_table(df, f"{root}/{name}")
    return LakeSchema(spark, str(root))


def frame(spark, rows, schema="id int, t string"):
    return spark.createDataFrame(rows, schema)


def outcomes(df):
    return {r["table_name"]: r for r in df.collect()}


def test_append(spark, tmp_path):
    source = lake(spark, tmp_path / "s", a=frame(spark, [(1, "x"), (2, "y")]), b=frame(spark, [(1, "x")]), e=frame(spark, []))
    target = lake(spark, tmp_path / "t", e=frame(spark, [(9, "z")]),
                  a=frame(spark, [(5, 0, "old")], "id bigint, extra int, t string"), c=frame(spark, [(1, "x")]))
    rows = outcomes(append_schema(source, target))
    assert (rows["a"]["outcome"], rows["a"]["target_before"], rows["a"]["target_after"], rows["a"]["appended"]) == ("processed", 1, 3, 2)
    assert (rows["b"]["outcome"], rows["b"]["message"]) == ("skipped", "target table not found")
    assert (rows["e"]["outcome"], rows["e"]["message"]) == ("skipped", "no rows in source")
    assert sorted(map(tuple, target.read("a").collect()), key=str) == [(1, None, "x"), (2, None, "y"), (5, 0, "old")]


def test_upsert_counts_and_replaces(spark, tmp_path):
    source = lake(spark, tmp_path / "s", a=frame(spark, [(1, "x"), (2, "new"), (3, "y")]))
    target = lake(spark, tmp_path / "t", a=frame(spark, [(1, "x"), (2, "old")]))
    first = outcomes(append_schema(source, target, upsert=True))["a"]
    assert (first["source_rows"], first["target_before"], first["target_after"], first["inserted"], first["deleted"], first["appended"]) == (
        3, 2, 3, 2, 1, 1)
    again = outcomes(append_schema(source, target, upsert=True))["a"]
    assert (again["inserted"], again["deleted"], again["appended"]) == (0, 0, 0)
    assert target.count("a") == 3


def test_upsert_refuses_to_blank_columns(spark, tmp_path):
    source = lake(spark, tmp_path / "s", a=frame(spark, [(1, "x")]))
    target = lake(spark, tmp_path / "t", a=frame(spark, [(1, "x", 7)], "id int, t string, extra int"))
    assert "extra" in outcomes(append_schema(source, target, upsert=True))["a"]["message"]
    append_schema(source, target, upsert=True, allow_blank=True)
    assert [tuple(r) for r in target.read("a").collect()] == [(1, "x", None)]


def test_empty_source_and_no_overlap(spark, tmp_path):
    source = lake(spark, tmp_path / "s", a=frame(spark, []), b=frame(spark, [(1, "x")]))
    target = lake(spark, tmp_path / "t", a=frame(spark, [(1, "x")]), b=frame(spark, [(1,)], "z int"))
    rows = outcomes(append_schema(source, target, upsert=True))
    assert {r["outcome"] for r in rows.values()} == {"skipped"}
    assert target.count("a") == 1
    append_schema(source, target, upsert=True, include=["a"], allow_empty=True)
    assert target.count("a") == 0


def test_a_failing_table_does_not_stop_the_others(spark, tmp_path):
    source = lake(spark, tmp_path / "s", a=frame(spark, [(1, "x")]), b=frame(spark, [(1, "not a number")]))
    target = lake(spark, tmp_path / "t", a=frame(spark, [(2, "y")]), b=frame(spark, [(1, 1)], "id int, t int"))
    spark.conf.set("spark.sql.ansi.enabled", True)
    result = append_schema(source, target, exclude=["zzz"])
    rows = outcomes(result)
    assert (rows["a"]["outcome"], rows["b"]["outcome"]) == ("processed", "failed")
    assert result.schema == COPY_OUTCOME


def test_unstable_source_is_read_once(spark, tmp_path):
    class Remote(LakeSchema):
        reads = []
        stable = False
        def read(self, table):
            self.reads.append(table)
            return super().read(table)

    lake(spark, tmp_path / "s", a=frame(spark, [(1, "x")]))
    target = lake(spark, tmp_path / "t", a=frame(spark, [(2, "y")]))
    source = Remote(spark, str(tmp_path / "s"), stable=False)
    assert outcomes(append_schema(source, target, upsert=True))["a"]["inserted"] == 1
    assert source.reads == ["a"]


def test_silver(spark, tmp_path):
    df = frame(spark, [(1, None), (None, None)])
    path, check = clean_to_silver(df, "things_json", str(tmp_path), ["id"], "id")
    assert path == f"{tmp_path}/things" and not check.passed and check.reason == "null 'id' values"
    assert spark.read.parquet(path).columns == ["id"]
    assert clean_to_silver(df, "x", str(tmp_path), ["id"], "id", on_invalid="skip")[0] is None
    assert clean_to_silver(df.filter("false"), "x", str(tmp_path), ["id"], "id")[0] is None
    with pytest.raises(ValueError, match="on_invalid"):
        clean_to_silver(df, "x", str(tmp_path), on_invalid="maybe")


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_land_and_clean(spark, tmp_path, fmt):
    df = frame(spark, [(1, "x\ny", None)], "id int, timestamp string, empty string")
    path, check = land_and_clean(df, str(tmp_path / "landing"), "recs", str(tmp_path / "silver"), fmt)
    assert check.passed and [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "x\ny")]
    assert path.endswith("/recs" if fmt == "json" else "/recs_csv")


def test_load(spark, tmp_path):
    write_table(frame(spark, [(1, "x")]), str(tmp_path / "full"))
    write_table(frame(spark, []), str(tmp_path / "empty"))
    warehouse = LakeSchema(spark, str(tmp_path / "wh"))
    assert load_job(spark, str(tmp_path / "full"), warehouse, "t") == 1
    assert load_job(spark, str(tmp_path / "full"), warehouse, "t", "append") == 1
    assert warehouse.count("t") == 2
    assert load_job(spark, str(tmp_path / "empty"), warehouse, "other") == 0
    assert warehouse.tables() == ["t"]
    for destination, mode in (("somewhere", "overwrite"), (warehouse, "merge")):
        with pytest.raises(ValueError):
            load_job(spark, str(tmp_path / "full"), destination, "t", mode)


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    for name, rows in {"orders": [(1, "a", "d1"), (1, "a", "d2"), (1, "a", "d2")], "events": [(None, "b", "d1")]}.items():
        frame(spark, rows, "id int, t string, ingestion_ts string").write.partitionBy("ingestion_ts").parquet(f"{root}/{name}")
    write_table(spark.range(1), f"{root}/flat")
    damaged = Path(root) / "broken" / "ingestion_ts=d2"
    damaged.mkdir(parents=True)
    (damaged / "part-0.parquet").write_text("not parquet")
    return root


def test_quality_job(spark, bronze, tmp_path):
    source = LayerSource(bronze=bronze, silver=bronze)
    tables = {"bronze": ["orders", "events", "flat", "broken", "absent", " "], "silver": ["flat"]}
    warehouse = LakeSchema(spark, str(tmp_path / "wh"))
    result = quality_job(spark, source, tables, "all", results_path=str(tmp_path), warehouse=warehouse, as_of="now")
    rows = {(r["layer"], r["table_name"]): r for r in result.collect()}
    assert {k: (r["processing_status"], r["ingestion_timestamp"], r["number_of_records"]) for k, r in rows.items()} == {
        ("bronze", "orders"): ("SUCCESS", "d2", 2), ("bronze", "events"): ("SUCCESS", "d1", 1),
        ("bronze", "flat"): ("NO_DATA", "N/A", 0), ("bronze", "broken"): ("ERROR", "d2", 0),
        ("bronze", "absent"): ("ERROR", "", 0), ("silver", "flat"): ("SUCCESS", "", 1)}
    assert rows[("bronze", "flat")]["data_score"] == 100.0 and rows[("bronze", "broken")]["data_score"] == 0.0
    assert read_results(spark, f"{tmp_path}/bronze", SCORECARD).count() == 5
    assert warehouse.tables() == ["data_quality_results_bronze", "data_quality_results_silver"]
    with pytest.raises(ValueError, match="unknown layer"):
        quality_job(spark, source, tables, "copper")


def test_quality_of_a_requested_slice(spark, bronze):
    source = LayerSource(bronze=bronze)
    tables = {"bronze": ["orders", "events"]}
    rows = {r["table_name"]: r for r in quality_job(spark, source, tables, requested="d2").collect()}
    assert rows["orders"]["number_of_records"] == 2 and rows["events"]["processing_status"] == "NO_DATA"
    assert quality_job(spark, source, tables, requested="d2", record_missing=False).count() == 1


def config(spark, rows):
    return spark.createDataFrame(
        rows, "table_name string, rule_name string, rule_description string, severity string, sql_condition string")


def test_rules_job(spark, bronze, tmp_path):
    rules = config(spark, [
        (" ORDERS", "dup", "", "LOW", "id = 1"), ("orders", "bad", "", "LOW", "raise_error('x') IS NULL"),
        ("events", "key", "", "HIGH", "id IS NULL"), ("broken", "any", "", "LOW", "true"), ("flat", "any", "", "LOW", "true"),
        ("unknown", "any", "", "LOW", "true")])
    tables = {n: f"{bronze}/{n}" for n in ("orders", "events", "broken", "flat", "no_rules")}
    warehouse = LakeSchema(spark, str(tmp_path / "wh"))
    result = rules_job(spark, tables, rules, results_path=str(tmp_path / "r"), warehouse=warehouse, as_of="now")
    assert {(r["table_name"], r["rule_name"], r["rule_status"], r["failed_count"], r["ingestion_time"]) for r in result.collect()} == {
        ("orders", "dup", "FAILED", 2, "d2"), ("orders", "bad", "ERROR", 0, "d2"), ("events", "key", "FAILED", 1, "d1"),
        ("broken", "table_processing_error", "ERROR", 0, "d2")}
    assert read_results(spark, str(tmp_path / "r"), RULE_RESULT).count() == 4
    assert warehouse.count("data_quality_rules") == 4


def test_rules_job_skips_tables_without_the_slice(spark, bronze):
    rules = config(spark, [("orders", "dup", "", "LOW", "id = 1"), ("events", "key", "", "HIGH", "id IS NULL")])
    tables = {n: f"{bronze}/{n}" for n in ("orders", "events")}
    result = rules_job(spark, tables, rules, requested="d2")
    assert [(r["table_name"], r["total_count"]) for r in result.collect()] == [("orders", 2)]
    assert rules_job(spark, tables, load_rules(spark)).count() == 0

"""Copying many tables at once: jobs, shared grouping, isolation, and what stops the job."""

import re

import pytest

from lakesieve.operators import reconcile_counts
from lakesieve.operators.reconcile import reconcile_all
from lakesieve.plans import LakeSchema, append_schema, rules_job
from lakesieve.plans import copying, rule_checks
from lakesieve.sinks import write_table


def jobs(spark):
    return spark.sparkContext._jsc.sc().dagScheduler().nextJobId()


def schemas(spark, root, tables):
    for name, (new, old) in tables.items():
        write_table(new, f"{root}/s/{name}")
        write_table(old, f"{root}/t/{name}")
    return LakeSchema(spark, f"{root}/s"), LakeSchema(spark, f"{root}/t")


@pytest.mark.parametrize("upsert", [True, False])
def test_fifty_small_tables_share_their_counting_jobs(spark, tmp_path, upsert):
    tables = {f"t{i:02}": (spark.range(i).coalesce(1), spark.range(3, 8).coalesce(1)) for i in range(50)}
    source, target = schemas(spark, tmp_path, tables)
    before = jobs(spark)
    rows = {r["table_name"]: r for r in append_schema(source, target, upsert=upsert).collect()}
    used = jobs(spark) - before
    assert len(rows) == 50 and rows["t00"]["outcome"] == "skipped"
    assert all(rows[f"t{i:02}"]["outcome"] == "processed" for i in range(1, 50))
    if upsert:
        found = rows["t10"]
        assert [found[c] for c in ("source_rows", "target_before", "target_after", "inserted", "deleted", "appended")] == [10, 5, 10, 5, 0, 5]
        assert (rows["t04"]["inserted"], rows["t04"]["deleted"]) == (3, 4)
    else:
        assert [rows["t10"][c] for c in ("target_before", "target_after", "appended")] == [5, 15, 10]
    # Schemas of both sides and the write; what is counted and listed takes a few jobs for all tables.
    assert used <= 50 * (3 if upsert else 4) + 12


def test_one_grouping_for_all_tables(spark, small):
    orders, customer = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("orders", "customer"))
    tables = {"o": (orders, orders.where("o_orderkey % 3 > 0").unionAll(orders.limit(5))), "c": (customer, customer), "e": (orders.limit(0), orders.limit(0))}
    found = reconcile_all(tables)
    assert len(re.findall(r"Exchange hashpartitioning\(table_name#\d+, _row_key", found._jdf.queryExecution().executedPlan().toString())) == 1
    lines = {r["table_name"]: r for r in found.collect()}
    assert set(lines) == {"o", "c"}
    for name, line in lines.items():
        expected = reconcile_counts(*tables[name]).first().asDict()
        assert {c: line[c] for c in expected} == expected
    by_columns = {r["table_name"]: r for r in reconcile_all(tables, "columns").collect()}
    assert by_columns["o"].asDict() == lines["o"].asDict() and by_columns["e"]["source_rows"] == 0


def test_a_table_that_breaks_the_shared_plan_is_set_apart(spark, tmp_path):
    tables = {f"t{i}": (spark.range(i + 1), spark.range(2)) for i in range(5)}
    tables["bad"] = (spark.sql("SELECT 'not a number' AS id"), spark.range(1))
    source, target = schemas(spark, tmp_path, tables)
    for upsert in (True, False):
        rows = {r["table_name"]: r["outcome"] for r in append_schema(source, target, upsert=upsert).collect()}
        assert rows.pop("bad") == "failed" and set(rows.values()) == {"processed"}
    assert target.count("bad") == 1


def test_empty_include_means_all(spark, tmp_path):
    source, target = schemas(spark, tmp_path, {"a": (spark.range(1), spark.range(1)), "b": (spark.range(1), spark.range(1))})
    assert append_schema(source, target, include=[]).count() == 2
    assert append_schema(source, target, include=["a"]).count() == 1


class Lost(LakeSchema):
    def read(self, table):
        raise ConnectionRefusedError("no gateway")


def test_a_lost_cluster_is_no_tables_fault(spark, tmp_path, monkeypatch):
    schemas(spark, tmp_path, {"a": (spark.range(1), spark.range(1))})
    with pytest.raises(ConnectionRefusedError):
        append_schema(Lost(spark, f"{tmp_path}/s"), LakeSchema(spark, f"{tmp_path}/t"))

    def no_memory(*_):
        raise MemoryError

    monkeypatch.setattr(copying, "overlap", no_memory)
    with pytest.raises(MemoryError):
        append_schema(LakeSchema(spark, f"{tmp_path}/s"), LakeSchema(spark, f"{tmp_path}/t"))


def test_a_lost_cluster_is_no_rules_fault(spark, tmp_path, monkeypatch):
    def lost(*_):
        raise ConnectionResetError("no gateway")

    spark.range(3).selectExpr("id", "'2024-01-01' AS ingestion_ts").write.partitionBy("ingestion_ts").parquet(f"{tmp_path}/a")
    rules = spark.createDataFrame([("a", "r", "id < 0", "", "HIGH", True)],
                                  "table_name string, rule_name string, condition string, description string, severity string, active boolean")
    monkeypatch.setattr(rule_checks, "rules_by_table", lambda _: {"a": []})
    monkeypatch.setattr(rule_checks, "evaluate_all", lost)
    with pytest.raises(ConnectionResetError):
        rules_job(spark, {"a": f"{tmp_path}/a"}, rules)
    monkeypatch.setattr(rule_checks, "resolve_partition_dir", lost)
    with pytest.raises(ConnectionResetError):
        rules_job(spark, {"a": f"{tmp_path}/a"}, rules)

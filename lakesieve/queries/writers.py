"""Sinks, written and read back."""

from pyspark.sql import functions as F

from ..contracts import RULE_RESULT
from ..operators import Rule, evaluate_all
from ..sinks import (
    ChangeLog, fit_partitions, land, read_results, replace_table, silver_path, upsert, write_results, write_table,
)
from ..sources import read_landing, read_table
from ..storage import scratch_path
from .gates import rule_sql
from .registry import query, table


@query("K1_write_parquet_overwrite", "SELECT * FROM customer")
def write_parquet_overwrite(spark, sf_dir):
    path = silver_path(scratch_path(spark, "silver"), "customer", "accounts")
    write_table(table(spark, sf_dir, "customer").select("c_custkey"), path)
    write_table(table(spark, sf_dir, "customer"), path)
    return read_table(spark, path)


@query("K1_replace_own_source",
       "SELECT c_custkey, c_name, c_nationkey, -c_acctbal AS c_acctbal, c_mktsegment FROM customer")
def replace_own_source(spark, sf_dir):
    path = silver_path(scratch_path(spark, "silver"), "customer")
    write_table(table(spark, sf_dir, "customer"), path)
    current = read_table(spark, path)
    replace_table(current.withColumn("c_acctbal", -F.col("c_acctbal")), path)
    return read_table(spark, path)


_RESULT_RULES = {
    "customer": [Rule("balance_positive", "c_acctbal <= 0", "Balance is positive", "HIGH")],
    "orders": [Rule("open_status", "o_orderstatus = 'O'", "Order is closed", "LOW")],
}


@query("K2_write_results_partitioned",
       rule_sql("customer", _RESULT_RULES["customer"], "customer", as_of="second")
       + " UNION ALL " + rule_sql("orders", _RESULT_RULES["orders"], "orders", as_of="first"))
def write_results_partitioned(spark, sf_dir):
    path = scratch_path(spark, "results")
    tables = {name: table(spark, sf_dir, name) for name in _RESULT_RULES}
    write_results(evaluate_all(tables, _RESULT_RULES, as_of="first"), path)
    write_results(evaluate_all({"customer": tables["customer"]}, _RESULT_RULES, as_of="second"), path)
    return read_results(spark, path, RULE_RESULT)


@query("K7_land_records", "SELECT * FROM events")
def land_records(spark, sf_dir):
    events, prefix = table(spark, sf_dir, "events"), scratch_path(spark, "landing")
    land(events, prefix, "events", "json", ts="2024-02-01_12:00:00")
    return read_landing(spark, f"{prefix}/json/latest/events", "json", events.schema)


@query("K8_output_partitions",
       "SELECT greatest(10, count(*) // 50000) AS partitions, count(*) AS row_count FROM lineitem")
def output_partitions(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    spread = fit_partitions(lineitem, rows=lineitem.count())
    per_part = spread.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    return per_part.agg(F.count("*").alias("partitions"), F.sum("n").alias("row_count"))


_UPTO = "max(ts) AS data_upto_ts, count(*) AS row_count"


_CHECKPOINTS = (
       f"WITH t AS (SELECT event_type AS code, {_UPTO} FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_type <> 'error' GROUP BY 1), "
       f"c AS (SELECT event_type AS code, {_UPTO} FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'view' GROUP BY 1) "
       "SELECT 'Loading' AS group_name, coalesce(t.code, c.code) AS code, "
       "coalesce(c.data_upto_ts, t.data_upto_ts) AS data_upto_ts, coalesce(t.row_count, c.row_count) AS row_count, "
       "CASE WHEN t.code IS NULL THEN 'second' ELSE 'first' END AS created_by, "
       "CASE WHEN c.code IS NULL THEN 'first' ELSE 'second' END AS updated_by "
       "FROM t FULL JOIN c ON t.code = c.code")


def _checkpoints(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    half = F.lit("2024-01-16").cast("timestamp_ntz")

    def checkpoints(rows, user):
        return rows.groupBy(F.lit("Loading").alias("group_name"), F.col("event_type").alias("code")).agg(
            F.max("ts").alias("data_upto_ts"), F.count("*").alias("row_count"),
        ).withColumns({"created_by": F.lit(user), "updated_by": F.lit(user)})

    first = checkpoints(events.filter((F.col("ts") < half) & (F.col("event_type") != "error")), "first")
    second = checkpoints(events.filter((F.col("ts") >= half) & (F.col("event_type") != "view")), "second")
    return first, second


@query("K9_upsert_checkpoint", _CHECKPOINTS)
def upsert_checkpoint(spark, sf_dir):
    return upsert(*_checkpoints(spark, sf_dir), keys=["group_name", "code"], update_columns=["data_upto_ts", "updated_by"])


@query("K9_checkpoint_log", _CHECKPOINTS)
def stored_checkpoints(spark, sf_dir):
    """Changes appended, compacted, appended again, and read back."""
    first, second = _checkpoints(spark, sf_dir)
    log = ChangeLog(spark, scratch_path(spark, "checkpoints"), first.schema, ("group_name", "code"), ("data_upto_ts", "updated_by"))
    log.append(first)
    log.compact()
    log.append(second)
    return log.read()

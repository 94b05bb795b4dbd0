"""Rules and the validation gate."""

from collections.abc import Sequence

from pyspark.sql import functions as F

from ..operators import (
    Rule, evaluate_all, evaluate_rules, evaluate_rules_isolated, gate_report, load_rules,
    rules_by_table,
)
from ..plans import clean_to_silver
from ..sources import read_catalog, read_table
from ..storage import scratch_path
from .registry import query, table
from .views import ORDERS, V2, V5, V6, sql, view


def rule_sql(
    relation: str, rules: Sequence[Rule], name: str, as_of: str = "", stamp: str = "",
    conditions: Sequence[str] | None = None,
) -> str:
    """Rule results in plain SQL, one pass per rule; ``conditions`` where the dialects differ."""
    parts = []
    for rule, condition in zip(rules, conditions or [r.condition for r in rules]):
        parts.append(
            f"SELECT '{name}' AS table_name, '{rule.name}' AS rule_name, '{rule.description}' AS rule_description, "
            f"'{rule.severity}' AS severity, '{as_of}' AS validated_time, '{stamp}' AS ingestion_time, "
            "CASE WHEN failed = 0 THEN 'PASSED' ELSE 'FAILED' END AS rule_status, "
            "failed AS failed_count, total AS total_count, "
            "CASE WHEN total = 0 THEN 0.0 ELSE round(CAST(failed AS DOUBLE) / total * 100, 2) END AS failure_rate, "
            "CASE WHEN total = 0 THEN 100.0 ELSE round((1 - CAST(failed AS DOUBLE) / total) * 100, 2) END AS validity_score, "
            "CASE WHEN total = 0 THEN 'Table is empty' WHEN failed = 0 THEN '' ELSE 'Rule failed: ' || failed || "
            "' records out of ' || total || ' failed validation' END AS error_message "
            f"FROM (SELECT count(*) AS total, count(*) FILTER (WHERE {condition}) AS failed FROM ({relation}) v) c")
    return " UNION ALL ".join(parts)


ORDER_RULES = [
    Rule("order_key_not_null", "o_orderkey IS NULL", "Order key is present", "CRITICAL"),
    Rule("price_positive", "o_totalprice <= 0", "Price is positive", "MEDIUM"),
    Rule("date_not_in_future", "o_orderdate > DATE '2000-12-31'", "Date is not after the cut-off", "HIGH"),
    Rule("priority_format", r"o_orderpriority NOT REGEXP r'^[1-3]-[A-Z]+$'", "Priority is 1 to 3", "LOW"),
]
ORDER_CONDITIONS = [r.condition for r in ORDER_RULES[:3]] + ["NOT regexp_matches(o_orderpriority, '^[1-3]-[A-Z]+$')"]
CUSTOMER_RULES = [
    Rule("balance_positive", "c_acctbal <= 0", "Balance is positive", "HIGH"),
    Rule("segment_known", "c_mktsegment IS NULL", "Segment is present"),
]
EVENT_RULES = [
    Rule("value_positive", "value <= 0", "Value is positive"),
    Rule("no_errors", "event_type = 'error'", "Not an error event", "HIGH"),
]
SHORT = ["rule_name", "failed_count", "total_count"]


MANY_RULES = [Rule(f"rule_{i}", f"l_quantity + l_linenumber > {i % 57} AND l_partkey % {i + 2} = {i % 3}") for i in range(100)]


@query("A12_hundred_rules",
       f"SELECT {', '.join(SHORT)} FROM ({rule_sql('SELECT * FROM lineitem', MANY_RULES, 'lineitem')}) r")
def hundred_rules(spark, sf_dir):
    return evaluate_rules(table(spark, sf_dir, "lineitem"), MANY_RULES, "lineitem").select(*SHORT)


@query("A12_rule_failed_count",
       f"SELECT {', '.join(SHORT)} FROM ({rule_sql(sql(V2), ORDER_RULES, 'orders', conditions=ORDER_CONDITIONS)}) r")
def rule_failed_count(spark, sf_dir):
    return evaluate_rules(view(spark, sf_dir, V2), ORDER_RULES, "orders").select(*SHORT)


@query("A13_failure_rate",
       f"SELECT rule_name, failure_rate, validity_score FROM ({rule_sql('SELECT * FROM customer', CUSTOMER_RULES, 'customer')}) r")
def failure_rate(spark, sf_dir):
    return evaluate_rules(table(spark, sf_dir, "customer"), CUSTOMER_RULES, "customer").select(
        "rule_name", "failure_rate", "validity_score")


_BROKEN = Rule("broken", "no_such_column > 0", "Does not analyze", "LOW")
# Breaks on the data, in ANSI mode or not (a bad cast only does so in ANSI mode).
_RAISING = Rule("raising", "raise_error('unusable value') IS NULL", "Fails on the first row", "LOW")


@query("A14_rule_status",
       "SELECT rule_name, rule_status, failed_count, total_count FROM "
       f"({rule_sql(sql(V2), ORDER_RULES, 'orders', conditions=ORDER_CONDITIONS)}) r "
       "UNION ALL SELECT 'broken', 'ERROR', 0, count(*) FROM orders "
       "UNION ALL SELECT 'raising', 'ERROR', 0, count(*) FROM orders")
def rule_status(spark, sf_dir):
    rules = [*ORDER_RULES, _BROKEN, _RAISING]
    return evaluate_rules_isolated(view(spark, sf_dir, V2), rules, "orders").select(
        "rule_name", "rule_status", "failed_count", "total_count")


@query("A14_rules_on_empty_table", rule_sql(sql(V5), ORDER_RULES[:2], "orders"))
def rules_on_empty_table(spark, sf_dir):
    return evaluate_rules(view(spark, sf_dir, V5), ORDER_RULES[:2], "orders")


@query("R1_load_rules",
       "SELECT 'supplier' AS table_name, CASE WHEN s_nationkey = 1 THEN 'Unknown Rule' ELSE 'check ' || s_name END AS rule_name, "
       "CASE WHEN s_nationkey = 2 THEN '' ELSE 'for ' || s_name END AS rule_description, "
       "CASE WHEN s_nationkey < 10 THEN 'HIGH' WHEN s_nationkey < 20 THEN 'LOW' ELSE 'MEDIUM' END AS severity, "
       "'s_suppkey = ' || s_suppkey || ' AND s_acctbal < 0' AS sql_condition FROM supplier")
def loaded_rules(spark, sf_dir):
    config = table(spark, sf_dir, "supplier").select(
        F.expr("CASE WHEN s_nationkey = 1 THEN NULL ELSE 'check ' || s_name END").alias("rule"),
        F.expr("CASE WHEN s_nationkey = 2 THEN NULL ELSE 'for ' || s_name END").alias("rule_description"),
        F.expr("CASE WHEN s_nationkey < 10 THEN 'HIGH' END").alias("severity"),
        F.expr("CASE WHEN s_nationkey < 20 THEN 'LOW' END").alias("serverity"),
        F.array(F.create_map(
            F.lit("supplier"), F.expr("'s_suppkey = ' || s_suppkey || ' AND s_acctbal < 0'"))).alias("sql_condition"))
    path = scratch_path(spark, "rules")
    config.write.json(path)
    return load_rules(spark, path, multi_line=False)


@query("R3_validate_table",
       f"SELECT 'null_key' AS gate, false AS passed, 'null ''o_orderkey'' values' AS reason, count(*) AS row_count, "
       f"count(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys FROM ({sql(V2)}) v "
       "UNION ALL SELECT 'missing', false, 'missing column ''timestamp''', count(*), 0 FROM customer "
       "UNION ALL SELECT 'good', true, '', count(*), 0 FROM events")
def validated_tables(spark, sf_dir):
    def gate(name, df, required, key):
        return gate_report(df, required, key).select(
            F.lit(name).alias("gate"), "passed", "reason", "row_count", "null_keys")

    return (gate("null_key", view(spark, sf_dir, V2), ["o_orderkey", "o_orderdate"], "o_orderkey")
            .unionAll(gate("missing", table(spark, sf_dir, "customer"), ["c_custkey", "timestamp"], "c_custkey"))
            .unionAll(gate("good", table(spark, sf_dir, "events"), ["event_id", "ts"], "event_id")))


@query("R4_clean_to_silver", f"SELECT c_custkey, c_name, c_mktsegment FROM ({sql(V6)}) v")
def cleaned_to_silver(spark, sf_dir):
    path, _ = clean_to_silver(
        view(spark, sf_dir, V6), "accounts_json", scratch_path(spark, "silver"),
        required=["c_custkey", "timestamp"], key="c_custkey")
    return read_table(spark, path)


@query("R5_evaluate_rules_all",
       " UNION ALL ".join([
           rule_sql(sql(V2), ORDER_RULES, "orders", conditions=ORDER_CONDITIONS),
           rule_sql("SELECT * FROM customer", CUSTOMER_RULES, "customer"),
           rule_sql("SELECT * FROM events", EVENT_RULES, "events")]))
def all_rules(spark, sf_dir):
    tables = {"orders": view(spark, sf_dir, V2), "customer": table(spark, sf_dir, "customer"),
              "events": table(spark, sf_dir, "events"), "part": table(spark, sf_dir, "part")}
    return evaluate_all(tables, {"orders": ORDER_RULES, "customer": CUSTOMER_RULES, "events": EVENT_RULES})

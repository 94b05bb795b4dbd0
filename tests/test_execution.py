"""What Spark is asked to do: scans, shuffles, pushed filters, read columns."""

import re

import pytest
from pyspark.sql import functions as F

import lakesieve.operators.reconcile as reconcile
from lakesieve.operators import (
    Rule, drop_null_columns, evaluate_rules, failing_rows, null_counts, profile, reconcile_counts, rows_to_insert, scorecard,
    semi_join_normalized,
)
from lakesieve.sinks import upsert


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return len(re.findall(r"FileScan parquet", plan(df)))


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def orders(spark, small):
    return spark.read.parquet(f"{small}/orders.parquet")


@pytest.mark.parametrize("by", ["columns", "fingerprint"])
def test_profile_is_two_scans_and_one_shuffle(orders, by):
    assert (scans(profile(orders, by)), shuffles(profile(orders, by))) == (2, 1)


def test_profile_without_duplicates_moves_no_row(orders):
    plain = profile(orders, duplicates=False)
    assert (scans(plain), shuffles(plain)) == (1, 0)


def test_profile_counts_before_the_shuffle(orders):
    assert "partial_count" in plan(profile(orders))


def test_fingerprint_does_not_shuffle_the_row(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    exchange = re.search(r"Exchange hashpartitioning\((.*?)\)", plan(profile(documents, "fingerprint"))).group(1)
    assert "text" not in exchange


def test_rules_are_one_scan_without_row_shuffle(orders):
    rules = [Rule(f"r{i}", f"o_totalprice > {i}") for i in range(60)]
    rules += [Rule(f"s{i}", f"o_totalprice < {i}") for i in range(60)]
    result = evaluate_rules(orders, rules, "orders")
    assert (scans(result), shuffles(result)) == (1, 1)
    assert re.search(r"Exchange hashpartitioning\(i#", plan(result))  # counts by rule, no rows
    assert re.search(r"ReadSchema: struct<o_totalprice:double>", plan(result))


def test_null_counts_is_one_scan(orders):
    assert (scans(null_counts(orders)), shuffles(null_counts(orders))) == (1, 0)


def test_scorecard_scans_each_table_once(orders):
    assert scans(scorecard({"a": orders, "b": orders.select("o_custkey"), "c": orders.select("o_orderstatus")})) == 6


def test_reconcile_shuffles_both_sides_once(orders):
    counts = reconcile_counts(orders, orders.filter("o_custkey > 5"))
    assert (scans(counts), shuffles(counts)) == (2, 1)


def test_delta_by_columns_is_one_shuffle_and_no_join(orders, monkeypatch):
    monkeypatch.setattr(reconcile, "_BLOCK", 1)
    delta = rows_to_insert(orders.unionAll(orders), orders.filter("o_custkey > 5"))
    delta.collect()
    final = plan(delta).split("== Initial Plan ==")[0]
    assert "Join" not in final and "partial_sum" in final
    # Rows with very many copies are taken from the same shuffle as the others.
    assert "ReusedExchange" in final
    assert len(re.findall(r"FileScan parquet", final)) == 3


def test_upsert_keeps_the_partitioning_of_its_inputs(orders):
    latest = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("day"))
    assert shuffles(upsert(latest, latest, ["o_custkey"], ["day"])) <= 2


def test_small_delta_does_not_shuffle_the_rows(orders):
    delta = rows_to_insert(orders, orders.filter("o_custkey > 5"), by="fingerprint")
    assert "BroadcastHashJoin" in plan(delta) and shuffles(delta) == 0


def test_large_delta_joins_plain_shuffles_that_can_be_split(spark, orders):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for joined in (rows_to_insert(orders, orders.filter("o_custkey > 5"), by="fingerprint"),
                       semi_join_normalized(orders, orders, "o_orderpriority")):
            text = plan(joined)
            assert "SortMergeJoin" in text and shuffles(joined) == 2
            assert "HashAggregate" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_split_at_run_time(spark):
    """A third of the rows share one key; the join must not leave them to one task."""
    n = 400_000
    rows = spark.range(n).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "sha2(string(id), 256) AS pad")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = semi_join_normalized(rows, rows, "k")
        counted = joined.agg(F.count("*"), F.max("pad"))
        assert counted.collect()[0][0] == n
        assert "skew=true" in plan(counted)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_rule_filters_reach_the_scan(orders):
    assert "GreaterThan(o_totalprice,100.0)" in plan(failing_rows(orders, "o_totalprice > 100"))


def test_nothing_runs_in_python(orders):
    for df in (profile(orders), null_counts(orders), reconcile_counts(orders, orders)):
        assert "Python" not in plan(df)


def test_dropping_columns_leaves_a_plain_projection(orders):
    assert scans(drop_null_columns(orders)) == 1 and shuffles(drop_null_columns(orders)) == 0

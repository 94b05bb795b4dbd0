"""Filters and rule predicates."""

from pyspark.sql import functions as F

from ..operators import all_null_rows, failing_rows, include_exclude, semi_join_normalized
from .registry import query, table
from .views import V2, sql, view


@query("F1_failing_rows", "SELECT * FROM customer WHERE c_acctbal <= 0")
def failing(spark, sf_dir):
    return failing_rows(table(spark, sf_dir, "customer"), "c_acctbal <= 0")


@query("F2_not_null_rule", f"SELECT count(*) AS failed FROM ({sql(V2)}) v WHERE o_orderkey IS NULL")
def null_keys(spark, sf_dir):
    return failing_rows(view(spark, sf_dir, V2), "o_orderkey IS NULL").agg(F.count("*").alias("failed"))


@query("F3_pattern_rule",
       "SELECT page_id, url FROM pages WHERE url IS NOT NULL AND "
       "NOT regexp_matches(url, '^https?://[A-Za-z0-9.-]+\\.example\\.com/(en|fr)/[0-9]+')")
def bad_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return failing_rows(
        pages, r"url IS NOT NULL AND url NOT REGEXP r'^https?://[A-Za-z0-9.-]+\.example\.com/(en|fr)/[0-9]+'")


@query("F4_range_rule", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal <= 0")
def out_of_range(spark, sf_dir):
    return failing_rows(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal <= 0")


@query("F5_date_rule",
       "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > DATE '2000-12-31'")
def future_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return failing_rows(orders, "o_orderdate > DATE '2000-12-31'")


@query("F6_all_null_rows",
       f"SELECT count(*) AS all_null FROM ({sql(V2)}) v WHERE coalesce(CAST(o_orderkey AS VARCHAR), "
       "CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(o_totalprice AS VARCHAR), "
       "CAST(o_orderdate AS VARCHAR), o_orderpriority) IS NULL")
def empty_rows(spark, sf_dir):
    return all_null_rows(view(spark, sf_dir, V2)).agg(F.count("*").alias("all_null"))


_BLANKED = "SELECT event_id, CASE WHEN value < 10 THEN '  ' ELSE event_type END AS event_type FROM {events}"


@query("F8_include_exclude",
       f"SELECT event_id, event_type FROM ({sql(_BLANKED)}) v WHERE length(trim(event_type)) > 0 "
       "AND event_type IN ('view', 'click', 'error') AND event_type NOT IN ('error')")
def included_events(spark, sf_dir):
    return include_exclude(view(spark, sf_dir, _BLANKED), "event_type", {"view", "click", "error"}, {"error"})


@query("F8_include_exclude_tables",
       "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) "
       "AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def included_orders(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return include_exclude(
        orders, "o_custkey",
        include=customer.filter("c_acctbal > 0").select("c_custkey"),
        exclude=customer.filter("c_mktsegment = 'BUILDING'").select("c_custkey"))


@query("J3_semi_join_normalized",
       "SELECT c_custkey, ' ' || upper(c_name) AS name FROM customer WHERE c_custkey IN "
       "(SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def names_with_large_orders(spark, sf_dir):
    names = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" "), F.upper("c_name")).alias("name"))
    large = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(
        F.format_string("customer#%09d ", "o_custkey").alias("owner"))
    return semi_join_normalized(names, large, "name", "owner")

"""Projections and classification."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import (
    checkpoint_code, fiscal_year, kebab_case, keyword_category, label_category, row_hash,
    snake_case, split_label, stored_code, strip_affix,
)
from ..operators import (
    cast_if_present, dates_to_string, drop_null_columns, fill_defaults, overlap,
    standardize_columns, with_constants,
)
from .registry import query, table
from .views import SHEET_LABEL, V2, V6, sql, view


def _snake(c: str) -> str:
    return f"lower(trim(regexp_replace({c}, '[^0-9a-zA-Z]+', '_', 'g'), '_'))"


@query("P1_standardize_columns",
       "SELECT c_custkey AS customer_id, c_acctbal AS acct_bal_usd, c_name FROM customer")
def standardized(spark, sf_dir):
    odd = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Cust Key?"), F.col("c_acctbal").alias("Acct.Bal (USD)"),
        F.col("c_name").alias("C  Name"))
    return standardize_columns(odd, {"Cust Key?": "customer_id"})


@query("P2_snake_case", f"SELECT doc_id, {_snake('text')} AS snake FROM documents")
def snake(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", snake_case("text").alias("snake"))


@query("P3_kebab_case",
       "SELECT page_id, lower(trim(regexp_replace(url, '[^0-9a-zA-Z]+', '-', 'g'), '-')) AS kebab FROM pages")
def kebab(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", kebab_case("url").alias("kebab"))


@query("P4_drop_null_columns", f"SELECT c_custkey, c_name, c_mktsegment FROM ({sql(V6)}) v")
def without_null_columns(spark, sf_dir):
    return drop_null_columns(view(spark, sf_dir, V6).withColumn("void", F.lit(None)))


@query("P5_dates_to_string",
       "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
       "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders")
def dates_as_text(spark, sf_dir):
    return dates_to_string(table(spark, sf_dir, "orders"))


_MIXED_DATE = ("CASE WHEN o_orderstatus = 'P' THEN 'not yet' "
               "ELSE substr(CAST(o_orderdate AS VARCHAR(40)), 1, 10) END")


@query("P6_cast_timestamp",
       f"SELECT o_orderkey, TRY_CAST({_MIXED_DATE} AS TIMESTAMP) AS event_date FROM orders")
def cast_timestamp(spark, sf_dir):
    texts = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_MIXED_DATE).alias("event_date"))
    return cast_if_present(cast_if_present(texts, "event_date", "timestamp_ntz"), "no_such_column")


@query("P7_add_constants",
       "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'FY24' AS fiscal_year, 7 AS batch FROM supplier")
def constants(spark, sf_dir):
    return with_constants(table(spark, sf_dir, "supplier"), {"fiscal_year": "FY24", "batch": 7})


@query("P8_project_overlap", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def projected_overlap(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    target = customer.select("c_mktsegment", F.lit(0).alias("target_only"), "c_custkey", "c_name")
    return overlap(target, customer)


@query("P9_fiscal_year",
       f"SELECT label, regexp_extract(label, '(?i)FY\\d{{2}}', 0) AS fiscal_year, count(*) AS row_count "
       f"FROM (SELECT l_linestatus || ' fy9x ' || lower({SHEET_LABEL}) AS label FROM lineitem "
       "UNION ALL SELECT l_linestatus FROM lineitem) v GROUP BY ALL")
def fiscal_years(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    labels = items.select(F.expr(f"l_linestatus || ' fy9x ' || lower({SHEET_LABEL})").alias("label")).unionAll(
        items.select("l_linestatus"))
    counted = labels.groupBy("label").agg(F.count("*").alias("row_count"))
    return counted.select("label", fiscal_year("label").alias("fiscal_year"), "row_count")


@query("P10_split_label",
       f"SELECT label, regexp_split_to_array(trim(label), '\\s+')[1] AS museum_code, "
       "regexp_split_to_array(trim(label), '\\s+')[2] AS fiscal_year, count(*) AS row_count "
       f"FROM (SELECT ' ' || {SHEET_LABEL} || ' ' AS label FROM lineitem) v GROUP BY ALL")
def split_labels(spark, sf_dir):
    labels = table(spark, sf_dir, "lineitem").select(F.expr(f"' ' || {SHEET_LABEL} || ' '").alias("label"))
    counted = labels.groupBy("label").agg(F.count("*").alias("row_count"))
    return counted.select("label", *split_label("label"), "row_count")


_HASHED = "SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_name END AS c_name, c_mktsegment FROM {customer}"


@query("P13_row_hash",
       "SELECT c_custkey, sha256(CAST(to_json([CAST(c_custkey AS VARCHAR), c_name, c_mktsegment]) AS VARCHAR)) AS exact, "
       f"sha256(concat_ws('||', c_custkey, c_name, c_mktsegment)) AS piped FROM ({sql(_HASHED)}) v")
def row_hashes(spark, sf_dir):
    rows = view(spark, sf_dir, _HASHED)
    fields = rows.schema.fields
    return rows.select("c_custkey", row_hash(fields).alias("exact"),
                       row_hash(fields, null_safe=False).alias("piped"))


@query("P14_checkpoint_code",
       f"SELECT p_partkey, 'loading.lake.' || {_snake('p_name')} || "
       f"CASE WHEN p_size > 25 THEN '' ELSE '.' || {_snake('p_brand')} END AS code FROM part")
def checkpoint_codes(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("sub", F.expr("CASE WHEN p_size > 25 THEN NULL ELSE p_brand END"))
    code = checkpoint_code(F.lit("lake"), "p_name", "sub")
    return parts.select("p_partkey", stored_code(F.lit("Loading"), code).alias("code"))


@query("P15_strip_affix",
       "SELECT c_custkey, replace(c_name, 'Customer#', '') || '_json_v2' AS kept, "
       "replace(c_name, 'Customer#', '') AS bare FROM customer")
def stripped_affixes(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        strip_affix(F.concat("c_name", F.lit("_json_v2")), "Customer#", "_json").alias("kept"),
        strip_affix(F.concat("c_name", F.lit("_json")), "Customer#", "_json").alias("bare"))


@query("P16_fill_defaults",
       "SELECT coalesce(o_orderkey, 0) AS o_orderkey, coalesce(o_orderstatus, '') AS o_orderstatus, "
       f"coalesce(o_totalprice, 0.0) AS o_totalprice, false AS checked FROM ({sql(V2)}) v")
def filled_defaults(spark, sf_dir):
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("checked", T.BooleanType())])
    return fill_defaults(view(spark, sf_dir, V2), schema)


_TOPICS = {"Rings": ["ring", "band"], "Tools": ["widget", "gadget", "bolt"], "Red things": ["red"], "Small things": ["small"]}
_TEXT_TOPICS = {"Licence": ["license", "licence", "copyright"], "Contact": ["@", "tel:", "phone"], "Web": ["http", "www."]}


def _keyword_sql(column: str, rules: dict) -> str:
    branches = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({column}), '{w}')" for w in words) + f" THEN '{category}'"
        for category, words in rules.items())
    return f"CASE {branches} ELSE 'Other' END"


@query("C1_keyword_category",
       f"SELECT doc_id, {_keyword_sql('text', _TEXT_TOPICS)} AS category FROM documents")
def document_categories(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", keyword_category("text", _TEXT_TOPICS).alias("category"))


@query("C1_keyword_category_names",
       f"SELECT p_partkey, {_keyword_sql('p_name', _TOPICS)} AS category FROM part")
def part_categories(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", keyword_category("p_name", _TOPICS).alias("category"))


@query("C2_label_category",
       "SELECT label, CASE WHEN NOT regexp_matches(trim(label), '(?i)^([A-Za-z]+)?\\s*(FY\\d+)$') THEN 'OTHERS' "
       "WHEN regexp_extract(trim(label), '(?i)^([A-Za-z]+)?\\s*(FY\\d+)$', 1) = '' THEN 'FY' "
       "ELSE lower(regexp_extract(trim(label), '(?i)^([A-Za-z]+)?\\s*(FY\\d+)$', 1)) END AS category, "
       f"count(*) AS row_count FROM (SELECT {SHEET_LABEL} AS label FROM lineitem "
       "UNION ALL SELECT l_linestatus || ' notes' FROM lineitem) v GROUP BY ALL")
def label_categories(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    labels = items.select(F.expr(SHEET_LABEL).alias("label")).unionAll(
        items.select(F.expr("l_linestatus || ' notes'")))
    counted = labels.groupBy("label").agg(F.count("*").alias("row_count"))
    return counted.select("label", label_category("label").alias("category"), "row_count")

"""Quality metrics."""

from ..operators import duplicate_count, null_counts, profile, scorecard
from .registry import query, table
from .views import CUSTOMER, LINEITEM, ORDERS, V1, V2, V3, V5, sql, view

METRICS = {
    "is_empty": "rows = 0",
    "number_of_records": "rows",
    "total_cell_nulls": "nulls",
    "percentage_of_null_values": "null_pct",
    "total_null_record": "empty_rows",
    "total_duplicated_records": "repeats",
    "completeness_score": "complete",
    "uniqueness_score": "uniq",
    "data_score": "round((uniq * 0.5 + complete * 0.5) * 100, 2)",
}


def profile_sql(relation: str, columns: list[str], metrics=METRICS, prefix: str = "") -> str:
    """The metrics of a relation in plain SQL, from separate passes over it."""
    names = ", ".join(columns)
    nulls = " + ".join(f"(count(*) - count({c}))" for c in columns)
    empty = " AND ".join(f"{c} IS NULL" for c in columns)
    picked = ", ".join(f"{METRICS[m]} AS {m}" for m in metrics)
    return (
        f"SELECT {prefix}{picked} FROM (SELECT *, round(1 - null_pct / 100, 4) AS complete, "
        "CASE WHEN rows > 0 THEN round(1 - CAST(repeats AS DOUBLE) / rows, 4) ELSE 1.0 END AS uniq FROM ("
        "SELECT rows, nulls, empty_rows, repeats, CASE WHEN rows > 0 THEN "
        f"round(CAST(nulls AS DOUBLE) / (CAST(rows AS DOUBLE) * {len(columns)}) * 100, 2) ELSE 0.0 END AS null_pct "
        f"FROM (SELECT count(*) AS rows, CAST({nulls} AS BIGINT) AS nulls, count(*) FILTER (WHERE {empty}) AS empty_rows "
        f"FROM ({relation}) a) m, "
        "(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS repeats FROM "
        f"(SELECT count(*) AS n FROM ({relation}) b GROUP BY {names}) g) d) p) s")


V1_SQL = sql(V1)


def _metric(key: str, text: str, columns: list[str], metrics: list[str], repeats: bool = False) -> None:
    @query(key, profile_sql(sql(text), columns, metrics))
    def run(spark, sf_dir):
        return profile(view(spark, sf_dir, text), size=False, duplicates=repeats).select(*metrics)


_metric("A1_row_count", V1, LINEITEM, ["number_of_records", "is_empty"])
_metric("A3_total_cell_nulls", V1, LINEITEM, ["total_cell_nulls"])
_metric("A4_null_percentage", V1, LINEITEM, ["percentage_of_null_values"])
_metric("A5_total_null_record", V2, ORDERS, ["total_null_record"])
_metric("A8_completeness_score", V1, LINEITEM, ["completeness_score"])
_metric("A9_uniqueness_score", V3, ["c_nationkey", "c_mktsegment"], ["uniqueness_score"], True)
_metric("A10_data_score", V3, ["c_nationkey", "c_mktsegment"], ["data_score"], True)


@query("A2_null_counts",
       " UNION ALL ".join(f"SELECT '{c}' AS column, count(*) - count({c}) AS nulls FROM ({V1_SQL}) v" for c in LINEITEM))
def nulls_per_column(spark, sf_dir):
    return null_counts(view(spark, sf_dir, V1))


@query("A6_duplicates",
       f"SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM "
       f"(SELECT count(*) AS n FROM ({V1_SQL}) v GROUP BY {', '.join(LINEITEM)})")
def duplicates(spark, sf_dir):
    return duplicate_count(view(spark, sf_dir, V1))


@query("A6_duplicates_wide_rows",
       "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM "
       "(SELECT count(*) AS n FROM documents GROUP BY text, lang, n_chars)")
def document_copies(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("text", "lang", "n_chars")
    return duplicate_count(rows, by="fingerprint")


@query("A7_table_size_mb",
       "SELECT round(CAST(sum(octet_length(encode(CAST(to_json(struct_pack("
       "c_custkey := c_custkey, c_name := c_name, c_nationkey := c_nationkey, c_acctbal := c_acctbal, "
       "c_mktsegment := c_mktsegment"
       ")) AS VARCHAR)))) AS DOUBLE) / 1048576, 2) AS table_size_mb FROM customer")
def table_size(spark, sf_dir):
    return profile(table(spark, sf_dir, "customer"), duplicates=False).select("table_size_mb")


_CARD = ["table_name", "category", "ingestion_timestamp", "processing_status", "error_message", *METRICS]
_CARD_TABLES = {
    "lineitem_v1": (V1, LINEITEM, "Sales"), "orders_v2": (V2, ORDERS, "Sales"),
    "customer_v3": (V3, ["c_nationkey", "c_mktsegment"], "Sales"), "empty_v5": (V5, ORDERS, "Other"),
}


def card_sql(name: str, relation: str, columns: list[str], category: str, stamp: str = "") -> str:
    prefix = (f"'{name}' AS table_name, '{category}' AS category, '{stamp}' AS ingestion_timestamp, "
              "CASE WHEN rows = 0 THEN 'EMPTY_TABLE' ELSE 'SUCCESS' END AS processing_status, "
              "CASE WHEN rows = 0 THEN 'No data found in layer' ELSE '' END AS error_message, ")
    return profile_sql(relation, columns, METRICS, prefix)


@query("A11_quality_scorecard",
       " UNION ALL ".join(card_sql(n, sql(v), c, k) for n, (v, c, k) in _CARD_TABLES.items()))
def quality_scorecard(spark, sf_dir):
    tables = {name: view(spark, sf_dir, text) for name, (text, _, _) in _CARD_TABLES.items()}
    return scorecard(tables).select(*_CARD)


_PLAIN = {"customer": CUSTOMER, "orders": ORDERS, "lineitem": LINEITEM}


@query("A11_quality_scorecard_tables",
       " UNION ALL ".join(card_sql(n, f"SELECT * FROM {n}", c, "Sales") for n, c in _PLAIN.items()))
def quality_scorecard_tables(spark, sf_dir):
    return scorecard({name: table(spark, sf_dir, name) for name in _PLAIN}).select(*_CARD)

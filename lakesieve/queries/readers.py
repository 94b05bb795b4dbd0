"""Scans."""

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import SHEET_TAG, ordered_list
from ..sinks import land
from ..sources import (
    LayerSource, latest_partition, latest_partition_dir, read_catalog, read_landing, read_layer, read_layouts,
    read_partition, read_sheet_dir, read_sheets, read_table, resolve_partition_dir,
)
from ..storage import scratch_path
from .registry import query, table
from .views import EVENTS, SHEET_LABEL, SHEET_SCHEMA, V8, bronze_folder, sheet_files, sheet_folder, sql, view

DAY = "2024-01-15"
ABSENT_DAY = "1999-01-01"
V8_SQL = sql(V8)


@query("S1_scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/orders.parquet")


@query("S2_scan_partition",
       f"SELECT {', '.join(EVENTS)} FROM ({V8_SQL}) v WHERE ingestion_ts = '{DAY}'")
def scan_partition(spark, sf_dir):
    return read_partition(spark, f"{bronze_folder(spark, sf_dir)}/events", DAY)


@query("S3_latest_partition",
       f"SELECT * FROM ({V8_SQL}) v WHERE ingestion_ts = (SELECT max(ingestion_ts) FROM ({V8_SQL}) w)")
def latest_slice(spark, sf_dir):
    root = f"{bronze_folder(spark, sf_dir)}/events"
    latest = latest_partition_dir(spark, root)
    return read_partition(spark, root, latest).withColumn("ingestion_ts", F.lit(latest))


@query("S3_latest_value",
       f"SELECT o_orderpriority, count(*) AS orders FROM orders "
       "WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY ALL")
def latest_value(spark, sf_dir):
    days = table(spark, sf_dir, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    newest = days.filter(F.col("day") == latest_partition(days, "day"))
    return newest.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query("S4_requested_partition",
       f"SELECT 'present' AS request, '{DAY}' AS resolved, count(*) AS row_count FROM ({V8_SQL}) v WHERE ingestion_ts = '{DAY}' "
       f"UNION ALL SELECT 'absent', NULL, 0 "
       f"UNION ALL SELECT 'none', max(ingestion_ts), count(*) FROM ({V8_SQL}) v "
       f"WHERE ingestion_ts = (SELECT max(ingestion_ts) FROM ({V8_SQL}) w)")
def requested_partition(spark, sf_dir):
    root = f"{bronze_folder(spark, sf_dir)}/events"
    lines = []
    for request, day in (("present", DAY), ("absent", ABSENT_DAY), ("none", None)):
        resolved = resolve_partition_dir(spark, root, requested=day)
        rows = (read_partition(spark, root, resolved) if resolved
                else table(spark, sf_dir, "events").filter(F.lit(False)))
        lines.append(rows.agg(F.count("*").alias("row_count")).select(
            F.lit(request).alias("request"), F.lit(resolved).cast("string").alias("resolved"), "row_count"))
    return reduce(DataFrame.unionAll, lines)


@query("S5_layered_read",
       f"SELECT 'bronze' AS layer, count(*) AS row_count FROM ({V8_SQL}) v WHERE ingestion_ts = '{DAY}' "
       "UNION ALL SELECT 'silver', count(*) FROM orders")
def layered_read(spark, sf_dir):
    source = LayerSource(bronze=bronze_folder(spark, sf_dir), silver=sf_dir)
    bronze = read_layer(spark, source, "bronze", "events", DAY)
    silver = read_layer(spark, source, "silver", "orders.parquet")
    return reduce(DataFrame.unionAll, [
        df.agg(F.count("*").alias("row_count")).select(F.lit(layer).alias("layer"), "row_count")
        for layer, df in (("bronze", bronze), ("silver", silver))
    ])


@query("S9_scan_catalog_table", "SELECT * FROM customer")
def scan_catalog_table(spark, sf_dir):
    name = "customer_" + hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    spark.sql("CREATE DATABASE IF NOT EXISTS lakesieve_queries")
    spark.sql(f"CREATE TABLE IF NOT EXISTS lakesieve_queries.{name} USING parquet LOCATION '{sf_dir}/customer.parquet'")
    return read_catalog(spark, "lakesieve_queries", name)


@query("S10_scan_json_landing", "SELECT * FROM events")
def scan_json_landing(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    folder = land(events, scratch_path(spark, "landing"), "events", "json", ts="2024-02-01_00-00-00")
    return read_landing(spark, folder, "json", events.schema)


@query("S10_scan_csv_landing", "SELECT * FROM documents")
def scan_csv_landing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    folder = land(documents, scratch_path(spark, "landing"), "documents", "csv")
    return read_landing(spark, folder, "csv", documents.schema)


@query("S11_sheet_set_scan",
       f"SELECT {SHEET_LABEL} AS sheet, count(*) AS row_count, "
       "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL")
def sheet_set_scan(spark, sf_dir):
    sheets = read_sheets(spark, sheet_folder(spark, sf_dir))
    rows = reduce(DataFrame.unionByName, sheets.values())
    return rows.groupBy("sheet").agg(
        F.count("*").alias("row_count"), F.sum(F.col("`Qty.`").cast("long")).alias("quantity"))


def _sheet_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sheet").agg(
        F.count("*").alias("row_count"), F.sum(F.col("`Qty.`").cast("long")).alias("quantity"))


_SHEET_TOTALS = (f"SELECT {SHEET_LABEL} AS sheet, count(*) AS row_count, "
                 "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY ALL")


@query("S11_layout_scan", _SHEET_TOTALS)
def layout_scan(spark, sf_dir):
    """One scan for each layout instead of one for each sheet."""
    layouts = read_layouts(spark, sheet_folder(spark, sf_dir))
    rows = reduce(DataFrame.unionByName, (x.rows.withColumnRenamed(SHEET_TAG, "sheet") for x in layouts))
    return _sheet_totals(rows)


@query("S11_sheet_dir_scan", _SHEET_TOTALS)
def sheet_dir_scan(spark, sf_dir):
    return _sheet_totals(read_sheet_dir(spark, sheet_files(spark, sf_dir), SHEET_SCHEMA))


@query("S11_sheet_with_own_column", "SELECT c_name AS Sheet, c_custkey, c_acctbal, 'Customers FY20' AS read_from FROM customer")
def sheet_with_own_column(spark, sf_dir):
    path = scratch_path(spark, "sheet")
    table(spark, sf_dir, "customer").select(F.col("c_name").alias("Sheet"), "c_custkey", "c_acctbal").write.parquet(path)
    return read_sheets(spark, {"Customers FY20": path}, name_column="read_from")["Customers FY20"]


@query("S12_ordered_list",
       "SELECT conv_id, count(*) AS turns, string_agg(line, chr(10) ORDER BY turn, line) AS transcript FROM "
       "(SELECT conv_id, turn, role || ': ' || text AS line FROM conversations) t GROUP BY conv_id")
def transcripts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").withColumn(
        "line", F.concat_ws(": ", "role", "text"))
    lists = ordered_list(turns, "conv_id", "turn", "line", name="lines")
    return lists.select("conv_id", F.size("lines").cast("long").alias("turns"),
                        F.array_join("lines", "\n").alias("transcript"))

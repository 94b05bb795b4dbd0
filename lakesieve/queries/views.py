"""Damaged views over the clean driver tables, in SQL that Spark and DuckDB both run.

A modulo only picks which rows are damaged, repeated or changed; every view reads its whole table.
Names in braces are tables.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sheets import read_sheets
from ..storage import child_names, partition_dirs, scratch_path, swap_in
from .registry import table

LINEITEM = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
            "l_tax l_returnflag l_linestatus l_shipdate").split()
ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
CUSTOMER = "c_custkey c_name c_nationkey c_acctbal c_mktsegment".split()
EVENTS = "event_id ts user_id event_type value props".split()

_V1_ROW = ", ".join({
    "l_quantity": "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity",
    "l_returnflag": "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag",
}.get(c, c) for c in LINEITEM)
V1 = (f"SELECT {_V1_ROW} FROM {{lineitem}} "
      f"UNION ALL SELECT {_V1_ROW} FROM {{lineitem}} WHERE l_orderkey % 50 = 0")
V2 = "SELECT " + ", ".join(
    f"CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE {c} END AS {c}" for c in ORDERS) + " FROM {orders}"
V3 = "SELECT c_nationkey, c_mktsegment FROM {customer}"
V4_COLUMNS = ORDERS
V4_SOURCE = f"SELECT {', '.join(V4_COLUMNS)} FROM {{orders}}"
V4_TARGET = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
    "CASE WHEN o_orderkey % 13 = 0 THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority "
    "FROM {orders} WHERE o_orderkey % 10 <> 0 "
    "UNION ALL SELECT -o_orderkey AS o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
    "FROM {orders} WHERE o_orderkey > 0 AND o_orderkey % 17 = 0")
V5 = "SELECT * FROM {orders} WHERE 1 = 0"
V6 = ("SELECT c_custkey, c_name, CAST(NULL AS VARCHAR(10)) AS empty_note, "
      "CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM {customer}")
V8 = "SELECT *, substr(CAST(ts AS VARCHAR(40)), 1, 10) AS ingestion_ts FROM {events}"


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view's text over the Parquet tables of ``sf_dir``."""
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def sql(text: str) -> str:
    """A view's text with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", text)


SHEET_LABEL = (
    "CASE l_returnflag WHEN 'A' THEN 'Accepted FY' WHEN 'R' THEN 'Returned FY' ELSE 'FY' END "
    "|| substr(CAST(l_shipdate AS VARCHAR(40)), 3, 2)")
SHEET_COLUMNS = ["Order No", "Qty.", "Price (USD)", "Ship Date"]


SHEET_SCHEMA = "`Order No` bigint, `Qty.` double, `Price (USD)` double, `Ship Date` timestamp_ntz"


def _per_session(fn):
    """Derived datasets are written once per session and data folder, then shared."""
    @lru_cache(maxsize=None)
    def cached(application_id: str, sf_dir: str, spark: SparkSession):
        return fn(spark, sf_dir)

    return lambda spark, sf_dir: cached(spark.sparkContext.applicationId, sf_dir, spark)


@_per_session
def bronze_folder(spark: SparkSession, sf_dir: str) -> str:
    """A bronze layer holding ``events``, partitioned by day as V8 says."""
    root = scratch_path(spark, "bronze")
    # Rebalancing gives each day few files and splits a day that is far larger than the others.
    (view(spark, sf_dir, V8).hint("rebalance", "ingestion_ts")
     .write.partitionBy("ingestion_ts").parquet(f"{root}/events"))
    return root


def workbook(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The sheets of :func:`sheet_folder`, which all have the layout of the first."""
    folders = sheet_folder(spark, sf_dir)
    layout = spark.read.parquet(next(iter(folders.values()))).schema
    return read_sheets(spark, folders, schema=layout, name_column=None)


@_per_session
def sheet_folder(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Sheet name -> folder: line items as workbook sheets, one per return flag and year."""
    root = scratch_path(spark, "sheets")
    rows = table(spark, sf_dir, "lineitem").select(
        F.expr(SHEET_LABEL).alias("sheet"),
        F.col("l_orderkey").alias("Order No"),
        F.col("l_quantity").alias("Qty."),
        F.col("l_extendedprice").alias("Price (USD)"),
        F.col("l_shipdate").alias("Ship Date"),
    )
    rows.hint("rebalance", "sheet").write.partitionBy("sheet").parquet(root)
    return dict(sorted(partition_dirs(spark, root, "sheet").items()))


@_per_session
def sheet_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with one file per sheet, named as the sheet."""
    root, parts = scratch_path(spark, "sheet-files"), scratch_path(spark, "sheet-parts")
    rows = reduce(DataFrame.unionByName, [
        df.withColumn("sheet", F.lit(name)) for name, df in workbook(spark, sf_dir).items()])
    rows.repartition("sheet").write.partitionBy("sheet").parquet(parts)
    for sheet, folder in partition_dirs(spark, parts, "sheet").items():
        file, = (n for n in child_names(spark, folder) if n.endswith(".parquet"))
        swap_in(spark, f"{folder}/{file}", f"{root}/{sheet}.parquet")
    return root

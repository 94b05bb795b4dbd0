"""Composite jobs."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import checkpoint_code
from ..operators import delta_totals
from ..plans import LakeSchema, append_schema, land_and_clean, load_job, quality_job, rules_job, sheets_job
from ..sinks import write_table
from ..sources import LayerSource, read_layouts, read_table
from ..storage import scratch_path
from .copies import missing
from .gates import EVENT_RULES, rule_sql
from .metrics import METRICS, card_sql
from .registry import query, table
from .sheet_sets import CATEGORY
from .views import (
    CUSTOMER, EVENTS, ORDERS, SHEET_LABEL, V2, V4_SOURCE, V4_TARGET, V8, bronze_folder,
    sheet_folder, sql, view, workbook,
)

_S, _T = sql(V4_SOURCE), sql(V4_TARGET)
_OUTCOME = ["table_name", "outcome", "source_rows", "target_before", "target_after", "inserted", "deleted", "appended"]


def _schemas(spark, sf_dir) -> tuple[LakeSchema, LakeSchema]:
    source = LakeSchema(spark, scratch_path(spark, "source"))
    target = LakeSchema(spark, scratch_path(spark, "target"))
    write_table(table(spark, sf_dir, "orders"), f"{source.root}/orders")
    write_table(view(spark, sf_dir, V4_TARGET), f"{target.root}/orders")
    write_table(table(spark, sf_dir, "customer"), f"{source.root}/customer")
    write_table(table(spark, sf_dir, "nation"), f"{source.root}/nation")
    write_table(table(spark, sf_dir, "nation"), f"{target.root}/nation")
    return source, target


_COPIED = (
    "SELECT 'customer' AS table_name, 'skipped' AS outcome, CAST(NULL AS BIGINT) AS source_rows, "
    "CAST(NULL AS BIGINT) AS target_before, CAST(NULL AS BIGINT) AS target_after, CAST(NULL AS BIGINT) AS inserted, "
    "CAST(NULL AS BIGINT) AS deleted, CAST(NULL AS BIGINT) AS appended ")


@query("X1_append_schema",
       _COPIED + "UNION ALL SELECT 'orders', 'processed', s.n, t.n, s.n, i.n, d.n, greatest(0, s.n - t.n) "
       f"FROM (SELECT count(*) AS n FROM ({_S}) x) s, (SELECT count(*) AS n FROM ({_T}) x) t, "
       f"({missing(_S, _T, 'count(*) AS n')}) i, ({missing(_T, _S, 'count(*) AS n')}) d")
def upserted_schema(spark, sf_dir):
    source, target = _schemas(spark, sf_dir)
    return append_schema(source, target, upsert=True, exclude=["nation"]).select(*_OUTCOME)


@query("X1_every_table", "SELECT * FROM customer UNION ALL SELECT * FROM customer")
def every_table(spark, sf_dir):
    """A table is copied whatever its name begins with."""
    source = LakeSchema(spark, scratch_path(spark, "source"))
    target = LakeSchema(spark, scratch_path(spark, "target"))
    for schema in (source, target):
        write_table(table(spark, sf_dir, "customer"), f"{schema.root}/_audit.previous-1")
    append_schema(source, target)
    return target.read("_audit.previous-1")


@query("X1_append_schema_result",
       f"{_T} UNION ALL {_S}")
def appended_orders(spark, sf_dir):
    source, target = _schemas(spark, sf_dir)
    append_schema(source, target, include=["orders"])
    return target.read("orders")


@query("X1_copy_totals",
       "SELECT CAST(2 AS BIGINT) AS processed, CAST(1 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS failed, "
       f"greatest(0, s.n - t.n) AS total_rows_appended "
       f"FROM (SELECT count(*) AS n FROM ({_S}) x) s, (SELECT count(*) AS n FROM ({_T}) x) t")
def copy_totals(spark, sf_dir):
    source, target = _schemas(spark, sf_dir)
    return delta_totals(append_schema(source, target, upsert=True))


_AS_OF = datetime(2024, 2, 1, 12, 30)


@query("X2_sheets_to_silver_and_warehouse",
       f"SELECT category, row_count, group_name, lower(group_name) || '.lake.final_membership.' || lower(category) AS code, "
       "TIMESTAMP '2024-02-01 12:30:00' AS data_upto_ts, 'tester' AS updated_by "
       f"FROM (SELECT {CATEGORY} AS category, count(*) AS row_count FROM lineitem GROUP BY ALL) c, "
       "(VALUES ('Transformation'), ('Loading')) g(group_name)")
def membership_sheets(spark, sf_dir):
    base = scratch_path(spark, "workbook")
    warehouse = LakeSchema(spark, f"{base}/warehouse")
    written, checkpoints, _ = sheets_job(
        read_layouts(spark, sheet_folder(spark, sf_dir)), "lake", "final-membership", f"{base}/silver",
        as_of=_AS_OF, user="tester", mode="category", warehouse=warehouse)
    steps = written.withColumn("part", checkpoint_code(F.lit("lake"), F.lit("final-membership"), "category"))
    return (checkpoints.withColumn("part", F.expr("substr(code, length(group_name) + 2)")).join(steps, "part")
            .select("category", "row_count", "group_name", "code", "data_upto_ts", "updated_by"))


@query("X2_warehouse_rows",
       f"SELECT {CATEGORY} AS category, l_orderkey AS order_no, l_quantity AS qty, l_extendedprice AS price_usd, "
       f"strftime(l_shipdate, '%Y-%m-%d') AS ship_date, regexp_extract({SHEET_LABEL}, '(?i)FY\\d{{2}}', 0) AS fiscal_year "
       f"FROM lineitem")
def warehouse_rows(spark, sf_dir):
    base = scratch_path(spark, "workbook")
    warehouse = LakeSchema(spark, f"{base}/warehouse")
    written, _, _ = sheets_job(read_layouts(spark, sheet_folder(spark, sf_dir)), "lake", "final-membership", f"{base}/silver",
                               as_of=_AS_OF, user="tester", mode="category", warehouse=warehouse)
    return _all_outputs(warehouse, written)


def _all_outputs(warehouse, written):
    """Every table that a sheets job loaded, with its category."""
    categories = [r["category"] for r in written.collect()]
    return reduce(DataFrame.unionByName, [
        warehouse.read("lake_final_membership_" + c.lower()).withColumn("category", F.lit(c)) for c in categories])


@query("X2_broken_sheet_and_second_run",
       "SELECT group_name, lower(group_name) || '.lake.final_membership.' || lower(category) AS code, "
       "TIMESTAMP '2024-02-02 12:30:00' AS data_upto_ts, TIMESTAMP '2024-02-01 12:30:00' AS created_at, "
       "CAST(1 AS BIGINT) AS rejected "
       f"FROM (SELECT DISTINCT {CATEGORY} AS category FROM lineitem) c, (VALUES ('Transformation'), ('Loading')) g(group_name)")
def second_run(spark, sf_dir):
    """Two runs over the same stored checkpoints, with a sheet whose headers clash."""
    base = scratch_path(spark, "workbook")
    clash = table(spark, sf_dir, "nation").select(F.col("n_name").alias("usedate"), F.col("n_nationkey").alias("use date"))
    sheets = {"Broken FY20": clash, **workbook(spark, sf_dir)}
    for day in (1, 2):
        _, checkpoints, rejected = sheets_job(
            sheets, "lake", "final-membership", f"{base}/silver", as_of=_AS_OF.replace(day=day), user="tester",
            mode="category", warehouse=LakeSchema(spark, f"{base}/warehouse"), checkpoint_path=f"{base}/checkpoints")
    return checkpoints.select("group_name", "code", "data_upto_ts", "created_at", F.lit(rejected.count()).alias("rejected"))


_CARD = ["layer", "table_name", "category", "ingestion_timestamp", "processing_status", "error_message", *METRICS]
_LATEST = f"SELECT {', '.join(EVENTS)} FROM ({sql(V8)}) v WHERE ingestion_ts = (SELECT max(ingestion_ts) FROM ({sql(V8)}) w)"


def _layer_card(layer: str, name: str, relation: str, columns: list[str], stamp: str = "") -> str:
    category = {"events": "Activity"}.get(name, "Sales")
    return f"SELECT '{layer}' AS layer, x.* FROM ({card_sql(name, relation, columns, category, stamp)}) x"


@query("X3_quality_job",
       f"SELECT x.* REPLACE ((SELECT max(ingestion_ts) FROM ({sql(V8)}) w) AS ingestion_timestamp) "
       f"FROM ({_layer_card('bronze', 'events', _LATEST, EVENTS)}) x "
       "UNION ALL BY NAME " + _layer_card("silver", "orders.parquet", "SELECT * FROM orders", ORDERS)
       + " UNION ALL BY NAME " + _layer_card("silver", "customer.parquet", "SELECT * FROM customer", CUSTOMER))
def quality_of_layers(spark, sf_dir):
    source = LayerSource(bronze=bronze_folder(spark, sf_dir), silver=sf_dir)
    return quality_job(
        spark, source, {"bronze": ["events"], "silver": ["orders.parquet", "customer.parquet"]},
        layer="all", results_path=scratch_path(spark, "quality")).select(*_CARD)


@query("X4_rules_job",
       "SELECT x.* REPLACE (s.stamp AS ingestion_time) FROM "
       f"({rule_sql(_LATEST, EVENT_RULES, 'events', as_of='now')}) x, (SELECT max(ingestion_ts) AS stamp FROM ({sql(V8)}) w) s")
def rules_of_bronze(spark, sf_dir):
    rules = spark.createDataFrame(
        [(" Events", r.name, r.description, r.severity, r.condition) for r in EVENT_RULES],
        "table_name string, rule_name string, rule_description string, severity string, sql_condition string")
    bronze = f"{bronze_folder(spark, sf_dir)}/events"
    return rules_job(spark, {"events": bronze, "no_rules": bronze}, rules,
                     results_path=scratch_path(spark, "results"), as_of="now")


@query("X5_silver_to_warehouse", sql(V2))
def loaded_table(spark, sf_dir):
    silver = scratch_path(spark, "silver")
    write_table(view(spark, sf_dir, V2), silver)
    warehouse = LakeSchema(spark, scratch_path(spark, "warehouse"))
    load_job(spark, silver, warehouse, "orders")
    return warehouse.read("orders")


@query("X6_land_and_clean", "SELECT event_id AS id, ts AS timestamp, user_id, event_type, value, props FROM events")
def landed_and_cleaned(spark, sf_dir):
    records = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), "user_id", "event_type", "value", "props",
        F.lit(None).cast("string").alias("note"))
    path, _ = land_and_clean(records, scratch_path(spark, "landing"), "events", scratch_path(spark, "silver"),
                             ts="2024-02-01_00-00-00")
    return read_table(spark, path)

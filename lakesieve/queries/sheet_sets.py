"""Sheet unions."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import kebab_name
from ..operators import (
    OUTPUT_TAG, each_sheet, prepare_layout, prepare_sheet, union_by_category, union_sheets, united_outputs,
)
from ..operators.unions import sheet_categories
from ..sinks import replace_each, silver_path
from ..sources import read_layouts, read_table
from ..storage import scratch_path
from .registry import query, table
from .views import SHEET_LABEL, sheet_folder, workbook

ODD_SHEET = "FY98"


def sheets(spark, sf_dir) -> dict[str, DataFrame]:
    """Prepared sheets; quantities are whole numbers in some of them and fractions in others."""
    ready = {}
    for name, df in workbook(spark, sf_dir).items():
        rows = prepare_sheet(df, {"Order No": "order_no"}).withColumn("sheet", F.lit(name))
        ready[name] = rows.withColumn("qty", F.col("qty").cast("int")) if name.startswith("Acc") else rows
    return ready


def totals(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("qty").cast("long")).alias("qty"),
        F.sum(F.col("price_usd").cast("decimal(18,2)")).cast("double").alias("price_usd"),
        # Dates aggregate by hash; text would be sorted first.
        F.min(F.to_date("ship_date")).alias("first_day"))


TOTALS = ("count(*) AS row_count, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, "
          "CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price_usd, "
          "min(CAST(l_shipdate AS DATE)) AS first_day")
CATEGORY = "CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE 'FY' END"


@query("U1_union_sheets",
       f"SELECT {SHEET_LABEL} AS sheet, {TOTALS} FROM lineitem WHERE {SHEET_LABEL} <> '{ODD_SHEET}' GROUP BY ALL")
def united_sheets(spark, sf_dir):
    ready = sheets(spark, sf_dir)
    ready[ODD_SHEET] = ready[ODD_SHEET].withColumn("surprise", F.lit(1))
    rows, _ = union_sheets(ready)
    return totals(rows, "sheet")


@query("U1_rejected_sheets",
       f"SELECT sheet, 'unexpected surprise' AS reason FROM (SELECT DISTINCT {SHEET_LABEL} AS sheet FROM lineitem) v "
       f"WHERE sheet = '{ODD_SHEET}'")
def rejected_sheets(spark, sf_dir):
    ready = sheets(spark, sf_dir)
    ready[ODD_SHEET] = ready[ODD_SHEET].withColumn("surprise", F.lit(1))
    return union_sheets(ready)[1]


@query("U2_union_by_category", f"SELECT {CATEGORY} AS category, {TOTALS} FROM lineitem GROUP BY ALL")
def united_by_category(spark, sf_dir):
    by_category, _ = union_by_category(sheets(spark, sf_dir))
    return totals(reduce(DataFrame.unionByName, [
        df.withColumn("category", F.lit(c)) for c, df in by_category.items()]), "category")


@query("U3_each_sheet",
       f"SELECT replace(lower({SHEET_LABEL}), ' ', '-') AS output, {TOTALS} FROM lineitem GROUP BY ALL")
def one_output_per_sheet(spark, sf_dir):
    outputs = each_sheet(sheets(spark, sf_dir))
    return totals(reduce(DataFrame.unionByName, [
        df.withColumn("output", F.lit(name)) for name, df in outputs.items()]), "output")


def _stored(spark, base: str, outputs: dict[str, str], layouts) -> DataFrame:
    """What one write per set of columns has stored, with the number of rows it counted."""
    found = []
    for part in united_outputs([prepare_layout(x, {"Order No": "order_no"}) for x in layouts], outputs)[0]:
        paths = {o: silver_path(base, "line-items", o) for o in part.outputs}
        counts = replace_each(part.rows, OUTPUT_TAG, paths)
        found += [read_table(spark, path).select(
            F.lit(o).alias("output"), "qty", "price_usd", "ship_date", F.lit(counts[o]).alias("counted"))
            for o, path in paths.items()]
    return totals(reduce(DataFrame.unionByName, found), "output", "counted")


@query("U2_written_categories",
       f"SELECT {CATEGORY} AS output, count(*) AS counted, {TOTALS} FROM lineitem GROUP BY {CATEGORY}")
def written_categories(spark, sf_dir):
    layouts = read_layouts(spark, sheet_folder(spark, sf_dir))
    names = [s for layout in layouts for s in layout.sheets]
    outputs = {s: c for c, own in sheet_categories(spark, names).items() for s in own}
    return _stored(spark, scratch_path(spark, "categories"), outputs, layouts)


@query("U3_written_sheets",
       f"SELECT replace(lower({SHEET_LABEL}), ' ', '-') AS output, count(*) AS counted, {TOTALS} FROM lineitem "
       f"GROUP BY {SHEET_LABEL}")
def written_sheets(spark, sf_dir):
    layouts = read_layouts(spark, sheet_folder(spark, sf_dir))
    outputs = {s: kebab_name(s) for layout in layouts for s in layout.sheets}
    return _stored(spark, scratch_path(spark, "each"), outputs, layouts)


def _nested(spark, sf_dir, flag: str, number: str, rest: str = "") -> DataFrame:
    return table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == flag).select(
        F.lit(flag).alias("sheet"), "l_orderkey",
        F.expr(f"named_struct('no', CAST(l_linenumber AS {number}), 'price', l_extendedprice{rest})").alias("line"),
        F.expr(f"array(CAST(l_linenumber AS {number}), CAST(l_partkey AS {number}))").alias("numbers"),
        F.expr(f"map(l_linestatus, CAST(l_quantity AS {number}))").alias("by_status"))


@query("U1_union_nested_types",
       "SELECT l_returnflag AS sheet, l_orderkey, CAST(l_linenumber AS BIGINT) AS no, l_extendedprice AS price, "
       "CASE WHEN l_returnflag = 'R' THEN l_linestatus END AS mode, CAST(l_linenumber + l_partkey AS BIGINT) AS numbers, "
       "CAST(l_quantity AS BIGINT) AS qty FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def nested_types(spark, sf_dir):
    """Structs, arrays and maps whose parts are typed differently; one struct has a field more."""
    rows, _ = union_sheets({
        "A": _nested(spark, sf_dir, "A", "INT"),
        "R": _nested(spark, sf_dir, "R", "BIGINT", ", 'mode', l_linestatus"),
    })
    return rows.select(
        "sheet", "l_orderkey", "line.no", "line.price", "line.mode",
        F.expr("numbers[0] + numbers[1]").alias("numbers"), F.expr("map_values(by_status)[0]").alias("qty"))

"""Sheet sets: named tabular datasets that belong together, as the sheets of a workbook do."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.layouts import OUTPUT_TAG, SHEET_TAG, SheetLayout
from ..storage import qualified

SHEET_COLUMN = "sheet"


def read_sheets(
    spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet",
    schema: T.StructType | None = None, name_column: str | None = SHEET_COLUMN, **options: str
) -> dict[str, DataFrame]:
    """One DataFrame per named sheet, its name kept as ``name_column`` (None: not kept).

    A sheet that has such a column itself, in whatever case, is refused: nothing is overwritten. Each sheet is asked for its own layout; a shared ``schema`` saves that when there are many.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return {
        sheet: _named_sheet(reader.load(path), name_column, F.lit(sheet))
        for sheet, path in paths.items()
    }


def read_sheet_dir(
    spark: SparkSession, root: str, schema: T.StructType | str, fmt: str = "parquet",
    name_column: str = SHEET_COLUMN, **options: str
) -> DataFrame:
    """A folder with one file per sheet, all in one scan; the file name without its ending
    names the sheet, in ``name_column``, which the sheets must not have themselves."""
    rows = spark.read.format(fmt).schema(schema).options(**options).load(root)
    file_name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return _named_sheet(rows, name_column, F.regexp_replace(file_name, r"\.[^.]*$", ""))


def read_layouts(spark: SparkSession, paths: Mapping[str, str], fmt: str = "parquet", **options: str) -> list[SheetLayout]:
    """The sheets at ``paths`` (files, or folders of files), one scan for all that share a layout.

    Each sheet's schema is read from its footer or header. Rows get the name of their sheet from the
    path of their file, so a scan reads any number of sheets, and a filter on names or columns that
    no one wants reaches it.
    """
    reader = spark.read.format(fmt).options(**options)
    groups: dict[str, tuple[T.StructType, dict[str, str]]] = {}
    for sheet, path in paths.items():
        schema = reader.load(path).schema
        if {SHEET_TAG, OUTPUT_TAG} & set(schema.names):
            raise ValueError(f"sheet {sheet!r} has a column {SHEET_TAG!r} or {OUTPUT_TAG!r}")
        groups.setdefault(schema.json(), (schema, {}))[1][sheet] = path
    layouts = []
    for schema, own in groups.values():
        rows = spark.read.format(fmt).options(**options).schema(schema).load(list(own.values()))
        layouts.append(SheetLayout(tuple(own), rows.withColumn(SHEET_TAG, _sheet_of_path(spark, own))))
    return layouts


def _sheet_of_path(spark: SparkSession, paths: Mapping[str, str]) -> Column:
    """The sheet whose path is the row's file or the folder that holds it; a file of no sheet is an error."""
    places = F.create_map(*(F.lit(x) for sheet, path in paths.items() for x in (qualified(spark, path), sheet)))
    file = F.regexp_replace(F.col("_metadata.file_path"), r"^(\w+):///", "$1:/")
    folder = F.regexp_replace(file, "/[^/]*$", "")
    unknown = F.raise_error(F.concat(F.lit("no sheet is at "), file))
    return F.coalesce(places[file], places[folder], unknown)


def _named_sheet(rows: DataFrame, column: str | None, name: Column) -> DataFrame:
    if column is None:
        return rows
    if column.lower() in (c.lower() for c in rows.columns):
        raise ValueError(f"a sheet has a column {column!r} itself; choose another name_column")
    return rows.withColumn(column, name)

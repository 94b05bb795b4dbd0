"""Parquet, landed JSON/CSV and catalog tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import named, quoted


# Quotes are doubled inside values. An empty field is null and a quoted empty one an empty string,
# which Spark only tells apart when its null marker is some other text.
CSV_READ = {"header": "true", "escape": '"', "nullValue": "\ue000null\ue000"}
CSV_WRITE = {
    "header": "true", "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

#: What landed CSV writes for a character that would end its line, and for the mark itself. Every
#: backslash that is written begins such a pair, so undoing them in reverse order gives the value back.
LINE_ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
#: Written for what would leave a line of one field blank, which readers take for no record.
NO_VALUE, BLANK = "\\0", "\\e"


def to_one_line(df: DataFrame) -> DataFrame:
    """``df`` with texts and column names that hold no line break, so that every CSV line is a record."""
    alone = len(df.columns) == 1
    return df.select(*[_escaped(f, alone).alias(_escaped_name(f.name)) for f in df.schema.fields])


def _escaped(field: T.StructField, alone: bool) -> Column:
    value = named(field.name)
    if isinstance(field.dataType, T.StringType):
        for plain, mark in LINE_ESCAPES:
            value = F.replace(value, F.lit(plain), F.lit(mark))
        if alone:
            value = F.when(value.rlike(r"^[\x00-\x20]+$"), F.concat(F.lit(BLANK), value)).otherwise(value)
    return F.coalesce(value.cast("string"), F.lit(NO_VALUE)) if alone else value


def _escaped_name(name: str) -> str:
    for plain, mark in LINE_ESCAPES:
        name = name.replace(plain, mark)
    return name


def from_one_line(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows that :func:`to_one_line` was given, from their CSV text."""
    return raw.select(*[_restored(f).alias(f.name) for f in schema.fields])


def _restored(field: T.StructField) -> Column:
    value = named(field.name)
    if not isinstance(field.dataType, T.StringType):
        return value
    restored = F.replace(value, F.lit(BLANK), F.lit(""))
    for plain, mark in reversed(LINE_ESCAPES):
        restored = F.replace(restored, F.lit(mark), F.lit(plain))
    return F.when(value == NO_VALUE, F.lit(None)).otherwise(restored)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet dataset; the schema comes from the footer unless given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_catalog(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{quoted(database)}.{quoted(table)}")


def read_landing(spark: SparkSession, path: str, fmt: str, schema: T.StructType | str) -> DataFrame:
    """Landed records as a table. The schema is explicit, so nothing is scanned to infer it.

    :func:`land` leaves no line break inside a CSV value, so any number of tasks share a CSV file.
    """
    reader = spark.read.schema(schema)
    if fmt == "json":
        return reader.json(path)
    if fmt == "csv":
        raw = reader.options(**CSV_READ).csv(path)
        return from_one_line(raw, raw.schema)
    raise ValueError(f"landing format must be json or csv, not {fmt!r}")

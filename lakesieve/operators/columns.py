"""Column shaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import named, positional, quoted
from ..functions.text import snake_name

DATE_TIME_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def standard_names(columns: Iterable[str], mapping: Mapping[str, str] | None = None) -> list[str]:
    """New name per column: the exact, case-sensitive mapping first, else snake case.

    Two columns with one name, which Spark compares without case, cannot be told apart later
    and are refused.
    """
    mapping = mapping or {}
    columns = list(columns)
    names = [mapping.get(c, snake_name(c)) for c in columns]
    first: dict[str, str] = {}
    for old, new in zip(columns, names):
        if new.lower() in first:
            raise ValueError(f"columns {first[new.lower()]!r} and {old!r} would both be named {new!r}")
        first[new.lower()] = old
    return names


def standardize_columns(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    return df.toDF(*standard_names(df.columns, mapping))


def _all_void(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_all_void(f.dataType) for f in data_type.fields)
    return isinstance(data_type, T.NullType)


def _void_fields(data_type: T.DataType) -> list[str]:
    """Paths of the void fields inside a struct, the outermost ones where everything below is void."""
    if not isinstance(data_type, T.StructType):
        return []
    paths = []
    for f in data_type.fields:
        if _all_void(f.dataType):
            paths.append(quoted(f.name))
        else:
            paths += [f"{quoted(f.name)}.{inner}" for inner in _void_fields(f.dataType)]
    return paths


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that are null in every record.

    Columns and struct fields of the void type go without looking at the data; one aggregate
    decides the rest and only its single row of counts reaches the driver. An empty table keeps
    its columns.
    """
    return drop_and_count(df)[0]


def drop_and_count(df: DataFrame) -> tuple[DataFrame, int, dict[str, int]]:
    """(the table without its null columns, rows, values per kept column), from one aggregate."""
    typed = df.select(*[
        named(f.name).dropFields(*void).alias(f.name) if (void := _void_fields(f.dataType)) else named(f.name)
        for f in df.schema.fields if not _all_void(f.dataType)
    ])
    flat = positional(typed)
    counts = flat.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(c) for c in flat.columns]).first()
    rows = counts["rows"]
    kept = {name: counts[f"c{i}"] for i, name in enumerate(typed.columns) if rows == 0 or counts[f"c{i}"] > 0}
    return typed.select(*map(named, kept)), rows, kept


def dates_to_string(df: DataFrame) -> DataFrame:
    """Every date or timestamp column as ``yyyy-MM-dd`` text; the time of day is dropped."""
    return df.select(*[
        F.date_format(named(f.name), "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, DATE_TIME_TYPES) else named(f.name)
        for f in df.schema.fields
    ])


def cast_if_present(df: DataFrame, column: str, to: str = "timestamp") -> DataFrame:
    """Cast a column if there is one of that name; values that do not parse become null."""
    if column not in df.columns:
        return df
    return df.withColumn(column, named(column).try_cast(to))


def with_constants(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def overlap(target: DataFrame, source: DataFrame) -> DataFrame | None:
    """``source`` cut down to the columns ``target`` has too, in target order; None without any."""
    shared = [c for c in target.columns if c in source.columns]
    return source.select(*[named(c) for c in shared]) if shared else None


def _default_for(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    if isinstance(data_type, T.NumericType):
        return F.lit(0).cast(data_type)
    return F.lit("").cast(data_type)


def fill_defaults(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in ``schema``: right types, no nulls, absent columns added.

    Missing text is the empty string, missing numbers 0, missing flags false.
    """
    present = set(df.columns)
    return df.select(*[
        (F.coalesce(named(f.name).cast(f.dataType), _default_for(f.dataType))
         if f.name in present else _default_for(f.dataType)).alias(f.name)
        for f in schema.fields
    ])

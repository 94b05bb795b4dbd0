"""Unions of sheets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..contracts import SHEET_REJECT
from ..functions.naming import named
from ..functions.text import kebab_name, label_category
from .columns import dates_to_string, standardize_columns, with_constants
from .merging import converted, merged_type


def prepare_sheet(
    df: DataFrame, mapping: Mapping[str, str] | None = None, constants: Mapping[str, Any] | None = None
) -> DataFrame:
    """Standard names, dates as text, constant columns added."""
    return with_constants(dates_to_string(standardize_columns(df, mapping)), constants or {})


def _harmonized(sheets: list[DataFrame]) -> list[DataFrame]:
    by_column: dict[str, list[T.DataType]] = {}
    for df in sheets:
        for f in df.schema.fields:
            by_column.setdefault(f.name.lower(), []).append(f.dataType)
    common = {c: merged_type(types) for c, types in by_column.items()}
    return [
        df.select(*[
            converted(named(f.name), f.dataType, common[f.name.lower()]).alias(f.name) for f in df.schema.fields
        ])
        for df in sheets
    ]


def union_sheets(
    sheets: Mapping[str, DataFrame], allow_missing: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(all rows, rejected sheets): UNION ALL by column name.

    The first sheet fixes the columns and their order. A sheet with other columns is left out and
    listed with the reason, unless ``allow_missing`` fills the gaps with nulls. A column typed
    differently from sheet to sheet takes the type of :func:`merged_type`, inside structs, arrays and
    maps too.
    """
    if not sheets:
        raise ValueError("no sheets to union")
    names = list(sheets)
    first = {c.lower() for c in sheets[names[0]].columns}
    accepted, rejected = [], []
    for name in names:
        columns = {c.lower() for c in sheets[name].columns}
        if columns == first or allow_missing:
            accepted.append(sheets[name])
        else:
            rejected.append((name, column_difference(first, columns)))
    united = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), _harmonized(accepted))
    spark = united.sparkSession
    return united, spark.createDataFrame(rejected, SHEET_REJECT)


def column_difference(expected: set[str], found: set[str]) -> str:
    """What ``found`` lacks and what it has besides, in words."""
    parts = []
    if expected - found:
        parts.append("missing " + ", ".join(sorted(expected - found)))
    if found - expected:
        parts.append("unexpected " + ", ".join(sorted(found - expected)))
    return "; ".join(parts)


def sheet_categories(spark, names: list[str]) -> dict[str, list[str]]:
    """Category -> sheet names, by :func:`label_category`, in first-seen order."""
    labels = spark.createDataFrame(list(enumerate(names)), "i int, sheet string")
    rows = labels.select("i", "sheet", label_category("sheet").alias("c")).orderBy("i").collect()
    grouped: dict[str, list[str]] = {}
    for r in rows:
        grouped.setdefault(r["c"], []).append(r["sheet"])
    return grouped


def union_by_category(
    sheets: Mapping[str, DataFrame], allow_missing: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(category -> its rows, rejected sheets), each category a union of its own sheets."""
    if not sheets:
        raise ValueError("no sheets to union")
    spark = next(iter(sheets.values())).sparkSession
    united, rejects = {}, []
    for category, names in sheet_categories(spark, list(sheets)).items():
        rows, rejected = union_sheets({n: sheets[n] for n in names}, allow_missing)
        united[category] = rows
        rejects.append(rejected)
    return united, reduce(DataFrame.unionAll, rejects)


def each_sheet(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Output name -> sheet, without any union. Names that would overwrite each other are refused."""
    outputs: dict[str, DataFrame] = {}
    for name, df in sheets.items():
        key = kebab_name(name)
        if key in outputs:
            raise ValueError(f"two sheets would be written as {key!r}")
        outputs[key] = df
    return outputs

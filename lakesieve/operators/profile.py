"""How clean is a table? Null, duplicate and size metrics and the scores made of them.

Rows, null cells, empty rows and bytes are one plain aggregate, without moving a row. Duplicates are
a second one over fingerprints, which are counted before the shuffle, so a row repeated a billion
times travels as a few partial counts. It is planned only where duplicates are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import SCORECARD
from ..functions.hashing import row_fingerprint
from ..functions.naming import positional
from ..functions.text import DEFAULT_KEYWORDS, keyword_category
from .columns import fill_defaults

MEBIBYTE = 1024 * 1024


def _groupable(df: DataFrame) -> DataFrame:
    """Columns by position, with variants, which cannot be grouped, as JSON text."""
    flat = positional(df)
    return flat.select(*[
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f.name)
        for f in flat.schema.fields
    ])


def _json_bytes(flat: DataFrame, names: Sequence[str]) -> Column:
    row = F.struct(*[F.col(c).alias(n) for c, n in zip(flat.columns, names)])
    # Plain timestamps: formatting them by a pattern costs more than all the rest of the row.
    return F.octet_length(F.to_json(row, {"ignoreNullFields": "false"})).cast("long")


def _repeats(df: DataFrame, by: str) -> DataFrame:
    """(repeats): rows beyond the first of each group of equal rows.

    ``by="fingerprint"`` groups on the row's SHA-256 and shuffles some 40 bytes per distinct row
    however wide it is. ``by="columns"`` groups on the row itself, which saves the hashing where
    rows are short.
    """
    flat = _groupable(df)
    count = F.count(F.lit(1)).alias("n")
    if by == "columns":
        groups = flat.groupBy(*flat.columns).agg(count)
    elif by == "fingerprint":
        groups = flat.select(row_fingerprint(flat.schema.fields).alias("h")).groupBy("h").agg(count)
    else:
        raise ValueError(f"group rows by columns or fingerprint, not {by!r}")
    return groups.agg(_total(F.col("n") - 1).alias("repeats"))


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0)).cast("long")


def _counts(df: DataFrame, by: str, size: bool, duplicates: bool) -> DataFrame:
    """One row: records, null cells, empty rows, bytes and repeats."""
    flat = _groupable(df)
    nulls = [F.col(c).isNull().cast("int") for c in flat.columns] or [F.lit(0)]
    cells = reduce(Column.__add__, nulls)
    plain = flat.select(
        cells.alias("nulls"), (_json_bytes(flat, df.columns) if size and df.columns else F.lit(0).cast("long")).alias("bytes"),
    ).agg(
        F.count(F.lit(1)).alias("number_of_records"), _total(F.col("nulls")).alias("total_cell_nulls"),
        F.count_if((F.col("nulls") == len(df.columns)) & F.lit(bool(df.columns))).alias("total_null_record"),
        _total(F.col("bytes")).alias("bytes"),
    )
    zero = F.lit(0).cast("long")
    if not duplicates or not df.columns:
        return plain.withColumn("total_duplicated_records", zero)
    # Two results of one row each, side by side by adding them up.
    repeats = _repeats(df, by).select(*[zero.alias(c) for c in plain.columns], F.col("repeats").alias("total_duplicated_records"))
    both = plain.withColumn("total_duplicated_records", zero).unionByName(repeats)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns])


def profile(df: DataFrame, by: str = "fingerprint", size: bool = True, duplicates: bool = True) -> DataFrame:
    """One row with every metric and score of the table.

    Percentages are rounded to 2 places and scores to 4 before they enter the next formula. Without
    ``duplicates`` no row is shuffled and all count as unique; without ``size`` bytes are 0.
    """
    width = len(df.columns)
    counts = _counts(df, by, size, duplicates)
    rows = F.col("number_of_records").cast("double")
    nulls = F.col("total_cell_nulls").cast("double")
    repeats = F.col("total_duplicated_records").cast("double")
    has_cells = (F.col("number_of_records") > 0) & F.lit(width > 0)
    null_share = F.when(has_cells, F.round(nulls / F.nullif(rows * width, F.lit(0.0)) * 100, 2)).otherwise(0.0)
    scored = (
        counts
        .withColumn("percentage_of_null_values", null_share)
        .withColumn("completeness_score", F.round(1 - F.col("percentage_of_null_values") / 100, 4))
        .withColumn("uniqueness_score",
                    F.when(F.col("number_of_records") > 0,
                           F.round(1 - repeats / F.nullif(rows, F.lit(0.0)), 4)).otherwise(1.0))
    )
    return scored.select(
        (F.col("number_of_records") == 0).alias("is_empty"),
        "number_of_records", "total_cell_nulls", "percentage_of_null_values",
        "total_null_record", "total_duplicated_records",
        F.round(F.col("bytes") / F.lit(float(MEBIBYTE)), 2).alias("table_size_mb"),
        "completeness_score", "uniqueness_score",
        F.round((F.col("uniqueness_score") * 0.5 + F.col("completeness_score") * 0.5) * 100, 2).alias("data_score"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) per column, in column order, from one aggregate. NaN is not null."""
    flat = positional(df)
    counts = flat.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in flat.columns])
    lines = F.array(*[
        F.struct(F.lit(name).alias("column"), F.col(c).alias("nulls"))
        for c, name in zip(flat.columns, df.columns)
    ])
    return counts.select(F.inline(lines))


def duplicate_count(df: DataFrame, by: str = "fingerprint") -> DataFrame:
    """(duplicates): rows beyond the first of each group of equal rows; 0 without any."""
    if not df.columns:
        return df.agg(F.lit(0).cast("long").alias("duplicates"))
    return _repeats(df, by).withColumnRenamed("repeats", "duplicates")


def scorecard(
    tables: Mapping[str, DataFrame],
    ingestion_timestamps: Mapping[str, str | None] | None = None,
    keywords: Mapping[str, Sequence[str]] = DEFAULT_KEYWORDS,
    as_of: str = "",
    by: str = "fingerprint",
) -> DataFrame:
    """One 17-column line per table, in one plan whose branches Spark runs side by side."""
    if not tables:
        raise ValueError("a scorecard needs at least one table")
    stamps = ingestion_timestamps or {}
    lines = [
        profile(df, by)
        .withColumn("table_name", F.lit(name))
        .withColumn("ingestion_timestamp", F.lit(stamps.get(name)).cast("string"))
        for name, df in tables.items()
    ]
    rows = reduce(DataFrame.unionByName, lines)
    described = rows.withColumns({
        "category": keyword_category("table_name", keywords),
        "check_timestamp": F.lit(as_of),
        "processing_time_seconds": F.lit(0.0),
        "processing_status": F.when(F.col("is_empty"), "EMPTY_TABLE").otherwise("SUCCESS"),
        "error_message": F.when(F.col("is_empty"), "No data found in layer").otherwise(""),
    })
    return fill_defaults(described, SCORECARD)

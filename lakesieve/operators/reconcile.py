"""Source against target, row by row.

Rows are equal when all their columns are. ``by="columns"`` compares the columns themselves in one
shuffle of pre-counted rows. ``by="fingerprint"`` compares the SHA-256 of the rows instead and
shuffles some 60 bytes per row, which pays for long texts and hundreds of columns; it also offers
``null_safe=False``, the weaker hash that leaves nulls out.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import row_fingerprint, row_hash
from ..functions.naming import named
from ..storage import staged
from .columns import overlap

_KEY = "_row_key"
_S, _T = "_source_copies", "_target_copies"
_BLOCK = 1_000_000


def _fingerprint(df: DataFrame, null_safe: bool) -> Column:
    # Binary: half the size of a hash's hex text.
    return row_fingerprint(df.schema.fields) if null_safe else F.unhex(row_hash(df.schema.fields, null_safe))


def _keyed(df: DataFrame, by: str, null_safe: bool) -> DataFrame:
    if by == "fingerprint":
        return df.select(_fingerprint(df, null_safe).alias(_KEY))
    if by != "columns":
        raise ValueError(f"compare rows by columns or fingerprint, not {by!r}")
    if not null_safe:
        raise ValueError("null_safe=False only has a meaning for fingerprints")
    return df


def _copies(source: DataFrame, target: DataFrame, by: str, null_safe: bool) -> DataFrame:
    """Each distinct row, or its fingerprint, with its number of copies on either side.

    Both sides go through one grouping and are counted before the shuffle, so a row that makes up
    a third of a table is a few partial counts by then.
    """
    if by == "columns" and any(isinstance(f.dataType, T.VariantType) for f in source.schema.fields):
        by = "fingerprint"  # variants can't be grouped, their text can

    def side(df: DataFrame, s: int, t: int) -> DataFrame:
        return _keyed(df, by, null_safe).withColumns({_S: F.lit(s), _T: F.lit(t)})

    both = side(source, 1, 0).unionByName(side(target, 0, 1))
    keys = [named(c) for c in both.columns if c not in (_S, _T)]
    return both.groupBy(*keys).agg(F.sum(_S).alias(_S), F.sum(_T).alias(_T))


def _repeated(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as often as ``copies`` says. A row with very many copies is first cut into blocks
    that are spread over the cluster, so that no task has to write them all: a numbered
    repartition deals them out in turn, and adaptive execution leaves it alone."""
    n = F.col(copies)
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = rows.filter(n <= _BLOCK)
    blocks = (rows.filter(n > _BLOCK)
              .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({copies} - 1) DIV {_BLOCK}"))))
              .withColumn(copies, F.least(F.lit(_BLOCK), n - F.col("_block") * _BLOCK).cast("long"))
              .repartition(width)
              .drop("_block"))
    counted = few.unionByName(blocks)
    return (counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), n)))
            .drop("_copy", copies))


def _missing_from(left: DataFrame, right: DataFrame, by: str, null_safe: bool) -> DataFrame:
    """Rows of ``left``, with all their copies, without an equal row in ``right``."""
    if any(isinstance(f.dataType, T.VariantType) for f in left.schema.fields):
        by = "fingerprint"
    missing = _copies(left, right, by, null_safe).filter((F.col(_S) > 0) & (F.col(_T) == 0)).drop(_T)
    if by == "columns":
        return _repeated(missing, _S).select(*[named(c) for c in left.columns])
    # The missing keys, each once, are stored: Spark broadcasts them where they are known to be
    # small, so the rows need no shuffle, and otherwise joins two plain shuffles, whose hot
    # partitions adaptive execution splits.
    keys = staged(missing.select(_KEY), "missing-keys")
    hashed = left.withColumn(_KEY, _fingerprint(left, null_safe))
    return hashed.join(keys, _KEY, "left_semi").drop(_KEY)


def rows_to_insert(
    source: DataFrame, target: DataFrame, by: str = "columns", null_safe: bool = True
) -> DataFrame:
    """Source rows the target does not have. Both sides have the same columns."""
    return _missing_from(source, target, by, null_safe)


def rows_to_delete(
    source: DataFrame, target: DataFrame, by: str = "columns", null_safe: bool = True
) -> DataFrame:
    """Target rows the source does not have."""
    return _missing_from(target, source, by, null_safe)


def reconcile_counts(
    source: DataFrame, target: DataFrame, by: str = "columns", null_safe: bool = True
) -> DataFrame:
    """One row (source_rows, target_before, target_after, to_insert, to_delete, appended), from
    one shuffle instead of two anti joins that would each move both sides."""
    return _with_appended(_copies(source, target, by, null_safe).agg(*_side_counts()))


def _side_counts() -> list[Column]:
    zero, s, t = F.lit(0).cast("long"), F.col(_S), F.col(_T)
    return [
        F.coalesce(F.sum(s), zero).alias("source_rows"),
        F.coalesce(F.sum(t), zero).alias("target_before"),
        F.coalesce(F.sum(s), zero).alias("target_after"),
        F.coalesce(F.sum(F.when(t == 0, s)), zero).alias("to_insert"),
        F.coalesce(F.sum(F.when(s == 0, t)), zero).alias("to_delete"),
    ]


def _with_appended(counts: DataFrame) -> DataFrame:
    gained = F.col("target_after") - F.col("target_before")
    return counts.withColumn("appended", F.greatest(F.lit(0).cast("long"), gained))


def reconcile_all(tables: Mapping[str, tuple[DataFrame, DataFrame]], by: str = "fingerprint") -> DataFrame:
    """:func:`reconcile_counts` of many tables, name -> (source, target), as one plan with ``table_name``.

    By fingerprint the rows of all tables meet in one grouping by table and fingerprint, so many
    small tables share one shuffle and a large one is spread over all of it. A table without rows on
    both sides has no line there.
    """
    if by != "fingerprint":
        return reduce(DataFrame.unionByName, [
            reconcile_counts(source, target, by).withColumn("table_name", F.lit(name))
            for name, (source, target) in tables.items()])

    def side(df: DataFrame, name: str, s: int, t: int) -> DataFrame:
        return _keyed(df, by, True).withColumns({"table_name": F.lit(name), _S: F.lit(s), _T: F.lit(t)})

    sides = [part for name, (source, target) in tables.items() for part in (side(source, name, 1, 0), side(target, name, 0, 1))]
    copies = reduce(DataFrame.unionByName, sides).groupBy("table_name", _KEY).agg(F.sum(_S).alias(_S), F.sum(_T).alias(_T))
    return _with_appended(copies.groupBy("table_name").agg(*_side_counts()))


def snapshot_upsert(
    source: DataFrame, target: DataFrame, by: str = "columns", null_safe: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(new target, counts): the target becomes the source on the shared columns, copies kept."""
    new_target = overlap(target, source)
    if new_target is None:
        raise ValueError("source and target share no column")
    old_target = overlap(new_target, target)
    return new_target, reconcile_counts(new_target, old_target, by, null_safe)


def delta_totals(outcomes: DataFrame) -> DataFrame:
    """One row over the outcome table of a copy job: tables by outcome, rows appended."""
    return outcomes.agg(
        F.count_if(F.col("outcome") == "processed").alias("processed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"),
        F.count_if(F.col("outcome") == "failed").alias("failed"),
        F.coalesce(F.sum("appended"), F.lit(0).cast("long")).alias("total_rows_appended"),
    )

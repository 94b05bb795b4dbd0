"""Keyed insert-or-update for tables without a MERGE: as a join, or as a log of changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from time import time_ns

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import named
from ..storage import path_exists
from .files import replace_table


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    latest_by: str | None = None,
) -> DataFrame:
    """``target`` with ``changes`` merged in on ``keys``.

    A key in both keeps the target's values except for ``update_columns``; a new key is inserted
    whole. As with a unique constraint, a null in a key matches nothing. ``changes`` holds each key
    once, or ``latest_by`` names the column whose greatest value decides; that choice is an
    aggregate, so repeats of one key are combined before any shuffle.
    """
    columns = target.columns
    changes = changes.select(*[named(c) for c in columns])
    if latest_by is not None:
        rest = [c for c in columns if c not in keys]
        changes = (
            changes.groupBy(*[named(k) for k in keys])
            .agg(F.max(F.struct(named(latest_by).alias("_by"),
                                F.struct(*[named(c) for c in rest]).alias("_row"))).alias("_top"))
            .select(*[named(k) for k in keys], "_top._row.*")
            .select(*[named(c) for c in columns])
        )
    # Keys stay plain columns, so sides that are already partitioned by them are not shuffled again.
    old = target.select(*[named(c).alias(f"t{i}") for i, c in enumerate(columns)], F.lit(True).alias("known"))
    new = changes.select(*[named(c).alias(f"c{i}") for i, c in enumerate(columns)], F.lit(True).alias("changed"))
    same_key = reduce(Column.__and__, [
        F.col(f"t{columns.index(k)}") == F.col(f"c{columns.index(k)}") for k in keys])
    joined = old.join(new, same_key, "full_outer")

    def merged(i: int, name: str) -> Column:
        if name in update_columns:
            return F.when(F.col("changed"), F.col(f"c{i}")).otherwise(F.col(f"t{i}")).alias(name)
        return F.when(F.col("known"), F.col(f"t{i}")).otherwise(F.col(f"c{i}")).alias(name)

    return joined.select(*[merged(i, name) for i, name in enumerate(columns)])


@dataclass(frozen=True)
class ChangeLog:
    """A keyed table stored as the changes made to it, so that a step appends a few rows.

    A key's first row gives its values, its last one those of ``update_columns``; which is which is
    kept in a column of its own. A null in a key matches nothing, so such rows all stay. Appending
    never rewrites what is there; :meth:`compact` leaves one row for each key.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    update_columns: tuple[str, ...]

    #: When a row was appended. Rows without it, as a plain table has, are older than all others.
    SEQUENCE = "_appended_at"

    def append(self, changes: DataFrame) -> None:
        """Add ``changes``, which hold each key once."""
        rows = changes.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        rows.withColumn(self.SEQUENCE, F.lit(time_ns())).write.mode("append").parquet(self.path)

    def _folded(self) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(self.SEQUENCE, T.LongType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], stored)
        rows = self.spark.read.schema(stored).parquet(self.path).withColumn("_at", F.coalesce(self.SEQUENCE, F.lit(0)))
        whole = reduce(Column.__and__, [named(k).isNotNull() for k in self.keys])
        values = F.struct(*[named(c) for c in self.schema.names if c not in self.keys])
        folded = rows.where(whole).groupBy(*map(named, self.keys)).agg(
            F.min_by(values, "_at").alias("_first"), F.max_by(values, "_at").alias("_last"), F.max("_at").alias(self.SEQUENCE))
        folded = folded.select(*[
            named(c) if c in self.keys else F.col("_last" if c in self.update_columns else "_first")[c].alias(c)
            for c in self.schema.names], self.SEQUENCE)
        return folded.unionByName(rows.where(~whole).drop("_at"))

    def read(self) -> DataFrame:
        """The table as the changes so far make it: an aggregate that combines before it shuffles."""
        return self._folded().select(*map(named, self.schema.names))

    def compact(self) -> None:
        replace_table(self._folded(), self.path)

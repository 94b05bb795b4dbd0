"""Row filters and the semi joins that act as filters."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.naming import named
from ..storage import staged


def failing_rows(df: DataFrame, condition: str) -> DataFrame:
    """Rows a rule condition is TRUE for, that is, rows that fail the rule. NULL is not failing."""
    return df.filter(condition)


def all_null_rows(df: DataFrame) -> DataFrame:
    if not df.columns:
        return df.filter(F.lit(False))
    return df.filter(reduce(Column.__and__, [named(c).isNull() for c in df.columns]))


def include_exclude(
    df: DataFrame,
    column: str,
    include: Collection[str] | DataFrame | None = None,
    exclude: Collection[str] | DataFrame | None = None,
) -> DataFrame:
    """Rows with a non-blank key that is in ``include``, if given, and not in ``exclude``.

    Each set is a collection of values, which becomes part of the plan, or a one-column DataFrame,
    which is joined: the caller knows which of the two suits its size.
    """
    kept = df.filter(F.length(F.trim(named(column))) > 0)
    if include is not None:
        kept = _by_set(kept, column, include, "left_semi")
    if exclude is not None:
        kept = _by_set(kept, column, exclude, "left_anti")
    return kept


def _by_set(df: DataFrame, column: str, values, how: str) -> DataFrame:
    if not isinstance(values, DataFrame):
        values = [v for v in values if v is not None]
        inside = named(column).isin(*values) if values else F.lit(False)
        return df.filter(inside if how == "left_semi" else ~inside)
    keys = _stored_keys(values.toDF("_k"))
    return df.join(keys, named(column) == F.col("_k"), how)


def _stored_keys(keys: DataFrame) -> DataFrame:
    """Each key once, as a stored table.

    Repeats are folded before the shuffle. Storing the keys gives the join a known size to choose
    its strategy by, and a plain shuffle on either side where it has to shuffle, so that adaptive
    execution can split a hot key of the rows; it cannot do so above an aggregate.
    """
    return staged(keys.filter(F.col("_k").isNotNull()).distinct(), "keys")


def semi_join_normalized(
    left: DataFrame, right: DataFrame, key: str, right_key: str | None = None
) -> DataFrame:
    """Rows of ``left`` whose key, trimmed and in lower case, occurs in ``right``."""
    def normal(name: str) -> Column:
        return F.lower(F.trim(named(name)))

    keys = _stored_keys(right.select(normal(right_key or key).alias("_k")))
    return left.join(keys, normal(key) == F.col("_k"), "left_semi")

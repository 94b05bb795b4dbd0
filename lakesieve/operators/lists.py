"""Values of a key in ordinal order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import named


def ordered_list(
    df: DataFrame, key: str, order: str, value: str, name: str = "values"
) -> DataFrame:
    """(key, values): per key, the values sorted by ordinal, ties by value; nulls keep their place.

    One list has to fit into one row, as the columns of a table or the turns of a talk do. Repeats
    stay as often as they occur.
    """
    pair = F.struct(named(order).alias("o"), named(value).alias("v"))
    ordered = F.transform(F.array_sort(F.collect_list(pair)), lambda x: x["v"])
    return df.groupBy(named(key)).agg(ordered.alias(name))

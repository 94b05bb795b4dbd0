"""Safe references to columns with any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column called exactly ``name``: dots, spaces and backticks are part of the name."""
    return F.col(quoted(name))


def positional(df: DataFrame) -> DataFrame:
    """Rename columns to c0, c1, ... so that odd or repeated names cannot get in the way."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])

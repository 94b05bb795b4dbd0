"""Choosing and reading one ingestion partition.

The ``*_dir`` functions read partition values off the directory names (one listing, no job) and
suit datasets addressed by path; the others take any DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.naming import named
from ..storage import partition_dirs

PARTITION_COLUMN = "ingestion_ts"


def latest_partition(df: DataFrame, column: str = PARTITION_COLUMN) -> str | None:
    """Greatest value by string order, or None. One aggregate row reaches the driver."""
    return df.agg(F.max(named(column).cast("string")).alias("latest")).first()["latest"]


def resolve_partition(
    df: DataFrame, column: str = PARTITION_COLUMN, requested: str | None = None
) -> str | None:
    """``requested`` if it holds rows, None if it does not; the latest one without a request."""
    if requested is None:
        return latest_partition(df, column)
    return None if df.filter(named(column).cast("string") == requested).isEmpty() else requested


def latest_partition_dir(
    spark: SparkSession, root: str, column: str = PARTITION_COLUMN
) -> str | None:
    return max(partition_dirs(spark, root, column), default=None)


def resolve_partition_dir(
    spark: SparkSession, root: str, column: str = PARTITION_COLUMN, requested: str | None = None
) -> str | None:
    if requested is None:
        return latest_partition_dir(spark, root, column)
    if requested not in partition_dirs(spark, root, column):
        return None
    return None if read_partition(spark, root, requested, column).isEmpty() else requested


def read_partition(
    spark: SparkSession, root: str, value: str, column: str = PARTITION_COLUMN
) -> DataFrame:
    """One partition, without its partition column.

    Reads the partition's own directory, so the files of all the others are not even listed.
    """
    directory = partition_dirs(spark, root, column).get(value)
    if directory is None:
        raise ValueError(f"{root} has no partition {column}={value}")
    return spark.read.parquet(directory)

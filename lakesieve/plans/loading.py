"""Silver tables to their destination."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.files import read_table
from .copying import Schema


def load_job(
    spark: SparkSession, path: str, destination: Schema, table: str, mode: str = "overwrite"
) -> int:
    """Load one silver dataset and return its number of rows, counted while they are written; an
    empty one is skipped.

    The destination is a folder of Parquet tables or a database schema; anything else is refused.
    """
    if not (hasattr(destination, "replace") and hasattr(destination, "append")):
        raise ValueError(f"unknown destination: {destination!r}")
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    df = read_table(spark, path)
    if df.isEmpty():
        return 0
    written = Observation()
    counted = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if mode == "overwrite":
        destination.replace(counted, table)
    else:
        destination.append(counted, table)
    return written.get["rows"]

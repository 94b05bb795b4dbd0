"""JDBC sinks.

Spark writes each partition in one transaction, but not all partitions in one. A task that is
lost after its commit is run again, so an append can repeat rows when executors fail; overwriting
from a stored snapshot is safe to repeat.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..sources.jdbc import remote_name

BATCH_SIZE = 5_000
WRITERS = 8


def _writer(df, url, table, props, schema, mode, batch_size):
    return (df.write.format("jdbc").mode(mode)
            .option("url", url)
            .option("dbtable", remote_name(table, schema))
            .option("batchsize", batch_size)
            .options(**(props or {})))


def append_jdbc(
    df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None,
    schema: str | None = None, batch_size: int = BATCH_SIZE, writers: int = WRITERS,
) -> None:
    """Add rows to a remote table through at most ``writers`` connections.

    Rows are dealt to the writers by a shuffle, so that only the insert is that narrow.
    """
    (_writer(df.repartition(writers), url, table, props, schema, "append", batch_size)
     .option("numPartitions", writers)
     .save())


def overwrite_jdbc(
    df: DataFrame, url: str, table: str, props: Mapping[str, str] | None = None,
    schema: str | None = None, truncate: bool = False,
    batch_size: int = BATCH_SIZE, writers: int = WRITERS,
) -> None:
    """Replace a remote table through at most ``writers`` connections.

    ``truncate`` empties the table and keeps its definition and grants; otherwise it is dropped
    and created again.
    """
    (_writer(df.repartition(writers), url, table, props, schema, "overwrite", batch_size)
     .option("numPartitions", writers)
     .option("truncate", truncate)
     .save())

"""One reader for the three layers of the lake."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .files import read_table
from .jdbc import read_jdbc
from .partitions import PARTITION_COLUMN, read_partition

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LayerSource:
    """Where the layers live: folders for bronze and silver, a database schema for gold.

    ``gold_keys`` names, per table, the column its read is split on, into ``gold_parts`` parts.
    """

    bronze: str | None = None
    silver: str | None = None
    gold_url: str | None = None
    gold_schema: str = "raw_data"
    gold_props: Mapping[str, str] = field(default_factory=dict)
    gold_keys: Mapping[str, str] = field(default_factory=dict)
    gold_parts: int | None = None
    partition_column: str = PARTITION_COLUMN


def read_layer(
    spark: SparkSession, source: LayerSource, layer: str, table: str, partition: str | None = None
) -> DataFrame:
    """``table`` of one layer; ``partition`` narrows it to one ingestion slice where there are any."""
    if layer == "gold":
        if not source.gold_url:
            raise ValueError("the gold layer needs a JDBC url")
        return read_jdbc(spark, source.gold_url, table, source.gold_props, source.gold_schema,
                         partition_column=source.gold_keys.get(table), num_partitions=source.gold_parts)
    if layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    base = getattr(source, layer)
    if not base:
        raise ValueError(f"the {layer} layer needs a folder")
    path = f"{base.rstrip('/')}/{table}"
    if partition is None:
        return read_table(spark, path)
    return read_partition(spark, path, partition, source.partition_column)

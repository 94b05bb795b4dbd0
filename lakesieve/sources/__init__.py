"""Readers: files, partitions, catalog, JDBC, layers, sheet sets."""

from .files import read_catalog, read_landing, read_table
from .jdbc import count_jdbc, jdbc_columns, read_jdbc, read_jdbc_query
from .layers import LayerSource, read_layer
from .partitions import (
    latest_partition, latest_partition_dir, read_partition, resolve_partition,
    resolve_partition_dir,
)
from .sheets import read_layouts, read_sheet_dir, read_sheets

__all__ = [
    "LayerSource", "count_jdbc", "jdbc_columns", "latest_partition", "latest_partition_dir",
    "read_catalog", "read_jdbc", "read_jdbc_query", "read_landing", "read_layer", "read_layouts",
    "read_partition", "read_sheet_dir", "read_sheets", "read_table", "resolve_partition",
    "resolve_partition_dir",
]

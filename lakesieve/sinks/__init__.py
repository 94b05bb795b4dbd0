"""Writers: Parquet, result tables, landing files, JDBC, keyed upsert."""

from .files import (
    fit_partitions, land, read_results, replace_each, replace_table, silver_path, write_results, write_table,
)
from .jdbc import append_jdbc, overwrite_jdbc
from .upsert import ChangeLog, upsert

__all__ = [
    "ChangeLog",
    "append_jdbc", "fit_partitions", "land", "overwrite_jdbc", "read_results", "replace_each",
    "replace_table",
    "silver_path", "upsert", "write_results", "write_table",
]

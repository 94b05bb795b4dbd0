"""The registered queries: every operator over the driver's tables, with its SQL counterpart."""

from . import (  # noqa: F401  (importing a module registers its queries)
    columns, copies, gates, jobs, metrics, readers, rows, sheet_sets, writers,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""Composite jobs built from the operators."""

from .copying import JdbcSchema, LakeSchema, append_schema
from .landing import clean_to_silver, land_and_clean
from .loading import load_job
from .quality import quality_job
from .rule_checks import rules_job
from .workbooks import WORKBOOK_HEADERS, sheets_job

__all__ = [
    "JdbcSchema", "LakeSchema", "WORKBOOK_HEADERS", "append_schema", "clean_to_silver",
    "land_and_clean", "load_job", "quality_job", "rules_job", "sheets_job",
]

"""DataFrame operators: shaping, filtering, profiling, rules, reconciling, sheet unions."""

from .columns import (
    cast_if_present, dates_to_string, drop_null_columns, fill_defaults, overlap,
    standard_names, standardize_columns, with_constants,
)
from .filters import all_null_rows, failing_rows, include_exclude, semi_join_normalized
from .gate import GateResult, gate_report, validate_table
from .layouts import OUTPUT_TAG, OutputSet, SHEET_TAG, SheetLayout, layouts_of, prepare_layout, united_outputs
from .lists import ordered_list
from .merging import converted, merged_type
from .profile import duplicate_count, null_counts, profile, scorecard
from .reconcile import (
    delta_totals, reconcile_counts, rows_to_delete, rows_to_insert, snapshot_upsert,
)
from .rules import (
    DEFAULT_RULES, Rule, evaluate_all, evaluate_rules, evaluate_rules_isolated, load_rules,
    rules_by_table,
)
from .unions import each_sheet, prepare_sheet, union_by_category, union_sheets

__all__ = [
    "DEFAULT_RULES", "GateResult", "OUTPUT_TAG", "OutputSet", "Rule", "SHEET_TAG", "SheetLayout", "all_null_rows",
    "cast_if_present", "converted",
    "dates_to_string", "delta_totals", "drop_null_columns", "duplicate_count", "each_sheet",
    "evaluate_all", "evaluate_rules", "evaluate_rules_isolated", "failing_rows",
    "fill_defaults", "gate_report", "include_exclude", "layouts_of", "load_rules", "merged_type", "null_counts",
    "ordered_list", "overlap", "prepare_layout", "prepare_sheet", "profile", "reconcile_counts",
    "rows_to_delete", "rows_to_insert", "rules_by_table", "scorecard", "semi_join_normalized",
    "snapshot_upsert", "standard_names", "standardize_columns", "union_by_category",
    "union_sheets", "united_outputs", "validate_table", "with_constants",
]

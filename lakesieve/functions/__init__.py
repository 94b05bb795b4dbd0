"""Column expressions."""

from .hashing import row_hash, row_text, with_row_hash
from .text import (
    DEFAULT_KEYWORDS, checkpoint_code, fiscal_year, kebab_case, kebab_name, keyword_category,
    label_category, snake_case, snake_name, split_label, stored_code, strip_affix,
)

__all__ = [
    "DEFAULT_KEYWORDS", "checkpoint_code", "fiscal_year", "kebab_case", "kebab_name",
    "keyword_category", "label_category", "row_hash", "row_text", "snake_case", "snake_name",
    "split_label", "stored_code", "strip_affix", "with_row_hash",
]

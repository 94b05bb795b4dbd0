"""String expressions: case conversion, label parsing, keyword classification."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

_WORD_BREAK = "[^0-9a-zA-Z]+"

# A small default for the test tables; callers pass their own rules, first match wins.
DEFAULT_KEYWORDS: dict[str, list[str]] = {
    "Sales": ["order", "lineitem", "customer", "sale"],
    "Supply": ["supplier", "part"],
    "Geography": ["nation", "region"],
    "Activity": ["event", "click", "page", "conversation"],
    "Text": ["document", "label", "benchmark", "embedding"],
}


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _joined_words(c: ColumnOrName, mark: str) -> Column:
    replaced = F.regexp_replace(_col(c), _WORD_BREAK, mark)
    return F.lower(F.btrim(replaced, F.lit(mark)))


def snake_case(c: ColumnOrName) -> Column:
    """Runs of anything but ASCII letters and digits become ``_``; ends trimmed; lower case."""
    return _joined_words(c, "_")


def kebab_case(c: ColumnOrName) -> Column:
    """As :func:`snake_case`, with ``-``."""
    return _joined_words(c, "-")


def snake_name(name: str) -> str:
    """:func:`snake_case` for a name known when the plan is built, such as a column name."""
    return re.sub(_WORD_BREAK, "_", name).strip("_").lower()


def kebab_name(name: str) -> str:
    return re.sub(_WORD_BREAK, "-", name).strip("-").lower()


def fiscal_year(c: ColumnOrName) -> Column:
    """First ``FY`` plus two digits as written, in any case; empty string if there is none."""
    return F.regexp_extract(_col(c), r"(?iU)FY\d{2}", 0)


def split_label(c: ColumnOrName, names: Sequence[str] = ("museum_code", "fiscal_year")) -> list[Column]:
    """One column per name: the 1st, 2nd, ... token of the label, null when it has fewer."""
    tokens = F.split(_stripped(c), r"(?U)\s+")
    return [F.try_element_at(tokens, F.lit(i)).alias(name) for i, name in enumerate(names, start=1)]


def _stripped(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def label_category(c: ColumnOrName) -> Column:
    """``[letters] FY<digits>`` -> the letters in lower case, ``FY`` without letters, else ``OTHERS``."""
    pattern = r"(?iU)^([A-Za-z]+)?\s*(FY\d+)$"
    label = _stripped(c)
    letters = F.regexp_extract(label, pattern, 1)
    return (F.when(~F.coalesce(label.rlike(pattern), F.lit(False)), "OTHERS")
            .when(letters == "", "FY")
            .otherwise(F.lower(letters)))


def keyword_category(
    c: ColumnOrName,
    rules: Mapping[str, Sequence[str]] = DEFAULT_KEYWORDS,
    default: str = "Other",
) -> Column:
    """First category, in the order of ``rules``, with a keyword that is a substring of the text."""
    text = F.lower(_col(c))
    branches = [
        (reduce(Column.__or__, [F.contains(text, F.lit(word)) for word in words]), category)
        for category, words in rules.items() if words
    ]
    if not branches:
        return F.lit(default)
    chain = F.when(*branches[0])
    for condition, category in branches[1:]:
        chain = chain.when(condition, category)
    return chain.otherwise(default)


def checkpoint_code(source: ColumnOrName, key: ColumnOrName, sub_key: ColumnOrName | None = None) -> Column:
    """``source.key[.sub_key]`` with snake-cased parts; a null or empty sub-key drops out."""
    parts = [_col(source), snake_case(key)]
    if sub_key is not None:
        parts.append(snake_case(F.nullif(_col(sub_key), F.lit(""))))
    return F.concat_ws(".", *parts)


def stored_code(group: ColumnOrName, code: ColumnOrName) -> Column:
    """The code as kept in the checkpoint table: prefixed by the lower-cased group."""
    return F.concat_ws(".", F.lower(_col(group)), _col(code))


def strip_affix(c: ColumnOrName, prefix: str = "", suffix: str = "") -> Column:
    """Drop one leading ``prefix`` and one trailing ``suffix``."""
    text = _col(c)
    if prefix:
        text = F.regexp_replace(text, "^" + re.escape(prefix), "")
    if suffix:
        text = F.regexp_replace(text, re.escape(suffix) + r"\z", "")
    return text

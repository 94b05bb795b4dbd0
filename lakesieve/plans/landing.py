"""Landed records to silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.columns import drop_and_count
from ..operators.gate import GateResult, judged
from ..sinks.files import land, replace_table
from ..sources.files import read_landing


def silver_name(table: str) -> str:
    """Landed tables carry their format as a suffix; silver tables do not."""
    return table.removesuffix("_json")


def clean_to_silver(
    df: DataFrame,
    table: str,
    silver_base: str,
    required: Sequence[str] = ("id", "timestamp"),
    key: str = "id",
    on_invalid: str = "warn",
) -> tuple[str | None, GateResult]:
    """Drop empty columns, check, overwrite ``<silver_base>/<table>``: (path written, check).

    One aggregate finds the empty columns and the null keys. An empty table is skipped. A failed check is reported and the table still written, unless
    ``on_invalid="skip"``.
    """
    if on_invalid not in ("warn", "skip"):
        raise ValueError(f"on_invalid must be warn or skip, not {on_invalid!r}")
    cleaned, rows, values = drop_and_count(df)
    check = judged(list(values), rows, rows - values.get(key, 0), required, key)
    if check.rows == 0 or (on_invalid == "skip" and not check.passed):
        return None, check
    path = f"{silver_base.rstrip('/')}/{silver_name(table)}"
    replace_table(cleaned, path)
    return path, check


def land_and_clean(
    df: DataFrame,
    prefix: str,
    category: str,
    silver_base: str,
    fmt: str = "json",
    ts: str | None = None,
    required: Sequence[str] = ("id", "timestamp"),
    key: str = "id",
    on_invalid: str = "warn",
) -> tuple[str | None, GateResult]:
    """Land the records, read them back in their own schema and bring them to silver."""
    folder = land(df, prefix, category, fmt, ts)
    landed = read_landing(df.sparkSession, folder, fmt, df.schema)
    return clean_to_silver(landed, f"{category}_{fmt}", silver_base, required, key, on_invalid)

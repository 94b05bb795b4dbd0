"""The validation gate before a table moves on."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.naming import named


@dataclass(frozen=True)
class GateResult:
    passed: bool
    reason: str
    rows: int


def gate_report(df: DataFrame, required: Sequence[str] = ("id", "timestamp"), key: str = "id") -> DataFrame:
    """One row (passed, reason, row_count, null_keys): non-empty, then required columns present,
    then no null in the key; the first that fails is the reason. One aggregate over the key."""
    missing = next((c for c in required if c not in df.columns), None)
    null_keys = F.count_if(named(key).isNull()) if key in df.columns else F.lit(0).cast("long")
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), null_keys.alias("null_keys"))
    reason = F.when(F.col("row_count") == 0, "no records")
    if missing is not None:
        reason = reason.otherwise(f"missing column '{missing}'")
    elif key in df.columns:
        reason = reason.when(F.col("null_keys") > 0, f"null '{key}' values").otherwise("")
    else:
        reason = reason.otherwise(f"missing column '{key}'")
    return counted.select((reason == "").alias("passed"), reason.alias("reason"), "row_count", "null_keys")


def judged(columns: Sequence[str], rows: int, null_keys: int, required: Sequence[str], key: str) -> GateResult:
    """The check of :func:`gate_report` for a table that was counted already."""
    missing = next((c for c in [*required, key] if c not in columns), None)
    reason = ""
    if rows == 0:
        reason = "no records"
    elif missing is not None:
        reason = f"missing column '{missing}'"
    elif null_keys > 0:
        reason = f"null '{key}' values"
    return GateResult(reason == "", reason, rows)


def validate_table(
    df: DataFrame, required: Sequence[str] = ("id", "timestamp"), key: str = "id"
) -> GateResult:
    """:func:`gate_report` as a value, for code that has to branch on it."""
    row = gate_report(df, required, key).first()
    return GateResult(row["passed"], row["reason"], row["row_count"])

"""Row identity by SHA-256."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .naming import named

HASH_COLUMN = "hash_value"

# to_json cuts timestamps to milliseconds and drops null fields unless told otherwise.
EXACT_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType)


def _in_order(value: Column, kind: T.DataType) -> Column:
    """Maps as entries sorted by key, at any depth: equal maps have one text."""
    if not _holds_map(kind):
        return value
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _in_order(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_in_order(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    entries = F.array_sort(F.map_entries(value), lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0))
    return F.transform(entries, lambda e: F.struct(e["key"].alias("key"), _in_order(e["value"], kind.valueType).alias("value")))


def field_text(field: T.StructField) -> Column:
    """A value as text that keeps all of it: microseconds, inner nulls, raw bytes.

    Values that a GROUP BY takes as one have one text: 0.0 and -0.0, maps in any order.
    """
    value = named(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, "0.0").otherwise(value.cast("string"))
    if _holds_map(field.dataType):
        return F.to_json(_in_order(value, field.dataType), EXACT_JSON)
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(value, EXACT_JSON)
    if isinstance(field.dataType, T.BinaryType):
        return F.base64(value)
    return value.cast("string")


def row_text(fields: Sequence[T.StructField], null_safe: bool = True) -> Column:
    """All fields as one text.

    Null-safe: a JSON array of strings, so nulls keep their place and no separator inside the
    data can shift a value into the next column. Otherwise the values joined by two pipes with
    nulls left out, which lets different rows collide.
    """
    texts = [field_text(f) for f in fields]
    return F.to_json(F.array(*texts)) if null_safe else F.concat_ws("||", *texts)


def row_hash(fields: Sequence[T.StructField], null_safe: bool = True) -> Column:
    return F.sha2(row_text(fields, null_safe), 256)


def _fixed_text(kind: T.DataType) -> bool:
    """Whether the type's texts are never empty and hold no bar."""
    return isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType))


def row_fingerprint(fields: Sequence[T.StructField]) -> Column:
    """32 bytes that two rows share if and only if a GROUP BY takes them as one.

    The SHA-256 of an encoding that can be read back: first, between bars, the texts of numbers, dates
    and flags and the lengths of all other texts, with nothing for a null, then those texts one
    behind the other. That costs less than quoting them as :func:`row_text` does.
    """
    head, body = [], []
    for f in fields:
        text = field_text(f)
        if not _fixed_text(f.dataType):
            body.append(F.coalesce(text, F.lit("")))
            text = F.octet_length(text).cast("string")
        head.append(F.coalesce(text, F.lit("")))
    return F.unhex(F.sha2(F.concat_ws("|", *head, F.concat(*body) if body else F.lit("")), 256))


def with_row_hash(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    null_safe: bool = True,
    name: str = HASH_COLUMN,
) -> DataFrame:
    """Add the SHA-256 hex digest over ``columns`` (all by default), in that order."""
    fields = [df.schema[c] for c in columns] if columns is not None else df.schema.fields
    return df.withColumn(name, row_hash(fields, null_safe))

"""One type for values that are typed differently from table to table, nested ones included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def merged_type(types: Sequence[T.DataType]) -> T.DataType:
    """The type that holds the values of all ``types``.

    Numbers take the wider type, but text where a bigint or decimal meets a fraction and could lose
    digits; dates become timestamps beside these. Structs merge field by field (names without case,
    as in the first; fields that some lack are null there), arrays by their elements and maps by keys
    and values. What has no common type is text.
    """
    known = [t for t in types if not isinstance(t, T.NullType)]
    if not known:
        return types[0]
    if all(t == known[0] for t in known):
        return known[0]
    for kind, merge in ((T.StructType, _merged_struct), (T.ArrayType, _merged_array), (T.MapType, _merged_map)):
        if all(isinstance(t, kind) for t in known):
            return merge(known)
    if all(isinstance(t, T.IntegralType) for t in known):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in known):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in known):
            # A double holds 15 digits for sure; a bigint or decimal may have more.
            exact = any(isinstance(t, (T.LongType, T.DecimalType)) for t in known)
            return T.StringType() if exact else T.DoubleType()
        return T.DecimalType(38, max(t.scale for t in known if isinstance(t, T.DecimalType)))
    if all(isinstance(t, (T.DateType, T.TimestampNTZType)) for t in known):
        return T.TimestampNTZType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in known):
        return T.TimestampType()
    return T.StringType()


def _merged_struct(types: Sequence[T.StructType]) -> T.StructType:
    names: dict[str, str] = {}
    found: dict[str, list[T.DataType]] = {}
    for t in types:
        for f in t.fields:
            names.setdefault(f.name.lower(), f.name)
            found.setdefault(f.name.lower(), []).append(f.dataType)
    return T.StructType([T.StructField(name, merged_type(found[key])) for key, name in names.items()])


def _merged_array(types: Sequence[T.ArrayType]) -> T.ArrayType:
    return T.ArrayType(merged_type([t.elementType for t in types]))


def _merged_map(types: Sequence[T.MapType]) -> T.MapType:
    return T.MapType(merged_type([t.keyType for t in types]), merged_type([t.valueType for t in types]))


def converted(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``source`` as the type ``target`` that :func:`merged_type` gave for it."""
    if source == target:
        return value
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        own = {f.name.lower(): f for f in source.fields}
        fields = [
            (converted(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: converted(x, source.elementType, target.elementType)).cast(target)
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        pairs = F.transform(F.map_entries(value), lambda e: F.struct(
            converted(e["key"], source.keyType, target.keyType).alias("key"),
            converted(e["value"], source.valueType, target.valueType).alias("value")))
        return F.map_from_entries(pairs).cast(target)
    return value.cast(target)

"""Sheets that share a layout as one DataFrame, and the outputs they are united into."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.naming import named
from .merging import converted, merged_type
from .unions import column_difference, prepare_sheet

#: Columns that name the sheet a row is from and the output it goes to; sheets may not have them.
SHEET_TAG, OUTPUT_TAG = "__sheet__", "__output__"


@dataclass(frozen=True)
class SheetLayout:
    """Sheets with the same columns and types; ``SHEET_TAG`` of ``rows`` names the sheet."""

    sheets: tuple[str, ...]
    rows: DataFrame

    def columns(self) -> list[T.StructField]:
        return [f for f in self.rows.schema.fields if f.name != SHEET_TAG]


@dataclass(frozen=True)
class OutputSet:
    """Outputs with the same columns and types; ``OUTPUT_TAG`` of ``rows`` names the output."""

    outputs: tuple[str, ...]
    rows: DataFrame


def layouts_of(sheets: Mapping[str, DataFrame]) -> list[SheetLayout]:
    """The sheets grouped by layout, in the order of the first of each."""
    groups: dict[tuple, list[str]] = {}
    for name, df in sheets.items():
        if SHEET_TAG in df.columns or OUTPUT_TAG in df.columns:
            raise ValueError(f"sheet {name!r} has a column {SHEET_TAG!r} or {OUTPUT_TAG!r}")
        groups.setdefault(tuple((f.name, f.dataType.json()) for f in df.schema.fields), []).append(name)
    return [
        SheetLayout(tuple(names), reduce(
            DataFrame.unionAll, [sheets[n].withColumn(SHEET_TAG, F.lit(n)) for n in names]))
        for names in groups.values()
    ]


def prepare_layout(layout: SheetLayout, mapping: Mapping[str, str] | None = None) -> SheetLayout:
    """:func:`prepare_sheet` for all sheets of a layout at once."""
    return SheetLayout(layout.sheets, prepare_sheet(layout.rows, {**(mapping or {}), SHEET_TAG: SHEET_TAG}))


def _same_columns(a: Sequence[T.StructField], b: Sequence[T.StructField]) -> bool:
    return {f.name.lower() for f in a} == {f.name.lower() for f in b}


def _united_columns(layouts: Sequence[SheetLayout]) -> list[tuple[str, T.DataType]]:
    """Names as the first layout has them, those that only others have behind, and common types."""
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for layout in layouts:
        for f in layout.columns():
            names.setdefault(f.name.lower(), f.name)
            types.setdefault(f.name.lower(), []).append(f.dataType)
    return [(name, merged_type(types[key])) for key, name in names.items()]


def _in_columns(layout: SheetLayout, columns: Sequence[tuple[str, T.DataType]]) -> list[Column]:
    own = {f.name.lower(): f for f in layout.columns()}
    return [
        (converted(named(own[name.lower()].name), own[name.lower()].dataType, kind)
         if name.lower() in own else F.lit(None).cast(kind)).alias(name)
        for name, kind in columns
    ]


def united_outputs(
    layouts: Sequence[SheetLayout], output_of: Mapping[str, str], allow_missing: bool = False
) -> tuple[list[OutputSet], list[tuple[str, str]]]:
    """(the outputs, grouped by their columns, and (sheet, reason) of rejected sheets).

    ``output_of`` names each sheet's output and gives their order. The first sheet of an output
    fixes its columns; a sheet with others is rejected, unless ``allow_missing`` fills the gaps with
    nulls. Outputs with the same columns are one DataFrame with a branch for each layout, however
    many sheets there are.
    """
    by_sheet = {s: layout for layout in layouts for s in layout.sheets}
    accepted: dict[str, list[str]] = {}
    rejected = []
    for sheet, output in output_of.items():
        others = accepted.setdefault(output, [])
        if others and not allow_missing and not _same_columns(by_sheet[others[0]].columns(), by_sheet[sheet].columns()):
            rejected.append((sheet, column_difference(
                *({f.name.lower() for f in by_sheet[s].columns()} for s in (others[0], sheet)))))
        else:
            others.append(sheet)
    shapes: dict[tuple, dict[str, list[str]]] = {}
    columns_of: dict[tuple, list[tuple[str, T.DataType]]] = {}
    for output, sheets in accepted.items():
        columns = _united_columns([by_sheet[s] for s in sheets])
        shape = tuple((name, kind.json()) for name, kind in columns)
        columns_of[shape] = columns
        shapes.setdefault(shape, {})[output] = sheets
    return [_output_set(layouts, columns_of[shape], outputs) for shape, outputs in shapes.items()], rejected


def _output_set(
    layouts: Sequence[SheetLayout], columns: Sequence[tuple[str, T.DataType]], outputs: Mapping[str, list[str]]
) -> OutputSet:
    of_sheet = {s: output for output, sheets in outputs.items() for s in sheets}
    parts = []
    for layout in layouts:
        here = [s for s in layout.sheets if s in of_sheet]
        if here:
            rows = layout.rows if len(here) == len(layout.sheets) else layout.rows.where(named(SHEET_TAG).isin(here))
            parts.append(rows.select(*_in_columns(layout, columns), _looked_up(named(SHEET_TAG), of_sheet, here).alias(OUTPUT_TAG)))
    return OutputSet(tuple(outputs), reduce(DataFrame.unionByName, parts))


def _looked_up(key: Column, values: Mapping[str, str], keys: Iterable[str]) -> Column:
    """The value of ``key``; a plain constant where all keys have the same one."""
    pairs = {k: values[k] for k in keys}
    if len(set(pairs.values())) == 1:
        return F.lit(next(iter(pairs.values())))
    return F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))[key]


__all__ = ["OUTPUT_TAG", "OutputSet", "SHEET_TAG", "SheetLayout", "layouts_of", "prepare_layout",
           "united_outputs"]

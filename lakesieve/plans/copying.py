"""Copy every common table of one schema into another: append, or compare and replace."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Protocol

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..contracts import COPY_OUTCOME
from ..functions.naming import named
from ..operators.columns import overlap
from ..operators.filters import include_exclude
from ..operators.isolation import TABLE_ERRORS, raise_if_lost, run_isolated
from ..operators.reconcile import reconcile_all
from ..sinks.files import replace_table
from ..sinks.jdbc import append_jdbc, overwrite_jdbc
from ..sources.jdbc import count_jdbc, jdbc_columns, read_jdbc
from ..storage import WORK_FOLDER, child_names, path_exists, staged

log = logging.getLogger(__name__)


class Schema(Protocol):
    """A set of tables, wherever they are kept."""

    spark: SparkSession
    stable: bool

    def tables(self) -> list[str]: ...
    def read(self, table: str) -> DataFrame: ...
    def count(self, table: str) -> int: ...
    def append(self, df: DataFrame, table: str) -> None: ...
    def replace(self, df: DataFrame, table: str) -> None: ...


@dataclass(frozen=True)
class LakeSchema:
    """Parquet datasets below one folder."""

    spark: SparkSession
    root: str
    stable: bool = True

    def _path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def tables(self) -> list[str]:
        if not path_exists(self.spark, self.root):
            return []
        return [n for n in child_names(self.spark, self.root) if n != WORK_FOLDER]

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(table))

    def count(self, table: str) -> int:
        return self.read(table).count()

    def append(self, df: DataFrame, table: str) -> None:
        df.write.mode("append").parquet(self._path(table))

    def replace(self, df: DataFrame, table: str) -> None:
        replace_table(df, self._path(table))


@dataclass(frozen=True)
class JdbcSchema:
    """A database schema. ``keys`` names, per table, the column parallel reads are split on."""

    spark: SparkSession
    url: str
    schema: str
    props: Mapping[str, str] = field(default_factory=dict)
    keys: Mapping[str, str] = field(default_factory=dict)
    parts: int | None = None
    stable: bool = False

    def tables(self) -> list[str]:
        return sorted(jdbc_columns(self.spark, self.url, self.schema, self.props))

    def read(self, table: str) -> DataFrame:
        return read_jdbc(self.spark, self.url, table, self.props, self.schema,
                         partition_column=self.keys.get(table), num_partitions=self.parts)

    def count(self, table: str) -> int:
        return count_jdbc(self.spark, self.url, table, self.props, self.schema)

    def append(self, df: DataFrame, table: str) -> None:
        append_jdbc(df, self.url, table, self.props, self.schema)

    def replace(self, df: DataFrame, table: str) -> None:
        overwrite_jdbc(df, self.url, table, self.props, self.schema, truncate=True)


def _in_target_shape(rows: DataFrame, target: DataFrame) -> DataFrame:
    """Target columns in target types; those the source lacks are null."""
    return target.sparkSession.createDataFrame([], target.schema).unionByName(
        rows.select(*[named(c).cast(target.schema[c].dataType).alias(c) for c in rows.columns]),
        allowMissingColumns=True)


#: Tables that are read, staged or written at a time.
WORKERS = 8
_COUNTS = ("source_rows", "target_before", "target_after", "to_insert", "to_delete", "appended")


def _skipped(reason: str, **counts) -> dict:
    return {"outcome": "skipped", "message": reason, **counts}


class _Copy:
    """A copy job's tables, side by side: shared plans for what is counted, a bounded pool for the rest.

    A table whose data, schema or files break a step gets its outcome there and takes no part in the
    next one; a lost cluster stops the job.
    """

    def __init__(self, source: Schema, target: Schema) -> None:
        self.source, self.target, self.spark = source, target, source.spark
        self.outcomes: dict[str, dict] = {}

    def failed(self, table: str, error: Exception) -> None:
        raise_if_lost(self.spark, error)
        log.error("copying %s failed", table, exc_info=error)
        self.outcomes[table] = {"outcome": "failed", "message": str(error)}

    def each(self, step: Callable[[str], Any], tables: Iterable[str]) -> dict[str, Any]:
        """What ``step`` returns for each table it does not fail for; a dict with an outcome ends the table."""
        def guarded(table: str) -> Any:
            try:
                return step(table)
            except TABLE_ERRORS as error:
                self.failed(table, error)
                return None

        tables = list(tables)
        with ThreadPoolExecutor(WORKERS) as pool:
            results = dict(zip(tables, pool.map(guarded, tables), strict=True))
        found = {}
        for table, result in results.items():
            if isinstance(result, dict) and "outcome" in result:
                self.outcomes[table] = result
            elif result is not None:
                found[table] = result
        return found

    def counted(self, tables: Sequence[str], plan: Callable[[Sequence[str]], DataFrame]) -> dict[str, dict]:
        """The lines of a plan over many tables, by ``table_name``; a table that breaks it is set apart."""
        def on_error(table: str, error: Exception) -> list[Row]:
            self.failed(table, error)
            return []

        def run(part: Sequence[str]) -> list[Row]:
            try:
                return plan(part).collect()
            except TABLE_ERRORS as error:
                raise_if_lost(self.spark, error)
                raise

        lines = run_isolated(tables, run, on_error, TABLE_ERRORS)
        return {r["table_name"]: r.asDict() for r in lines}

    def row_counts(self, frames: Mapping[str, DataFrame], schema: Schema) -> dict[str, int]:
        """Rows of each table: one job for all files, and a count by the database for each of its tables."""
        if not schema.stable:
            return self.each(schema.count, frames)
        lines = self.counted(list(frames), lambda part: reduce(DataFrame.unionAll, [
            frames[t].select(F.lit(t).alias("table_name")) for t in part]).groupBy("table_name").agg(F.count("*").alias("n")))
        return {t: lines[t]["n"] if t in lines else 0 for t in frames if t not in self.outcomes}

    def pair(self, table: str) -> Any:
        """(source rows in the columns both have, target)."""
        old = self.target.read(table)
        rows = overlap(old, self.source.read(table))
        if rows is None:
            return _skipped("no overlapping columns")
        if not self.source.stable:
            # A database can change between two reads: keep one copy that all later steps share.
            rows = staged(rows, "snapshot")
        return rows, old

    def append(self, pairs: Mapping[str, tuple[DataFrame, DataFrame]], allow_empty: bool) -> None:
        files = LakeSchema(self.spark, "")  # what is left of a source by now are files
        rows = self.row_counts({t: new for t, (new, _) in pairs.items()}, files)
        before = self.row_counts({t: pairs[t][1] for t in rows}, self.target)

        def write(table: str) -> Any:
            if not rows[table] and not allow_empty:
                return _skipped("no rows in source", source_rows=0)
            # Counted while they are written: others may write to the target at the same time.
            new, old = pairs[table]
            written = Observation()
            self.target.append(_in_target_shape(new, old).observe(written, F.count(F.lit(1)).alias("rows")), table)
            return written.get["rows"]

        added = self.each(write, before)
        after = self.row_counts(self.each(self.target.read, added), self.target)
        for table, n in after.items():
            self.outcomes[table] = {
                "outcome": "processed", "message": "", "source_rows": added[table], "target_before": before[table],
                "target_after": n, "inserted": added[table], "deleted": 0, "appended": added[table]}

    def upsert(
        self, pairs: Mapping[str, tuple[DataFrame, DataFrame]], allow_empty: bool, allow_blank: bool, by: str
    ) -> None:
        sides, extra = {}, {}
        for table, (rows, old) in pairs.items():
            extra[table] = [c for c in old.columns if c not in rows.columns]
            new = rows.select(*[named(c).cast(old.schema[c].dataType).alias(c) for c in rows.columns])
            sides[table] = new, old.select(*[named(c) for c in new.columns])
        counts = self.counted(list(sides), lambda part: reconcile_all({t: sides[t] for t in part}, by))

        def write(table: str) -> Any:
            found = counts.get(table) or dict.fromkeys(_COUNTS, 0)
            if not found["source_rows"] and not allow_empty:
                return _skipped("no rows in source", source_rows=0)
            if extra[table] and not allow_blank:
                return _skipped("replacing would blank target columns: " + ", ".join(extra[table]))
            new, old = sides[table][0], pairs[table][1]
            self.target.replace(_in_target_shape(new, old) if extra[table] else new, table)
            return {"outcome": "processed", "message": "", "inserted": found["to_insert"], "deleted": found["to_delete"]} | {
                c: found[c] for c in ("source_rows", "target_before", "target_after", "appended")}

        self.each(write, [t for t in sides if t not in self.outcomes])


def append_schema(
    source: Schema,
    target: Schema,
    upsert: bool = False,
    include: Collection[str] | None = None,
    exclude: Collection[str] | None = None,
    allow_empty: bool = False,
    allow_blank: bool = False,
    by: str = "fingerprint",
) -> DataFrame:
    """Copy each source table the target has too; one outcome line per table.

    Append adds the source rows. ``upsert`` compares both sides row by row (``by`` fingerprint, or
    columns), counts what comes and goes, then makes the target a snapshot of the source. An empty
    source never empties a target unless ``allow_empty``, and target-only columns are not blanked by
    a replacement unless ``allow_blank``. An empty ``include`` means all tables.

    The tables are counted in one plan, in one grouping if rows are compared by fingerprint, and
    written WORKERS at a time. A table whose data or files fail does not stop the others.
    """
    spark = source.spark
    names = spark.createDataFrame([(t,) for t in source.tables()], "name string")
    chosen = [r["name"] for r in include_exclude(names, "name", include or None, exclude).orderBy("name").collect()]
    known = set(target.tables())
    job = _Copy(source, target)
    job.outcomes = {t: _skipped("target table not found") for t in chosen if t not in known}
    pairs = job.each(job.pair, [t for t in chosen if t in known])
    if upsert:
        job.upsert(pairs, allow_empty, allow_blank, by)
    else:
        job.append(pairs, allow_empty)
    lines = [Row(**{f: None for f in COPY_OUTCOME.names} | {"table_name": t} | job.outcomes[t]) for t in chosen]
    return spark.createDataFrame(lines, COPY_OUTCOME)

"""The rules job: evaluate business rules over the bronze tables that have any."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

from ..contracts import RULE_RESULT
from ..operators.isolation import TABLE_ERRORS, raise_if_lost, run_isolated
from ..operators.rules import evaluate_all, evaluate_rules_isolated, rules_by_table
from ..sinks.files import write_results
from ..sources.partitions import PARTITION_COLUMN, read_partition, resolve_partition_dir
from .copying import Schema


def _table_error(table: str, stamp: str, error: Exception, as_of: str) -> Row:
    values = (table, "table_processing_error", "Error occurred while processing table", "CRITICAL",
              as_of, stamp, "ERROR", 0, 0, 0.0, 100.0, str(error))
    return Row(**dict(zip(RULE_RESULT.names, values)))


def rules_job(
    spark: SparkSession,
    tables: Mapping[str, str],
    rules: DataFrame,
    requested: str | None = None,
    results_path: str | None = None,
    warehouse: Schema | None = None,
    as_of: str = "",
    partition_column: str = PARTITION_COLUMN,
) -> DataFrame:
    """Evaluate ``rules`` (as :func:`load_rules` gives them) over ``tables``, name -> folder.

    Tables without rules, and tables without the requested slice or any slice, are left out. All
    tables form one Spark plan with one scan each. If that breaks, the tables and then the rules
    at fault are singled out and become ERROR lines. The lines are also written to
    ``results_path`` and appended to table ``data_quality_rules`` of a ``warehouse``, where given.
    """
    by_table = rules_by_table(rules)
    slices: list[tuple[str, str]] = []
    rows: list[Row] = []
    for table, root in tables.items():
        if table.strip().lower() not in by_table:
            continue
        try:
            stamp = resolve_partition_dir(spark, root, partition_column, requested)
        except TABLE_ERRORS as error:
            raise_if_lost(spark, error)
            rows.append(_table_error(table, requested or "", error, as_of))
            continue
        if stamp is not None:
            slices.append((table, stamp))

    def read(table: str, stamp: str) -> DataFrame:
        return read_partition(spark, tables[table], stamp, partition_column)

    def run(part: Sequence[tuple[str, str]]) -> list[Row]:
        frames = {t: read(t, s) for t, s in part}
        return evaluate_all(frames, by_table, dict(part), as_of).collect()

    def on_error(item: tuple[str, str], error: Exception) -> list[Row]:
        table, stamp = item
        raise_if_lost(spark, error)
        if not isinstance(error, PySparkException):
            return [_table_error(table, stamp, error, as_of)]
        try:
            own = by_table[table.strip().lower()]
            return evaluate_rules_isolated(read(table, stamp), own, table, stamp, as_of).collect()
        except TABLE_ERRORS as final:
            raise_if_lost(spark, final)
            return [_table_error(table, stamp, final, as_of)]

    rows += run_isolated(slices, run, on_error, TABLE_ERRORS)
    results = spark.createDataFrame(rows, RULE_RESULT)
    if results_path is not None:
        write_results(results, results_path)
    if warehouse is not None and rows:
        warehouse.append(results, "data_quality_rules")
    return results

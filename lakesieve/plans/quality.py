"""The quality job: score the tables of one layer, or of all."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..contracts import SCORECARD
from ..functions.text import DEFAULT_KEYWORDS, keyword_category
from ..operators.columns import fill_defaults
from ..operators.isolation import TABLE_ERRORS, raise_if_lost, run_isolated
from ..operators.profile import scorecard
from ..sinks.files import write_results
from ..sources.layers import LAYERS, LayerSource, read_layer
from ..sources.partitions import resolve_partition_dir
from .copying import Schema

LAYER_COLUMN = "layer"


def _status_lines(spark, lines: Sequence[dict], keywords, as_of: str) -> DataFrame:
    """Lines for tables without metrics: no data, or an error."""
    rows = spark.createDataFrame(
        lines, "table_name string, ingestion_timestamp string, is_empty boolean, "
               "completeness_score double, uniqueness_score double, data_score double, "
               "processing_time_seconds double, processing_status string, error_message string")
    return fill_defaults(rows.withColumns({
        "category": keyword_category("table_name", keywords), "check_timestamp": F.lit(as_of),
    }), SCORECARD)


def _no_data(table: str, layer: str) -> dict:
    return {"table_name": table, "ingestion_timestamp": "N/A", "is_empty": True,
            "completeness_score": 1.0, "uniqueness_score": 1.0, "data_score": 100.0,
            "processing_time_seconds": 0.0, "processing_status": "NO_DATA",
            "error_message": f"No data found in {layer.upper()} layer"}


def _error(table: str, stamp: str | None, error: Exception, seconds: float) -> dict:
    return {"table_name": table, "ingestion_timestamp": stamp, "is_empty": False,
            "completeness_score": 0.0, "uniqueness_score": 0.0, "data_score": 0.0,
            "processing_time_seconds": seconds, "processing_status": "ERROR",
            "error_message": str(error)}


def _layer_lines(
    spark, source: LayerSource, layer: str, tables: Sequence[str], requested: str | None,
    record_missing: bool, keywords, as_of: str, by: str,
) -> list[Row]:
    slices: list[tuple[str, str | None]] = []
    rows: list[Row] = []
    for table in tables:
        if layer != "bronze":
            slices.append((table, None))
            continue
        try:
            stamp = resolve_partition_dir(
                spark, f"{source.bronze.rstrip('/')}/{table}", source.partition_column, requested)
        except TABLE_ERRORS as error:
            raise_if_lost(spark, error)
            rows += _status_lines(spark, [_error(table, requested, error, 0.0)], keywords, as_of).collect()
            continue
        if stamp is not None:
            slices.append((table, stamp))
        elif record_missing:
            rows += _status_lines(spark, [_no_data(table, layer)], keywords, as_of).collect()

    def run(part: Sequence[tuple[str, str | None]]) -> list[Row]:
        started = time.monotonic()
        frames = {t: read_layer(spark, source, layer, t, s) for t, s in part}
        found = scorecard(frames, dict(part), keywords, as_of, by).collect()
        # The tables of a part are scored side by side, so they share its elapsed time.
        seconds = round(time.monotonic() - started, 2)
        return [Row(**{**r.asDict(), "processing_time_seconds": seconds}) for r in found]

    def on_error(item: tuple[str, str | None], error: Exception) -> list[Row]:
        return _status_lines(spark, [_error(item[0], item[1], error, 0.0)], keywords, as_of).collect()

    # Tables that can't be opened are set apart first; after that only errors about data count.
    readable = []
    for table, stamp in slices:
        try:
            read_layer(spark, source, layer, table, stamp)
            readable.append((table, stamp))
        except TABLE_ERRORS as error:
            raise_if_lost(spark, error)
            rows += on_error((table, stamp), error)
    return rows + run_isolated(readable, run, on_error, PySparkException)


def quality_job(
    spark: SparkSession,
    source: LayerSource,
    tables: Mapping[str, Sequence[str]],
    layer: str = "bronze",
    requested: str | None = None,
    record_missing: bool = True,
    results_path: str | None = None,
    warehouse: Schema | None = None,
    keywords: Mapping[str, Sequence[str]] = DEFAULT_KEYWORDS,
    as_of: str = "",
    by: str = "fingerprint",
) -> DataFrame:
    """Score ``tables[layer]`` and return one line per table with its layer.

    ``layer="all"`` goes through bronze, silver and gold. In bronze the requested ingestion slice
    is scored, or the latest of each table; a table without one gets a NO_DATA line or, without
    ``record_missing``, none. All tables of a layer form one Spark plan; a table that fails gets
    an ERROR line. With ``results_path``, the lines are also written to ``<results_path>/<layer>``;
    with a ``warehouse``, appended to its table ``data_quality_results_<layer>``.
    """
    if layer != "all" and layer not in LAYERS:
        raise ValueError(f"unknown layer: {layer}")
    parts = []
    for current in LAYERS if layer == "all" else (layer,):
        names = [t for t in tables.get(current, ()) if t and t.strip()]
        rows = _layer_lines(spark, source, current, names, requested, record_missing, keywords, as_of, by)
        results = spark.createDataFrame(rows, SCORECARD)
        if results_path is not None and rows:
            write_results(results, f"{results_path.rstrip('/')}/{current}")
        if warehouse is not None and rows:
            warehouse.append(results, f"data_quality_results_{current}")
        parts.append(results.withColumn(LAYER_COLUMN, F.lit(current)))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionAll(part)
    return united

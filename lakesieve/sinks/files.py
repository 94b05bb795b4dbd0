"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import EXACT_JSON
from ..functions.naming import named
from ..sources.files import CSV_READ, CSV_WRITE, to_one_line
from ..storage import beside, delete_path, partition_dirs, path_exists, swap_in

LANDING_FORMATS = ("json", "csv")


def silver_path(base: str, file_name: str, category: str | None = None) -> str:
    """``<base>/<file_name>/[<category>/]``: one trailing slash, none doubled."""
    parts = [base.rstrip("/"), file_name] + ([category] if category else [])
    return "/".join(parts) + "/"


def write_table(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write Parquet. ``df`` must not read from ``path``; see :func:`replace_table`."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a Parquet dataset that ``df`` itself may be reading.

    The new data is written beside the old one and swapped in when it is complete.
    """
    staged = beside(path, "staged")
    df.write.mode("errorifexists").parquet(staged)
    swap_in(df.sparkSession, staged, path)


def replace_each(rows: DataFrame, column: str, paths: Mapping[str, str]) -> dict[str, int]:
    """Replace the dataset of every output that ``column`` names, in one write; rows per output.

    All outputs are written beside the first one, partitioned by ``column``, and swapped in one by
    one when they are complete, without that column. Rows are counted while they are written. The
    rebalancing before it gives each output few files and splits an output that is far larger than
    the others. An output without rows becomes an empty dataset.
    """
    spark = rows.sparkSession
    names = list(paths)
    marked = named(column)
    counts = Observation()
    staged = beside(paths[names[0]], "outputs")
    counted = rows.where(marked.isin(names)).hint("rebalance", marked).observe(
        counts, *(F.count_if(marked == name).alias(f"c{i}") for i, name in enumerate(names)))
    counted.write.mode("errorifexists").partitionBy(column).parquet(staged)
    written = partition_dirs(spark, staged, column)
    for name in names:
        if name in written:
            swap_in(spark, written[name], paths[name])
        else:
            replace_table(spark.createDataFrame([], rows.drop(column).schema), paths[name])
    delete_path(spark, staged)
    return {name: counts.get[f"c{i}"] for i, name in enumerate(names)}


def write_results(df: DataFrame, path: str, by: str = "table_name") -> None:
    """Persist result rows of any number of tables; only the tables in ``df`` are replaced."""
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(by)
     .parquet(path))


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Results in their declared schema; a typed empty table when nothing was written yet."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def land(
    df: DataFrame,
    prefix: str,
    category: str,
    fmt: str = "json",
    ts: str | None = None,
    partition_column: str = "ingestion_dt",
    refresh_latest: bool | None = None,
) -> str:
    """Write records to ``<prefix>/<fmt>/<partition_column>=<ts>/<category>``, or to ``latest``
    instead of the dated folder when ``ts`` is None. Returns the path written first.

    A dated JSON landing also refreshes ``latest``; for CSV that is off unless asked for. Colons
    in ``ts`` become dashes, since object paths with colons cannot be listed. In CSV a line break
    is written as a backslash and a letter, and a backslash as two characters too, so each line is
    a record and files can be split anywhere; :func:`read_landing` undoes it.
    """
    if fmt not in LANDING_FORMATS:
        raise ValueError(f"landing format must be one of {', '.join(LANDING_FORMATS)}, not {fmt!r}")
    base = f"{prefix.rstrip('/')}/{fmt}"
    latest = f"{base}/latest/{category}"
    folder = latest if ts is None else f"{base}/{partition_column}={ts.replace(':', '-')}/{category}"
    if fmt == "json":
        df.write.mode("overwrite").options(**EXACT_JSON).json(folder)
    else:
        to_one_line(df).write.mode("overwrite").options(**EXACT_JSON).options(**CSV_WRITE).csv(folder)
    if ts is not None and (fmt == "json" if refresh_latest is None else refresh_latest):
        _copy_landing(df, folder, latest, fmt)
    return folder


def _copy_landing(df: DataFrame, source: str, target: str, fmt: str) -> None:
    # Copies the text that was landed instead of computing the records a second time, and shows the
    # new "latest" only when it is complete.
    spark = df.sparkSession
    copy = beside(target, "staged")
    if fmt == "json":
        spark.read.text(source).write.text(copy)
    else:
        texts = T.StructType([T.StructField(name, T.StringType()) for name in to_one_line(df).columns])
        spark.read.schema(texts).options(**CSV_READ).csv(source).write.options(**CSV_WRITE).csv(copy)
    swap_in(spark, copy, target)


def fit_partitions(
    df: DataFrame,
    rows: int | None = None,
    rows_per_part: int = 50_000,
    min_parts: int = 10,
) -> DataFrame:
    """Bound the number of output files.

    With a known row count: ``rows // rows_per_part`` even partitions, at least ``min_parts``. Without one,
    a rebalance hint: adaptive execution then merges small partitions and splits large ones at the
    advisory size, and no counting pass is needed.
    """
    if rows is None:
        return df.hint("rebalance")
    return df.repartition(max(min_parts, rows // rows_per_part))

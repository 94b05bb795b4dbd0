"""JDBC reads: whole tables, remote queries, remote counts and column lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lists import ordered_list

FETCH_SIZE = 10_000


def remote_name(table: str, schema: str | None = None) -> str:
    """The table, and schema if given, quoted for the database."""
    parts = [schema, table] if schema else [table]
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts)


def _reader(spark: SparkSession, url: str, props: Mapping[str, str] | None):
    return (spark.read.format("jdbc")
            .option("url", url)
            .option("fetchsize", FETCH_SIZE)
            .options(**(props or {})))


def read_jdbc_query(
    spark: SparkSession, url: str, sql: str, props: Mapping[str, str] | None = None
) -> DataFrame:
    """Run a SELECT in the database and read its result."""
    return _reader(spark, url, props).option("dbtable", f"({sql}) AS t").load()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    props: Mapping[str, str] | None = None,
    schema: str | None = None,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """A whole remote table.

    The read is split over ``partition_column``, between its remote min and max, or into one task
    per condition in ``predicates``, which suits keys whose values are unevenly spread.
    ``num_partitions`` is the number of parts, by default the session's parallelism; the database
    has to bear as many connections. Without a column or predicates one task reads the table,
    whatever its size: only the caller knows a column that is indexed and evenly spread.
    """
    name = remote_name(table, schema)
    if predicates is not None:
        properties = {"fetchsize": str(FETCH_SIZE), **(props or {})}
        return spark.read.jdbc(url, name, predicates=list(predicates), properties=properties)
    reader = _reader(spark, url, props).option("dbtable", name)
    if partition_column is None:
        return reader.load()
    key = remote_name(partition_column)
    ends = read_jdbc_query(
        spark, url, f"SELECT min({key}) AS lo, max({key}) AS hi FROM {name}", props).toDF("lo", "hi")
    whole_numbers = isinstance(ends.schema["lo"].dataType, T.NumericType)
    bounds = ends.select(*[
        (F.col(c).cast("bigint") if whole_numbers else F.col(c)).cast("string").alias(c) for c in ends.columns
    ]).first()
    if bounds["lo"] is None:
        return reader.load()
    return (reader
            .option("partitionColumn", key)
            .option("lowerBound", bounds["lo"])
            .option("upperBound", bounds["hi"])
            .option("numPartitions", num_partitions or spark.sparkContext.defaultParallelism)
            .load())


def count_jdbc(
    spark: SparkSession, url: str, table: str,
    props: Mapping[str, str] | None = None, schema: str | None = None,
) -> int:
    """``count(*)`` evaluated by the database; one row comes back."""
    sql = f"SELECT count(*) AS c FROM {remote_name(table, schema)}"
    return int(read_jdbc_query(spark, url, sql, props).first()[0])


def jdbc_columns(
    spark: SparkSession, url: str, schema: str, props: Mapping[str, str] | None = None
) -> dict[str, list[str]]:
    """Table -> column names in ordinal order, from the database's catalog."""
    literal = schema.replace("'", "''")
    catalog = read_jdbc_query(
        spark, url,
        "SELECT table_name, column_name, ordinal_position FROM information_schema.columns "
        f"WHERE table_schema = '{literal}'", props,
    ).toDF("table_name", "column_name", "ordinal_position")
    lists = ordered_list(catalog, "table_name", "ordinal_position", "column_name", name="columns")
    return {r["table_name"]: r["columns"] for r in lists.orderBy("table_name").collect()}

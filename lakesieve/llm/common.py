"""What the training-data operators share: clean inputs, tables of known size, compact filters."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesieve.functions.naming import named
from lakesieve.storage import staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows of the table that a slot filter broadcasts, whatever it is built from: 64 bits each.
SLOTS = 65_536
SLOT = f"CAST((__h >> 6) & {SLOTS - 1} AS INT)"


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty one; other columns can't clash any more."""
    return df.select(named(id_col).alias("doc_id"),
                     F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def slots(keys: DataFrame, key: str) -> DataFrame:
    """The bits (__slot, __bits) that the 64-bit hashes ``keys[key]`` set: at most SLOTS rows."""
    return keys.select(F.col(key).alias("__h")).where("__h IS NOT NULL").groupBy(F.expr(SLOT).alias("__slot")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(__h & 63 AS INT)))").alias("__bits"))


def slot_filter(df: DataFrame, hashed: Column, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose 64-bit hash may be in ``keys[key]``; no row that is there gets lost.

    The hashes of ``keys`` set bits in a table of SLOTS longs. Its size is the same whatever
    ``keys`` holds, so it can be broadcast; with more keys it only lets more rows through.
    """
    bits = slots(keys, key)
    return (
        df.withColumn("__h", hashed)
        .withColumn("__at", F.expr(SLOT))
        .join(F.broadcast(bits), F.col("__at") == F.col("__slot"))
        .where("(shiftright(__bits, CAST(__h & 63 AS INT)) & 1L) = 1L")
        .drop("__h", "__at", "__slot", "__bits")
    )


def only_keys(df: DataFrame, hashed: Column, keys: DataFrame, key: str, key_hash: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``keys``, which holds each key once, with its 64-bit hash.

    Most others go by the slot filter, before the shuffle. It is an inner join, as the optimizer moves
    a semi-join to below the filter, where all rows would be shuffled.
    """
    return slot_filter(df, hashed, keys, key_hash).join(keys.select(key), key).select(df.columns)


#: Bits of a row's number that hold its place in its file; the file's own number is above them.
PLACE_BITS = 40


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` and ``row``, a number of its own for each row that is the same in every scan.

    Rows of Parquet files are numbered by their file and their place in it, so nothing is copied;
    the files' names and numbers are broadcast, a line for each file that the driver has listed
    already. They are an Arrow table, which needs no Python worker, as rows of Python do: executors
    would start workers of another kind for those. Rows that come from anything else are written
    once with a number.
    """
    if not _is_parquet_scan(docs):
        return staged(docs.withColumn("row", F.monotonically_increasing_id()), "numbered")
    paths = sorted(r[0] for r in docs.select(F.col("_metadata.file_path").alias("path")).distinct().collect())
    files = docs.sparkSession.createDataFrame(pa.table(
        {"__file": pa.array(range(len(paths)), pa.int64()), "__path": pa.array(paths, pa.string())}))
    return (
        docs.select("*", F.col("_metadata.file_path").alias("__of"), F.col("_metadata.row_index").alias("__place"))
        .join(F.broadcast(files), F.col("__of") == F.col("__path"))
        .select(*map(named, docs.columns), F.expr(f"shiftleft(__file, {PLACE_BITS}) | __place").alias("row"))
    )


def _is_parquet_scan(docs: DataFrame) -> bool:
    """Whether the rows are those of Parquet files, columns and filters aside."""
    plan = docs._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return False
    try:
        return bool(docs.select("_metadata.file_path", "_metadata.row_index").columns)
    except AnalysisException:
        return False


def drop_ids(docs: DataFrame, gone: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``gone``; a null key is a key like others.

    Rows that can't be among them pass by the slot filter unshuffled; the others are anti-joined.
    """
    gone = staged(gone.distinct().select(F.col(key).alias("__gone"), F.xxhash64(key).alias("__key")), "gone")
    bits = slots(gone, "__key")
    marked = docs.withColumn("__h", F.xxhash64(key)).withColumn("__at", F.expr(SLOT)).join(
        F.broadcast(bits), F.col("__at") == F.col("__slot"), "left")
    hit = F.coalesce(F.expr("(shiftright(__bits, CAST(__h & 63 AS INT)) & 1L) = 1L"), F.lit(False))
    stay = marked.where(~hit).select(docs.columns)
    doubtful = marked.where(hit).join(gone, F.col(key).eqNullSafe(F.col("__gone")), "left_anti").select(docs.columns)
    return stay.unionByName(doubtful)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts at a time become Python objects.

    Workers outlive their tasks, so what is not in use goes back at the end.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """What a worker and its Arrow pool have freed goes back to the system, where the C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def shrink_heaps(spark: SparkSession) -> None:
    """Executors collect their garbage and give back what heap they don't use.

    A JVM keeps the heap of its busiest time, though the stages after it may need the room for Python
    workers. A task for each core asks for it; one that a busy executor misses costs nothing but room.
    """
    cores = spark.sparkContext.defaultParallelism
    asked = spark.range(0, cores, 1, cores).selectExpr("reflect('java.lang.System', 'gc')")
    asked.write.format("noop").mode("overwrite").save()


#: Arrow batches that carry texts hold so many rows and bytes at most, so that a worker and the buffers
#: that feed it stay small whatever the length of the texts.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings with ``values``, which go back to what they were at the end."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged_texts(df: DataFrame, label: str) -> DataFrame:
    """``staged`` for rows that Python functions make of texts."""
    with settings(df.sparkSession, BATCHES):
        return staged(df, label)


def map_texts(rows: DataFrame, columns: str, fn: Callable[[list[str]], list[list]]) -> DataFrame:
    """(doc_id, text) -> doc_id and ``columns``; ``fn`` gets the texts of an Arrow batch.

    It returns one list per column. Batches are a bounded number of rows, whatever a task reads.
    """
    added = T._parse_datatype_string(columns)
    schema = T.StructType([rows.schema["doc_id"], *added.fields])
    types = [_arrow_type(f.dataType) for f in added.fields]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = fn(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(found, types, strict=True))],
                names=schema.names)

    return rows.select("doc_id", "text").mapInArrow(mapped, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
            T.BooleanType: pa.bool_(), T.StringType: pa.string(), T.BinaryType: pa.binary()}[type(kind)]


__all__ = ["ascii_lower", "drop_ids", "give_back", "id_and_text", "map_texts", "named", "numbered", "only_keys", "settings",
           "shrink_heaps", "slices", "slot_filter", "staged", "staged_texts"]

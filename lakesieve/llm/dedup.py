"""Exact dedup as a stream: keyed state on disk remembers every text ever seen, without expiry.

Arriving rows carry the digest of their text. A streaming aggregate keeps, per digest, the stable
identifier that stays, where its content lies and how many rows had the digest. The state lives in
RocksDB on the executors' disks and in the checkpoint folder, so a lost executor costs a reload.
Rows that hit a digest are compared with the kept row's text byte by byte before they count as
copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.storage import scratch_path

from .common import ascii_lower, id_and_text, settings, slot_filter, staged

#: State on disk; files grow as they are written, as many partitions may hold little each. All stores
#: of an executor share one bound of memory, their buffers start small, and stores of a stream that
#: has ended are closed soon.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def normal_text(text: Column) -> Column:
    """What makes texts equal: A-Z in lower case, all else as it is; null is the empty text."""
    return ascii_lower(F.coalesce(text, F.lit("")))


def arrivals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, doc_id, locator) of a batch or streaming table; the locator is the file it came from."""
    rows = id_and_text(docs, id_col, text_col)
    return rows.select(
        F.sha2(normal_text(F.col("text")), 256).alias("digest"), "doc_id",
        F.input_file_name().alias("locator"),
    )


#: Rows for each store of the state; with fewer there are fewer stores than shuffle partitions.
ROWS_PER_STORE = 20_000


def remember(arriving: DataFrame, state_dir: str, stores: int | None = None) -> DataFrame:
    """Feed all that has arrived into the state in ``state_dir`` and return the state.

    ``arriving`` is a streaming table of ``arrivals``. A later call with the same folder goes on
    where this one ended, with as many ``stores`` as the first (the session's shuffle partitions, if
    not given). Hot digests are pre-aggregated per task before the shuffle.
    Returns (digest, keep_id, keep_locator, group_size) over everything since the folder was new.
    """
    spark = arriving.sparkSession
    kept = arriving.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")), F.count("*"))
    parts = {} if stores is None else {"spark.sql.shuffle.partitions": str(stores)}
    with settings(spark, STATE_STORE | parts):
        stream = (
            kept.writeStream.outputMode("update").format("noop").trigger(availableNow=True)
            .option("checkpointLocation", state_dir).start()
        )
        stream.awaitTermination()
        state = spark.read.format("statestore").load(state_dir)
    return state.selectExpr(
        "key.digest", "value.max.doc_id AS keep_id", "value.max.locator AS keep_locator", "value.count AS group_size")


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 256,
) -> DataFrame:
    """One row per row of ``docs``: which of the equal texts stays.

    Returns (doc_id, keep_id, group_size, kept, text_sha256, keep_locator). Equal texts are the
    same after lower-casing A-Z; null counts as empty. The largest doc_id stays (a null id only
    where all are null), and every row that carries it; group_size counts rows. An empty table
    gives an empty result. ``bits`` is the digest's length; with fewer bits more texts share a
    digest, which costs time but changes no result.
    """
    spark = docs.sparkSession
    short = f"substr(digest, 1, {bits // 4})"
    folder = scratch_path(spark, "arrivals")
    arriving = arrivals(docs, id_col, text_col)
    arriving.write.parquet(folder)
    landed = spark.read.schema(arriving.schema).parquet(folder)
    stream = spark.readStream.schema(arriving.schema).parquet(folder)
    stores = min(1 + landed.count() // ROWS_PER_STORE, int(spark.conf.get("spark.sql.shuffle.partitions")))
    state = staged(remember(stream.selectExpr(f"{short} AS digest", "doc_id", "locator"),
                            scratch_path(spark, "dedup-state"), stores), "dedup-kept")

    # Full bytes of all hits: the smallest and the largest text of a digest are one text, or else
    # different texts met. Both are pre-aggregated per task, so copies don't travel.
    shared = state.where("group_size > 1")
    texts = id_and_text(docs, id_col, text_col).select("doc_id", normal_text(F.col("text")).alias("text"))
    hits = slot_filter(
        texts.withColumn("digest", F.expr(f"substr(sha2(text, 256), 1, {bits // 4})")),
        F.xxhash64("digest"), shared.select(F.xxhash64("digest").alias("h")), "h",
    )
    ends = hits.groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    met = staged(ends.where("low <> high").select("digest"), "dedup-met")

    rows = landed.selectExpr("doc_id", "digest AS text_sha256", f"{short} AS digest")
    if met.isEmpty():
        found = rows.join(state, "digest")
    else:
        parts = (
            texts.withColumn("digest", F.expr(f"substr(sha2(text, 256), 1, {bits // 4})"))
            .withColumn("locator", F.input_file_name()).join(met, "digest")
            .groupBy("text").agg(F.max(F.struct("doc_id", "locator")).alias("keep"),
                                 F.count("*").alias("group_size"))
            .selectExpr("sha2(text, 256) AS text_sha256", "keep.doc_id AS keep_id",
                        "keep.locator AS keep_locator", "group_size")
        )
        found = rows.join(met, "digest", "left_anti").join(state, "digest").unionByName(
            rows.join(met, "digest", "left_semi").join(parts, "text_sha256"))
    return found.selectExpr("doc_id", "keep_id", "group_size", "doc_id <=> keep_id AS kept",
                            "text_sha256", "keep_locator")


ORACLE = """
WITH rows AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                             'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM rows WINDOW same AS (PARTITION BY t)
"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).drop("keep_locator")

"""A training corpus from raw documents, in five stages. Each keeps the columns of documents.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns a DataFrame,
which is written as Parquet and read again as the next stage's docs. A stage numbers its rows and
decides on each by itself: a repeated or null doc_id ties no rows together. Null and empty texts go
with the first stage, as they have no letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesieve.llm import bpe, decontam, dedup, langid, near_dup
from lakesieve.llm.common import drop_ids, named, numbered, shrink_heaps, staged_texts
from lakesieve.storage import scratch_space, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(docs: DataFrame) -> DataFrame:
    shrink_heaps(docs.sparkSession)  # of what the stage before has left
    return numbered(docs.select(*map(named, COLUMNS)))


def _without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    return drop_ids(rows, gone, "row").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; those without a letter or far from every model go."""
    rows = _rows(docs)
    with scratch_space(spark) as space:
        found = langid.identify(rows, ~langid.held_out(), "row")
        gone = space.keep(found.where("rejected").selectExpr("doc_id AS row"), "rejected")
    return _without(rows, gone)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) one row stays, with the largest doc_id (null: if all are)."""
    rows = _rows(docs)
    with scratch_space(spark) as space:
        found = dedup.exact_dedup(rows.select(F.struct("doc_id", "row").alias("doc_id"), "text"))
        gone = space.keep(found.where("NOT kept").selectExpr("doc_id.row AS row"), "copies")
    return _without(rows, gone)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links of similarity 0.8 connect one stays, with the smallest doc_id (null: if all are)."""
    rows = _rows(docs)
    with scratch_space(spark) as space:
        found = near_dup.near_duplicates(rows, "row").selectExpr("doc_id AS row", "component_id AS component")
        linked = staged(found.where("row <> component"), "near-linked")
        members = linked.unionByName(linked.selectExpr("component AS row", "component").distinct())
        keep = members.join(rows.select("row", "doc_id"), "row").groupBy("component").agg(
            F.min(F.struct(F.isnull("doc_id"), "doc_id", "row")).alias("least"))
        keep = staged(keep.selectExpr("least.row AS row"), "near-kept")
        gone = space.keep(members.select("row").join(keep, "row", "left_anti"), "near-copies")
    return _without(rows, gone)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least a twentieth of the words is in passages of the benchmark go."""
    rows = _rows(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    with scratch_space(spark) as space:
        judged = decontam.decontaminate(rows, benchmark, "row")
        gone = space.keep(judged.where("contaminated").selectExpr("doc_id AS row"), "contaminated")
    return _without(rows, gone)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens and the digests of the ids and of the bytes they decode to.

    They are stored, as only here and not where they are written the size of Arrow batches can be set:
    the workers come after those of other stages, and have little room.
    """
    import public_tokenizers

    shrink_heaps(spark)
    found = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                             False, bpe.MEMORY // 2)
    return staged_texts(found, "tokens")


STAGES = [
    ("language", identify_language),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("tokens", encode),
]

#: Language models and BPE are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scratch_space(spark) as space:
            docs = space.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""What each of five filters removes in every order: contingency tensors and their contractions.

Spark reduces the documents of a part to counts by the set of filters they fail: at most 32 numbers,
a 2 x 2 x 2 x 2 x 2 tensor with an axis for each filter, 0 for pass and 1 for fail. Whatever is asked
of a step is a contraction of it that takes pass, fail or all along each axis.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, staged

FILTERS = "ABCDE"
#: A: fewer words. B: fewer distinct words in percent. C: more capitals in percent. D: any of these.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 200, 50, 2, "[#$%&*|]"
BLANKS = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What a contraction takes along an axis.
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
_ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Filter and those before it, for each order and step.
_STEPS = [(order[k], order[:k]) for order in _ORDERS for k in range(len(FILTERS))]
_COUNTS = ("n", "good", "toxic")
RESULT = ("part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def _fails(text: Column) -> dict[str, Column]:
    """The filters that look at a text alone. An empty text only fails A."""
    words = F.array_remove(F.split(text, BLANKS), "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * capitals > MOST_CAPITALS * F.length(text),
        "D": text.rlike(MARKS),
    }


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def contingency(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, pattern, n, good, toxic): documents by part and by the filters they fail, as bits.

    Texts travel nowhere: a row becomes its pattern, the SHA-256 of its text and its id. The first
    id of each text that is there more than once and the marked ids are stored tables, so that a
    text or id with very many rows is a join that Spark can split.
    """
    text = F.coalesce(named("text").cast("string"), F.lit(""))
    alone = sum((F.when(c, _bit(f)).otherwise(0) for f, c in _fails(text).items()), F.lit(0))
    rows = staged(docs.select(
        named("doc_id").alias("doc_id"), F.coalesce(named("source").cast("string"), F.lit("")).alias("part"),
        alone.alias("alone"), F.unhex(F.sha2(text, 256)).alias("digest")), "audit-rows")
    firsts = staged(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
                    .where("copies > 1").select("digest", "first"), "audit-firsts")
    marked = labels.groupBy(named("doc_id").alias("doc_id")).agg(
        F.max(F.expr("quality <=> 1").cast("int")).alias("good"), F.max(F.expr("toxic <=> 1").cast("int")).alias("toxic"))
    marked = staged(marked.where("doc_id IS NOT NULL AND good + toxic > 0"), "audit-marked")
    copy = F.when(F.col("doc_id") > F.col("first"), _bit("E")).otherwise(0)
    return (
        rows.join(firsts, "digest", "left").join(marked, "doc_id", "left")
        .groupBy("part", (F.col("alone") + copy).alias("pattern"))
        .agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
             F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    )


def _selectors(taken: list[dict[str, tuple[int, int]]]) -> list[np.ndarray]:
    """Per axis a matrix with a row of (pass, fail) for each contraction; axes not named take all."""
    return [np.array([t.get(f, ALL) for t in taken], np.int64) for f in FILTERS]


def contract(tensor: np.ndarray, taken: list[dict[str, tuple[int, int]]]) -> np.ndarray:
    """A row of counts for each of the contractions ``taken`` of a tensor whose last axis is counts."""
    return np.einsum("abcdex,ra,rb,rc,rd,re->rx", tensor, *_selectors(taken), optimize="greedy")


_REMOVED = [{f: FAIL} | dict.fromkeys(before, PASS) for f, before in _STEPS]
_KEPT = [dict.fromkeys(before + f, PASS) for f, before in _STEPS]
_FAILED = [{f: FAIL} for f, _ in _STEPS]
_ONLY = [dict.fromkeys(FILTERS, PASS) | {f: FAIL} for f, _ in _STEPS]


def _audited(part: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of a part, from at most 32 rows."""
    tensor = np.zeros((2,) * len(FILTERS) + (len(_COUNTS),), np.int64)
    for row in part.itertuples():
        tensor[tuple(row.pattern >> k & 1 for k in range(len(FILTERS)))] = [getattr(row, c) for c in _COUNTS]
    removed = contract(tensor, _REMOVED)
    letters = np.array([f for f, _ in _STEPS])
    shapley = {f: int(removed[letters == f, 0].sum()) for f in FILTERS}
    return pd.DataFrame({
        "part": part["part"].iloc[0],
        "filter_order": np.repeat(_ORDERS, len(FILTERS)),
        "step": np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(_ORDERS)),
        "filter": letters,
        "kept": contract(tensor, _KEPT)[:, 0],
        "removed": removed[:, 0],
        "redundant": contract(tensor, _FAILED)[:, 0] - removed[:, 0],
        "unique_fails": contract(tensor, _ONLY)[:, 0],
        "good_lost": removed[:, 1],
        "toxic_lost": removed[:, 2],
        "shapley": [shapley[f] for f in letters],
    })


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part of ``docs`` (its source; null: the empty string), order of filters and step.

    A text counts whole, null as the empty one, which fails A alone. Of rows with one text those
    fail E whose doc_id is larger than the smallest; rows that share that id pass, and so do rows
    without an id, which have no labels either. Labels that are there more than once count as the
    largest, null ones not at all. Repeated rows count each; other columns are ignored. An empty
    table has no part and so no row.
    """
    return contingency(docs, labels).groupBy("part").applyInPandas(_audited, RESULT)


ORACLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), judged AS (
    SELECT doc_id, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, t,
           min(doc_id) OVER (PARTITION BY t) AS first_id
    FROM texts
), patterns AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
           || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
           || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
           || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
           || CASE WHEN judged.doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM judged LEFT JOIN marks ON judged.doc_id = marks.doc_id
), counted AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM patterns GROUP BY ALL
), letters(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT v.c || w.c || x.c || y.c || z.c AS filter_order
    FROM letters v, letters w, letters x, letters y, letters z
    WHERE len(list_distinct([v.c, w.c, x.c, y.c, z.c])) = 5
), steps AS (
    SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, CAST(k AS INTEGER), 1) AS filter,
           substr(filter_order, 1, CAST(k AS INTEGER) - 1) AS before
    FROM orders, range(1, 6) r(k)
), found AS (
    SELECT part, filter_order, step, filter,
           sum(CASE WHEN translate(fails, before || filter, '') = fails THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN contains(fails, filter) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN contains(fails, filter) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = filter THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN contains(fails, filter) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN contains(fails, filter) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
    FROM counted, steps GROUP BY ALL
)
SELECT part, filter_order, step, filter, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM found
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

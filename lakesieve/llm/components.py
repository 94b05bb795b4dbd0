"""Connected components of a link table, by stars: every job is a group-by and a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


#: Links that one task writes.
ROWS_PER_PART = 500_000


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); the component is its smallest node.

    Large and small stars take turns until no link changes: each node's larger neighbours are
    hung on its smallest one, then its smaller ones with itself. That takes a logarithmic number
    of rounds, each stored in the shared folder. Minima are pre-aggregated and stored before they are
    joined: Spark then knows their size, and where it shuffles it can split the links of a hub.
    """
    stars = staged(_ordered(links), "links")
    before, parts = None, None
    while True:
        now = stars.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        parts = 1 + now[0] // ROWS_PER_PART  # shuffles may be far wider than the links need
        if now == before:
            return stars.selectExpr("b AS node", "a AS component").unionByName(
                stars.selectExpr("a AS node", "a AS component")).distinct()
        before = now
        both = stars.unionByName(stars.selectExpr("b AS a", "a AS b"))
        large = _ordered(_hung(both).where("b > a").selectExpr("low AS a", "b"))
        stars = staged(large.coalesce(parts), "links")
        small = _hung(stars.selectExpr("b AS a", "a AS b"))  # a now the larger end
        small = small.selectExpr("low AS a", "b").unionByName(small.selectExpr("low AS a", "a AS b"))
        stars = staged(_ordered(small).coalesce(parts), "links")


def _hung(links: DataFrame) -> DataFrame:
    """``links`` with ``low``, the smallest of a and its neighbours b."""
    low = links.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    return links.join(staged(low, "low"), "a")


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()

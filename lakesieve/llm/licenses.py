"""Licence scan by canonical digest: a text is a known licence if its normal form is one.

The normal form drops copyright lines, takes A-Z as a-z, makes every run of other ASCII characters
one space and unifies spellings. Its SHA-256 is joined with the digests of known texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, id_and_text, staged
from .license_texts import DIGESTS, KNOWN

#: Lines that name a holder differ in every copy of a licence.
COPYRIGHT_LINE = r"(^|\n)[ \t\r]*(copyright|\(c\)|©)[^\n]*"
#: Everything in ASCII that is neither a letter nor a digit.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Spelling -> the one that stands for both, applied in this order to words split by one space.
SPELLINGS = [
    ("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"),
    ("https ", "http "), ("copyright owner", "copyright holder"), ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"), ("merchantibility", "merchantability"),
    ("favour", "favor"), ("per cent", "percent"), ("whilst", "while"), ("judgement", "judgment"),
]


def canonical(text: Column) -> Column:
    """The normal form. Empty for null, empty and bare copyright texts."""
    words = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "$1")
    words = F.regexp_replace(words, GAP, " ")
    for spelling, other in SPELLINGS:
        words = F.replace(words, F.lit(spelling), F.lit(other))
    return F.trim(words)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(texts: DataFrame) -> DataFrame:
    """(digest, license_id) of a table (license_id, text); of equal texts the smallest id stays.

    Texts without any word are left out, as they would match every empty text.
    """
    return (
        texts.where(canonical(F.col("text")) != "")
        .groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))
    )


def builtin_texts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def builtin_digests(spark: SparkSession) -> DataFrame:
    """(digest, license_id) of the texts and of the long licences that are held as digests only."""
    held = spark.createDataFrame(DIGESTS, "license_id string, digest string").select("digest", "license_id")
    return known_digests(builtin_texts(spark)).unionByName(held).groupBy("digest").agg(
        F.min("license_id").alias("license_id"))


def scan_licenses(docs: DataFrame, known: DataFrame, lines: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, license_id and notices.

    ``known`` is a table (license_id, text), or one of (digest, license_id) with a row per digest.
    ``license_id`` is the known licence that the whole text is, else null. With ``lines``, each
    line is looked up as a text of its own as well, and ``notices`` holds the distinct licences
    found so, sorted and joined by commas (empty: none). Null and empty texts match nothing.
    Repeated rows give repeated results; rows of one id and one normal form share their notices.
    Very long texts are read whole, and an empty table gives no rows. Only digests are joined. Those of ``known`` are stored first, so Spark knows their size and
    broadcasts them only while it is small.
    """
    table = staged(known if "digest" in known.columns else known_digests(known), "license-digests")
    texts = id_and_text(docs)
    rows = texts.select("doc_id", digest(F.col("text")).alias("digest")).join(table, "digest", "left")
    if lines:
        rows = rows.alias("r").join(
            _notices(texts, table).alias("n"),
            F.expr("r.doc_id <=> n.doc_id AND r.digest = n.whole"), "left",
        ).select("r.*", F.coalesce("n.notices", F.lit("")).alias("notices"))
    return rows.withColumnRenamed("digest", "canonical_sha256")


def _notices(texts: DataFrame, table: DataFrame) -> DataFrame:
    found = (
        texts.select("doc_id", digest(F.col("text")).alias("whole"), F.explode(F.split("text", "\n")).alias("line"))
        .select("doc_id", "whole", digest(F.col("line")).alias("digest"))
        .join(table, "digest")
    )
    return found.groupBy("doc_id", "whole").agg(
        F.array_join(F.sort_array(F.collect_set("license_id")), ",").alias("notices"))


def _in_sql(text: str) -> str:
    """The normal form in DuckDB's words."""
    def quote(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"
    sql = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = f"regexp_replace({sql}, {quote(COPYRIGHT_LINE)}, '\\1', 'g')"
    sql = f"regexp_replace({sql}, {quote(GAP)}, ' ', 'g')"
    for spelling, other in SPELLINGS:
        sql = f"replace({sql}, {quote(spelling)}, {quote(other)})"
    return f"trim({sql})"


def _rows_in_sql() -> str:
    rows = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    return f"(VALUES {rows}) v(license_id, text)"


def _digests_in_sql() -> str:
    return "(VALUES {}) v(license_id, digest)".format(", ".join(f"('{i}', '{d}')" for i, d in DIGESTS))


ORACLE = f"""
WITH known AS (
    SELECT digest, min(license_id) AS license_id FROM (
        SELECT sha256({_in_sql('text')}) AS digest, license_id FROM {_rows_in_sql()} WHERE {_in_sql('text')} <> ''
        UNION ALL SELECT digest, license_id FROM {_digests_in_sql()}
    ) GROUP BY 1
), rows AS (
    SELECT doc_id, text, sha256({_in_sql('text')}) AS digest FROM documents
), lines AS (
    SELECT doc_id, digest, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM rows
), found AS (
    SELECT l.doc_id, l.digest, string_agg(DISTINCT k.license_id, ',' ORDER BY k.license_id) AS notices
    FROM lines l JOIN known k ON sha256({_in_sql('l.line')}) = k.digest GROUP BY 1, 2
)
SELECT r.doc_id, r.digest AS canonical_sha256, k.license_id, coalesce(f.notices, '') AS notices
FROM rows r LEFT JOIN known k ON r.digest = k.digest
LEFT JOIN found f ON r.doc_id IS NOT DISTINCT FROM f.doc_id AND r.digest = f.digest
"""


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return scan_licenses(docs, builtin_digests(spark))

"""Benchmark decontamination by winnowing.

Of every window of 13 words the smallest hash of its 8-word grams is the fingerprint. A window of a
document that equals one of an item has the same fingerprint, so joining fingerprints misses no
shared span of 13 words; hits are extended to all words of their windows and compared in full.
Shorter items are one window each and get fingerprints of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, id_and_text, named, only_keys, slot_filter, staged

#: Words of a window.
WINDOW = 13
#: What lies between two words.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A document is contaminated from this share of hit words on: 1 in so many.
SHARE = 20


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, cut at everything in ASCII but letters and digits."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def _paired(rows: DataFrame, apart: int, fn) -> DataFrame:
    """values[i] becomes fn(values[i], values[i + apart]); the last ``apart`` mean nothing."""
    rest = F.expr(f"slice(values, {apart + 1}, greatest(size(values) - {apart}, 0))")
    return rows.withColumn("values", F.zip_with("values", rest, fn))


def with_fingerprints(rows: DataFrame, length: int) -> DataFrame:
    """``rows`` with ``values``: the fingerprint of each window of ``length`` of its tokens, in order.

    Grams of 8, 4, 2 or 1 words are hashed by doubling, and the minimum over the grams of a window
    is taken by doubling as well, so the work per word doesn't grow with the window. Each step is a
    column of its own, as Spark would compute a nested expression again wherever it stands.
    """
    gram = max(g for g in (8, 4, 2, 1) if g <= length)
    grams = length - gram + 1
    rows = rows.withColumn("values", F.transform("tokens", lambda w: F.xxhash64(w)))
    apart = 1
    while apart < gram:
        rows = _paired(rows, apart, lambda a, b: F.xxhash64(a, b))
        apart *= 2
    span = 1
    while 2 * span <= grams:
        rows = _paired(rows, span, lambda a, b: F.least(a, b))
        span *= 2
    if span < grams:
        rows = _paired(rows, grams - span, lambda a, b: F.least(a, b))
    return rows.withColumn("values", F.expr(f"slice(values, 1, greatest(size(tokens) - {length - 1}, 0))"))


def _prints(rows: DataFrame, keys: list[str], length: int) -> DataFrame:
    """``keys``, at (from 0) and print of each window. Tokens stay behind: a row is a few bytes.

    An inner explode would test the array's size first, below all steps, and so repeat them.
    """
    rows = with_fingerprints(rows, length).select(*keys, F.posexplode_outer("values").alias("at", "print"))
    return rows.where("at IS NOT NULL")


def _window_texts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, length, print and window for each of the ``places`` in ``tokens``."""
    return rows.select(*keys, F.explode(F.transform("places", lambda p: F.struct(
        p.length.alias("length"), p["at"].alias("at"), p["print"].alias("print"),
        F.concat_ws(" ", F.slice("tokens", p["at"] + 1, p.length)).alias("window")))).alias("w")).select(*keys, "w.*")


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, list[int]]:
    """Distinct (length, print, window, item_id) of the items, and the lengths (at most 13 values)."""
    items = benchmark.select(
        named("item_id").cast("string").alias("item_id"), words(named("text")).alias("tokens"),
    ).withColumn("length", F.least(F.size("tokens"), F.lit(WINDOW))).where("length > 0 AND item_id IS NOT NULL")
    items = staged(items, "benchmark-words")
    lengths = sorted(r.length for r in items.select("length").distinct().collect())
    places = _places(items, ["item_id"], lengths, lambda rows, length: rows.where(F.col("length") == length))
    if places is None:
        found = items.selectExpr("length", "0L AS print", "'' AS window", "item_id")
    else:
        found = _window_texts(items.join(places, "item_id"), ["item_id"]).drop("at")
    return staged(found.distinct(), "benchmark-windows"), lengths


def _places(rows: DataFrame, keys: list[str], lengths: list[int], of, keep=lambda prints, length: prints) -> DataFrame | None:
    """``keys`` and the places (at, print, length) of windows, for the rows that are ``of`` a length.

    ``keep`` chooses among their fingerprints.
    """
    found = None
    for length in lengths:
        part = keep(_prints(of(rows, length), keys, length), length).withColumn("length", F.lit(length))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return None
    return found.groupBy(*keys).agg(F.collect_list(F.struct("at", "print", "length")).alias("places"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in any occurrence of an item's window; n_items counts the items with
    such windows, whose ids are hashed as sorted, comma-joined strings. Null and empty texts have no
    words and are clean; items without words or id match nothing; items with the same words count
    each. Repeated rows repeat results. With no items every document is clean.

    Fingerprints of documents are tested against a bit table of fixed size before they are joined, and
    only texts that share some travel. A window that very many documents share is one join key;
    the documents' side of that join holds plain rows, which adaptive execution splits.
    """
    windows, lengths = item_windows(benchmark)
    texts = id_and_text(docs, id_col).select("doc_id", F.xxhash64("text").alias("version"), "text")
    rows = texts.select("doc_id", "version", words(F.col("text")).alias("tokens"))
    sized = rows.select("doc_id", "version", F.size("tokens").cast("long").alias("n_words"))
    places = _places(
        rows, ["doc_id", "version"], lengths, lambda rows, length: rows,
        lambda prints, length: _known(prints, windows.where(F.col("length") == length)))
    if places is None:
        return _judged(sized.selectExpr("*", "0L AS n_hit", "CAST(array() AS ARRAY<STRING>) AS items"))
    places = staged(places.withColumn("row", F.xxhash64("doc_id", "version")), "decontam-places")
    near = slot_filter(texts, F.xxhash64("doc_id", "version"), places, "row").alias("d").join(
        places.alias("p"), F.expr("d.doc_id <=> p.doc_id AND d.version = p.version"),
    ).select("d.doc_id", "d.version", "text", "places").dropDuplicates(["doc_id", "version"])
    near = near.select("doc_id", "version", words(F.col("text")).alias("tokens"), "places")
    hits = _window_texts(near, ["doc_id", "version"]).join(
        windows.select("length", "print", "window", "item_id"), ["print", "length", "window"])
    per_doc = hits.groupBy("doc_id", "version").agg(
        F.collect_set("item_id").alias("items"), F.collect_set(F.struct("at", "length")).alias("spans"))
    covered = F.expr("size(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.length - 1)))))")
    per_doc = per_doc.select("doc_id", "version", "items", covered.cast("long").alias("n_hit"))
    joined = sized.alias("d").join(
        per_doc.alias("h"), F.expr("d.doc_id <=> h.doc_id AND d.version = h.version"), "left")
    return _judged(joined.selectExpr(
        "d.doc_id", "n_words", "coalesce(n_hit, 0L) AS n_hit", "coalesce(items, CAST(array() AS ARRAY<STRING>)) AS items"))


def _known(prints: DataFrame, windows: DataFrame) -> DataFrame:
    """Fingerprints that the items have, too."""
    return only_keys(prints, F.col("print"), windows.select("print").distinct(), "print", "print")


def _judged(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        F.expr(f"n_hit > 0 AND {SHARE} * n_hit >= n_words").alias("contaminated"),
    )


ORACLE = f"""
WITH lowered AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, least(len(w), {WINDOW}) AS n, array_to_string(w[i:i + least(len(w), {WINDOW}) - 1], ' ') AS said
    FROM (SELECT *, unnest(range(1, greatest(len(w) - {WINDOW - 1}, least(len(w), 1)) + 1)) AS i FROM items)
), lengths AS (SELECT DISTINCT n FROM item_windows), doc_windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS said
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM lowered, lengths)
), hits AS (
    SELECT doc_id, n, i, item_id FROM doc_windows JOIN item_windows USING (n, said)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM hits)) GROUP BY 1
), listed AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS items
    FROM hits GROUP BY 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM lowered LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Language identification by interpolated Kneser-Ney models over characters.

One model per language, counted over all labelled documents. Each n-gram has its own count, in sorted
arrays that are broadcast, or in a stored table that is joined where they would be too large. The
language with the lowest cross-entropy per character is chosen, and a document that even its best
model explains far worse than the model's own documents is rejected.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, id_and_text, map_texts, named, numbered, staged, staged_texts

#: Characters of an n-gram, and bits of each: its UTF-16 code, so no two letters share a number, and a
#: letter beyond 16 bits is two characters. 0 is any gap. An n-gram fills a long, sign bit included.
ORDER, BITS = 4, 16
#: n-grams and contexts of all models that are broadcast (16 to 24 bytes each); more are joined.
GATHERED = 4_000_000
#: n-grams a task may hold before it passes counts on, and resolved ones a worker remembers.
HELD = 1 << 18
#: Confidence is the softmax of minus the cross-entropies (bits per character) times this.
SHARPNESS = 8.0
#: A document is rejected beyond twice the 99.9 % quantile of training documents' distances, never
#: below this many standard deviations, and never while its best model does better than half way
#: between the language's documents and chance: what was learnt from looks too good.
LEAST_DISTANCE = 6.0
NO_LANGUAGE = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)


def _characters(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points as UTF-16 codes, 0 for all but letters, and whose they are."""
    letters = np.where(_letters()[points], points, 0).astype(np.int64)
    wide = letters > 0xFFFF
    if not wide.any():
        return letters, owner
    at = np.repeat(np.arange(len(letters)), 1 + wide)
    found = letters[at]
    second = np.diff(at, prepend=-1) == 0
    above = found - 0x10000
    found = np.where(wide[at], np.where(second, 0xDC00 | (above & 0x3FF), 0xD800 | (above >> 10)), found)
    return found, owner[at]


def _last(grams_: np.ndarray, level: int) -> np.ndarray:
    """The last ``level`` characters of n-grams."""
    return grams_ if level == ORDER else grams_ & ((1 << (BITS * level)) - 1)


def _last_in_sql(column: str, level: int) -> str:
    return column if level == ORDER else f"{column} & {(1 << (BITS * level)) - 1}L"


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts in order, and how many each text has: one per letter and gap after one.

    A text starts after a gap; runs of other characters are one gap.
    """
    raw = [t.lower().encode("utf-32-le", "surrogatepass") for t in texts]
    lengths = np.array([len(r) // 4 for r in raw], dtype=np.int64)
    points = np.frombuffer(b"".join(raw), dtype=np.uint32)
    symbols, owner = _characters(points, np.repeat(np.arange(len(texts)), lengths))
    before = np.empty_like(symbols)
    before[:1], before[1:] = 0, symbols[:-1]
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    before[firsts] = 0
    keep = (symbols > 0) | (before > 0)
    symbols, owner = symbols[keep], owner[keep]
    counts = np.bincount(owner, minlength=len(texts))
    found = symbols.copy()
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(counts) - counts, counts)
    for back in range(1, ORDER):
        shifted = np.zeros_like(symbols)
        shifted[back:] = symbols[:-back] if back < len(symbols) else 0
        shifted[place < back] = 0
        found |= shifted << (BITS * back)
    return found, counts


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a language; counted within tasks before the shuffle."""
    rows = docs.select(named(lang_col).cast("string").alias("lang"), named(text_col).cast("string").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                for part in _parts(texts):
                    keys, n = np.unique(grams(part)[0], return_counts=True)
                    if lang in held:
                        keys, place = np.unique(np.concatenate([held[lang][0], keys]), return_inverse=True)
                        n = np.bincount(place, np.concatenate([held[lang][1], n])).astype(np.int64)
                    held[lang] = keys, n
                if sum(len(keys) for keys, _ in held.values()) > HELD:
                    yield from _as_batches(held)
                    held = {}
        yield from _as_batches(held)
        give_back()

    return (
        rows.where("lang IS NOT NULL AND text <> ''").mapInArrow(counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )


def _as_batches(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for lang, (keys, n) in held.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n)], names=["lang", "gram", "n"])


def _parts(texts: list[str], size: int = 250_000) -> Iterator[list[str]]:
    """Runs of texts with about ``size`` characters, to bound what is held at once."""
    part: list[str] = []
    held = 0
    for text in texts:
        part.append(text)
        held += len(text)
        if held >= size:
            yield part
            part, held = [], 0
    if part:
        yield part


class Models:
    """Kneser-Ney models of several languages; ``costs`` are bits for an n-gram's last character.

    ``numbers[lang][level]`` is (n-grams, counts) and ``contexts[lang][level]`` is (contexts, sums,
    kinds) of what follows a context, keys sorted. ``discounts`` is by language and level.
    """

    def __init__(self, languages: list[str], numbers: dict, contexts: dict, discounts: dict, symbols: int) -> None:
        self.languages, self.symbols = languages, max(2, symbols)
        self._numbers, self._contexts, self._discounts = numbers, contexts, discounts
        self._seen, self._costs = np.empty(0, np.int64), np.empty((0, len(languages)))

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_seen": self._seen[:0], "_costs": self._costs[:0]}

    def costs(self, keys: np.ndarray) -> np.ndarray:
        """A row per n-gram (sorted, distinct), a column per language."""
        at = np.searchsorted(self._seen, keys)
        at[at == len(self._seen)] = 0
        new = keys[self._seen[at] != keys] if len(self._seen) else keys
        if len(new):
            if len(self._seen) + len(new) > HELD:
                self._seen, self._costs, new = self._seen[:0], self._costs[:0], keys
            fresh = np.stack([self._bits(lang, new) for lang in self.languages], axis=1)
            seen = np.concatenate([self._seen, new])
            order = np.argsort(seen, kind="stable")
            self._seen, self._costs = seen[order], np.concatenate([self._costs, fresh])[order]
            at = np.searchsorted(self._seen, keys)
        return self._costs[at]

    def _bits(self, lang: str, keys: np.ndarray) -> np.ndarray:
        chance = np.full(len(keys), 1 / self.symbols)
        for level in range(1, ORDER + 1):
            gram = _last(keys, level)
            count, = _look_up(self._numbers[lang][level], gram)
            total, kinds = _look_up(self._contexts[lang][level], _last(gram >> BITS, level - 1))
            discount = self._discounts[lang][level]
            known = total > 0
            total = np.where(known, total, 1)
            mixed = np.maximum(count - discount, 0) / total + discount * kinds / total * chance
            chance = np.where(known, mixed, chance)
        return -np.log2(np.maximum(chance, 1e-12))


def _look_up(table: tuple[np.ndarray, ...], keys: np.ndarray) -> list[np.ndarray]:
    held, *values = table
    if not len(held):
        return [np.zeros(len(keys)) for _ in values]
    at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
    return [np.where(held[at] == keys, v[at], 0.0) for v in values]


class Tables:
    """The models as stored tables: numbers (lang, level, g, n) and contexts (lang, level, g, n, kinds).

    Levels below the highest count in how many ways an n-gram continues longer ones. The driver
    holds a discount per language and level, the number of symbols and the sizes of the tables.
    """

    def __init__(self, counts: DataFrame) -> None:
        level = {ORDER: counts.select("lang", F.col("gram").alias("g"), "n")}
        for n in range(ORDER - 1, 0, -1):
            level[n] = level[n + 1].groupBy("lang", F.expr(_last_in_sql("g", n)).alias("g")).agg(
                F.count("*").alias("n"))
        self.numbers = staged(
            _union([level[n].select("lang", F.lit(n).alias("level"), "g", "n") for n in level]), "char-grams")
        self.contexts = staged(
            self.numbers.groupBy("lang", "level", F.expr(f"shiftrightunsigned(g, {BITS})").alias("g")).agg(
                F.sum("n").alias("n"), F.count("*").alias("kinds")), "char-contexts")
        rare = self.numbers.groupBy("lang", "level").agg(
            F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"),
            F.count("*").alias("kinds")).collect()
        self.languages = sorted({r.lang for r in rare})
        self.discounts: dict = {lang: {} for lang in self.languages}
        for r in rare:
            self.discounts[r.lang][r.level] = r.once / (r.once + 2 * r.twice) if r.once and r.twice else 0.5
        self.symbols = max(2, max([r.kinds for r in rare if r.level == 1], default=2))
        self.size = sum(r.kinds for r in rare) + self.contexts.count()


def fit(counts: DataFrame) -> Models:
    """Models from (lang, gram, n), gathered in the driver."""
    return gathered(Tables(counts))


def gathered(tables: Tables) -> Models:
    """The models as arrays, one entry per n-gram and context."""
    return Models(
        tables.languages, _arrays(tables.languages, tables.numbers.toPandas(), ["n"]),
        _arrays(tables.languages, tables.contexts.toPandas(), ["n", "kinds"]), tables.discounts, tables.symbols)


def _arrays(languages: list[str], frame, values: list[str]) -> dict:
    tables: dict = {lang: {} for lang in languages}
    for (lang, level), part in frame.sort_values("g").groupby(["lang", "level"]):
        tables[lang][level] = (part["g"].to_numpy(np.int64), *(part[v].to_numpy(np.float64) for v in values))
    return tables


def _union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def score(docs: DataFrame, models: Models) -> DataFrame:
    """(doc_id, lang_pred, score, bits, spread, n): bits per character of the best language.

    Ties go to the language that comes first. Texts without a letter have ``und`` and score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def best(texts: list[str]) -> list[list]:
        models_ = shared.value  # kept by the worker while it gets tasks with this broadcast, and no longer
        columns: list[list] = [[], [], [], [], []]
        for part in _parts(texts):
            for column, values in zip(columns, _best(models_, part), strict=True):
                column += values
        return columns

    return map_texts(id_and_text(docs), "lang_pred string, score double, bits double, spread double, n long", best)


def score_joined(docs: DataFrame, tables: Tables) -> DataFrame:
    """What ``score`` gives, by joins: no task and no driver holds a model.

    Documents become their n-grams with counts. The distinct ones get a cost per language from
    the tables, which is joined back and summed by row.
    """
    rows = numbered(id_and_text(docs))
    said = staged_texts(rows.select(F.col("row").alias("doc_id"), "text").mapInArrow(_said, "row long, gram long, n long"),
                  "said-grams")
    costs = staged(_joined_costs(said.select("gram").distinct(), tables), "gram-costs")
    at = range(len(tables.languages))
    sums = said.join(costs, "gram").groupBy("row").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col("costs")[i]).alias(f"s{i}") for i in at),
        *(F.sum(F.col("n") * F.col("costs")[i] * F.col("costs")[i]).alias(f"q{i}") for i in at))
    means = sums.select("row", "n", F.array(*(F.col(f"s{i}") / F.col("n") for i in at)).alias("means"),
                        F.array(*(F.col(f"q{i}") / F.col("n") for i in at)).alias("squares"))
    means = means.withColumn("bits", F.array_min("means")).withColumn("pick", F.expr("CAST(array_position(means, bits) AS INT)"))
    found = means.select(
        "row", F.element_at(F.array(*map(F.lit, tables.languages)), F.col("pick")).alias("lang_pred"),
        F.expr(f"1 / aggregate(means, 0D, (a, m) -> a + exp((bits - m) * {SHARPNESS}D))").alias("score"), "bits",
        F.greatest(F.element_at("squares", F.col("pick")) - F.col("bits") * F.col("bits"), F.lit(0.0)).alias("spread"), "n")
    return rows.select("row", "doc_id").join(found, "row", "left").select(
        "doc_id", F.coalesce("lang_pred", F.lit(NO_LANGUAGE)).alias("lang_pred"), F.coalesce("score", F.lit(0.0)).alias("score"),
        "bits", "spread", F.coalesce("n", F.lit(0)).alias("n"))


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each document and their counts."""
    for batch in batches:
        for row, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            keys, n = np.unique(grams([text])[0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), row, np.int64)), pa.array(keys), pa.array(n)], names=["row", "gram", "n"])


def _joined_costs(wanted: DataFrame, tables: Tables) -> DataFrame:
    """(gram, costs) with the bits of each language, in the order of ``tables.languages``."""
    each = wanted.withColumn("lang", F.explode(F.array(*map(F.lit, tables.languages)))).withColumn(
        "chance", F.lit(1 / tables.symbols))
    for level in range(1, ORDER + 1):
        numbers = tables.numbers.where(F.col("level") == level).select("lang", "g", F.col("n").alias("seen"))
        contexts = tables.contexts.where(F.col("level") == level).select(
            F.col("lang").alias("of"), F.col("g").alias("context"), F.col("n").alias("total"), "kinds")
        discount = F.create_map(*(F.lit(v) for lang in tables.languages for v in (lang, float(tables.discounts[lang][level]))))
        each = (
            each.withColumn("g", F.expr(_last_in_sql("gram", level))).join(numbers, ["lang", "g"], "left")
            .join(contexts, F.expr(f"lang = of AND shiftrightunsigned(g, {BITS}) = context"), "left")
            .withColumn("d", discount[F.col("lang")])
            .selectExpr("gram", "lang", "CASE WHEN total > 0 THEN greatest(coalesce(seen, 0) - d, 0) / total"
                        " + d * kinds / total * chance ELSE chance END AS chance")
        )
    bits = F.struct("lang", F.expr("-log2(greatest(chance, 1e-12D))").alias("bits"))
    return each.groupBy("gram").agg(F.sort_array(F.collect_list(bits)).bits.alias("costs"))


def _best(models: Models, texts: list[str]) -> list[list]:
    found, counts = grams(texts)
    if not models.languages or not len(found):
        n = len(texts)
        return [[NO_LANGUAGE] * n, [0.0] * n, [None] * n, [None] * n, [0] * n]
    keys, place = np.unique(found, return_inverse=True)
    costs = models.costs(keys)[place]
    some = np.flatnonzero(counts)
    starts = (np.cumsum(counts) - counts)[some]
    n = counts[some]
    mean = np.add.reduceat(costs, starts) / n[:, None]
    pick = mean.argmin(axis=1)
    rows = np.arange(len(some))
    low = mean[rows, pick]
    spread = np.add.reduceat((costs[np.arange(len(place)), np.repeat(pick, n)] - np.repeat(low, n)) ** 2, starts) / n
    sure = 1 / np.exp((low[:, None] - mean) * SHARPNESS).sum(axis=1)
    out = [[NO_LANGUAGE] * len(texts), [0.0] * len(texts), [None] * len(texts), [None] * len(texts), [0] * len(texts)]
    for at, lang, *numbers in zip(some.tolist(), pick.tolist(), sure.tolist(), low.tolist(), spread.tolist(), n.tolist(), strict=True):
        out[0][at] = models.languages[lang]
        for column, value in zip(out[1:], numbers, strict=True):
            column[at] = value
    return out


def _distance(mean: Column, between: Column, within: Column) -> Column:
    """How many standard deviations a document lies above its language's documents."""
    return (F.col("bits") - mean) / F.sqrt(between + within / F.col("n") + F.lit(1e-6))


def identify(docs: DataFrame, training: Column, id_col: str = "doc_id", broadcast_limit: int = GATHERED) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, rejected.

    Learns from the rows where ``training`` holds and ``lang`` is not null; lang, source and doc_id
    are no part of a prediction. ``rejected`` holds for texts without a letter (``und``, score 0)
    and for texts whose best model explains them far worse than training documents. Null and empty
    texts are ``und``; so is everything if nothing can be learnt, and an empty table gives no rows.
    Repeated rows repeat results; ties go to the language that comes first. Very long texts are
    counted whole. Models of up to ``broadcast_limit`` n-grams and contexts are broadcast, larger
    ones joined; that is a matter of speed and changes no result but the last digits of a score.
    """
    training = F.coalesce(training, F.lit(False)) & named("lang").isNotNull()
    learnt = docs.where(training)
    tables = Tables(staged_texts(count_grams(learnt), "char-counts"))
    rows = docs.select(named("text").alias("text"), F.struct(named(id_col).alias("id"), training.alias("trained")).alias("doc_id"))
    found = score(rows, gathered(tables)) if tables.size <= broadcast_limit else score_joined(rows, tables)
    scored = staged_texts(found, "language-scores").selectExpr(
        "doc_id.id AS doc_id", "doc_id.trained", "lang_pred", "score", "bits", "spread", "n")
    usual = scored.where("trained AND n > 0").groupBy("lang_pred").agg(
        F.avg("bits").alias("mean"), F.coalesce(F.variance("bits"), F.lit(0.0)).alias("between"), F.avg("spread").alias("within"))
    usual = staged(usual, "language-usual")  # a row per language
    far = scored.where("n > 0").join(usual, "lang_pred", "left").withColumn(
        "distance", _distance(F.col("mean"), F.col("between"), F.col("within")))
    limit = far.where("trained").groupBy("lang_pred").agg(
        F.greatest(F.lit(LEAST_DISTANCE), 2 * F.percentile_approx("distance", 0.999, 10_000)).alias("limit"))
    judged = scored.join(usual, "lang_pred", "left").join(staged(limit, "language-limits"), "lang_pred", "left")
    return judged.select(
        "doc_id", "lang_pred", "score",
        F.expr("n = 0").alias("blank"),
        F.coalesce((_distance(F.col("mean"), F.col("between"), F.col("within")) > F.col("limit"))
                   & (F.col("bits") > (F.col("mean") + math.log2(tables.symbols)) / 2), F.lit(False)).alias("far"),
    ).selectExpr("doc_id", "lang_pred", "score", "blank OR lang_pred = 'und' OR far AS rejected")


def held_out() -> Column:
    """Documents that are never learnt from."""
    return F.coalesce(F.crc32(named("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = identify(docs, ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")

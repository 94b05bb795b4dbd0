"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled ones train linear classifiers in numpy. The risk of the
unlabelled is corrected by the share of toxic ones among them, and kept from going below zero.
Features are counted in all documents, and all of them train as unlabelled ones: dealt to blocks of
like size, each of which fits classifiers in a task of its own, whose weights are averaged.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_ids, id_and_text, map_texts, named, only_keys, slices, slot_filter, staged, staged_texts

#: Labelled documents used at most: toxic ones to fit with, and any to calibrate with. Those whose
#: hashed id is smallest are taken, ties by id. Unlabelled ones have no bound.
POSITIVE, CALIBRATION = 2_000, 4_000
#: Unlabelled documents of a block, about; a task of its own fits it.
BLOCK = 20_000
#: Features a task gathers before it counts them.
GATHERED = 1 << 20
#: Classifiers. Each leaves out its share of the sample and is calibrated on that.
MEMBERS = 3
#: Features a classifier may use, and documents with one at least.
FEATURES, LEAST_DOCS = 4_096, 3
#: Evidence for a feature: log of how much likelier its number of toxic documents is under their own
#: rate than under that of unlabelled ones. Among a million rare features some reach ln(10 ** 6) by chance.
LEAST_EVIDENCE = 12.0
STEPS, BATCH, RATE, DECAY = 400, 256, 0.05, 1e-4
#: Score from which a document is predicted to be toxic.
TOXIC = 0.7
_WORDS = re.compile(r"[^\W\d_]+").findall


#: Checksums of the marks before whole words and before beginnings, which those of the letters go on from.
_WHOLE, _BEGIN = zlib.crc32(b"="), zlib.crc32(b"^")


def word_features(word: str) -> list[int]:
    """Hashes of a word, its beginnings of 3 to 6 letters and its runs of 5."""
    if word.isascii():  # a letter is a byte, so pieces can be cut from the bytes of the word
        letters = word.encode()
        starts, runs = _pieces(letters)
    else:
        letters = word.encode("utf-8", "surrogatepass")
        starts, runs = ([p.encode("utf-8", "surrogatepass") for p in pieces] for pieces in _pieces(word))
    found = [zlib.crc32(p, _BEGIN) for p in starts]
    found.append(zlib.crc32(letters, _WHOLE))
    found.extend(map(zlib.crc32, runs))
    return found


def _pieces(word: str | bytes) -> tuple[list, list]:
    size = len(word)
    return [word[:n] for n in range(3, min(size, 6) + 1)], [word[i:i + 5] for i in range(size - 4)]


def words(text: str) -> set[str]:
    return set(_WORDS(text.lower()))


class _Memo(dict):
    def __init__(self, fn) -> None:
        super().__init__()
        self._fn = fn

    def __missing__(self, word: str):
        if len(self) > 1 << 18:
            self.clear()
        self[word] = value = self._fn(word)
        return value


class Features:
    """The features of texts, each once. Words are remembered, as most come again."""

    def __init__(self) -> None:
        self._of_word = _Memo(lambda w: array("I", word_features(w)).tobytes())

    def of(self, text: str) -> np.ndarray:
        found = np.frombuffer(b"".join(map(self._of_word.__getitem__, words(text))), np.uint32)
        found = np.sort(found)
        return found[np.append(True, found[1:] != found[:-1])] if len(found) else found


class Chosen:
    """Places in the sorted list ``chosen`` of those features that a text has."""

    def __init__(self, chosen: tuple[int, ...]) -> None:
        place = {key: i for i, key in enumerate(chosen)}
        self._of_word = _Memo(lambda w: tuple(place[k] for k in word_features(w) if k in place))

    def of(self, text: str) -> list[int]:
        return sorted(set(chain.from_iterable(map(self._of_word.__getitem__, words(text)))))


@lru_cache(maxsize=2)
def _chosen(chosen: tuple[int, ...]) -> Chosen:
    return Chosen(chosen)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    features, found, size = Features(), [], 0

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["feature", "n"])

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            found.append(features.of(text))
            size += len(found[-1])
            if size > GATHERED:
                yield counted()
                found, size = [], 0
    if found:
        yield counted()


def document_frequencies(texts: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """(feature, n): the rows of ``texts`` with a feature, of all rows; counted in each task first.

    With ``among`` only its features are asked for, and most others are left out before the shuffle.
    """
    counted = texts.select("text").mapInArrow(_count, "feature long, n long")
    if among is not None:
        hashed = F.xxhash64("feature")
        counted = slot_filter(counted, hashed, among.select(hashed.alias("hash")), "hash")
    return counted.groupBy("feature").agg(F.sum("n").alias("n"))


def choose_features(toxic: DataFrame, every: DataFrame, n_toxic: int, n_every: int) -> tuple[int, ...]:
    """The features more frequent in toxic documents than in all, by evidence; at most FEATURES, sorted.

    Both tables are (feature, n). Ties go to the smaller feature.
    """
    pairs = toxic.where(F.col("n") >= LEAST_DOCS).join(every.select("feature", F.col("n").alias("m")), "feature", "left")
    usual = F.lit(float(n_toxic)) * (F.coalesce("m", F.lit(0)) + 1) / F.lit(n_every + 1.0)
    evidence = F.when(F.col("n") > usual, F.col("n") * F.log(F.col("n") / usual) - (F.col("n") - usual))
    best = pairs.withColumn("evidence", evidence).where(F.col("evidence") >= LEAST_EVIDENCE)
    return tuple(sorted(r.feature for r in best.orderBy(F.desc("evidence"), "feature").limit(FEATURES).collect()))


class Rows:
    """Sparse rows of ones: the numbers of their features, one after another."""

    def __init__(self, rows: list) -> None:
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.places = np.concatenate([np.asarray(r, np.int64) for r in rows] or [np.empty(0, np.int64)])

    def __len__(self) -> int:
        return len(self.lengths)

    def take(self, which: np.ndarray) -> Rows:
        some = Rows([])
        some.lengths = self.lengths[which]
        some.starts = np.cumsum(some.lengths) - some.lengths
        some.places = self.places[np.repeat(self.starts[which] - some.starts, some.lengths) + np.arange(some.lengths.sum())]
        return some

    def outputs(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return bias + np.bincount(np.repeat(np.arange(len(self)), self.lengths), weights[self.places], len(self))

    def gradient(self, g: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.places, np.repeat(g, self.lengths), size)


def risk(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[float, float]:
    """The risks of toxic documents and of the others, from outputs for toxic and for unlabelled ones.

    The logistic loss; the second is that of the unlabelled without the share of toxic ones in it.
    """
    return (prior * float(np.logaddexp(0, -f_p).mean()),
            float(np.logaddexp(0, f_u).mean()) - prior * float(np.logaddexp(0, f_p).mean()))


def risk_slopes(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives by the outputs of what is to fall: the sum of both risks, or, where the second
    is below zero, its negative."""
    sig_p, sig_u = (1 / (1 + np.exp(-np.clip(f, -50, 50))) for f in (f_p, f_u))
    if risk(f_p, f_u, prior)[1] >= 0:
        return -prior * np.ones(len(f_p)) / len(f_p), sig_u / len(f_u)
    return prior * sig_p / len(f_p), -sig_u / len(f_u)


def fit_nnpu(toxic: Rows, other: Rows, counts: np.ndarray, prior: float, size: int, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with the logistic loss, by Adam.

    ``counts`` says how many documents each row of ``other`` stands for.
    """
    rng = np.random.default_rng(seed)
    upto = np.cumsum(counts)
    weights = np.zeros(size + 1)  # the bias is last
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        some = toxic.take(rng.integers(0, len(toxic), BATCH))
        drawn = np.searchsorted(upto, rng.random(2 * BATCH) * upto[-1], side="right")
        more = other.take(np.minimum(drawn, len(other) - 1))
        f_p, f_u = some.outputs(weights, weights[-1]), more.outputs(weights, weights[-1])
        g_p, g_u = risk_slopes(f_p, f_u, prior)
        grad = np.append(some.gradient(g_p, size) + more.gradient(g_u, size), g_p.sum() + g_u.sum())
        grad[:-1] += DECAY * weights[:-1]
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad ** 2
        weights -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def calibrate(outputs: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make the sigmoid of an output a probability, by Newton's method."""
    a, c = 1.0, 0.0
    target = np.where(toxic > 0, (toxic.sum() + 1) / (toxic.sum() + 2), 1 / ((toxic <= 0).sum() + 2))
    x = np.stack([outputs, np.ones(len(outputs))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * outputs + c, -50, 50)))
        grad = x.T @ (p - target) + 1e-3 * np.array([a - 1, c])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        a, c = np.array([a, c]) - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return float(max(a, 0.0)), float(c)


def steps(outputs: np.ndarray, toxic: np.ndarray) -> tuple[list[float], list[float]]:
    """Isotonic regression: outputs and the shares of toxic ones near them, both rising.

    Neighbouring outputs are pooled while their shares fall; a small constant keeps shares off 0 and 1.
    """
    blocks: list[list[float]] = []
    for at in np.argsort(outputs, kind="stable"):
        blocks.append([float(toxic[at] > 0), 1.0, float(outputs[at])])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last, strict=True)]
    shares = np.maximum.accumulate([(y + 0.1) / (n + 0.2) for y, n, _ in blocks])
    return [x / n for _, n, x in blocks], shares.tolist()


def _one_each(rows: DataFrame) -> DataFrame:
    """One row of each id, the one with the smallest text; rows without an id are documents of their own.

    Only rows whose id comes more than once are shuffled.
    """
    many = staged(rows.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(
        "doc_id", F.xxhash64("doc_id").alias("hash")), "toxic-repeated")
    if many.isEmpty():
        return rows
    again = slot_filter(rows, F.xxhash64("doc_id"), many, "hash").groupBy("doc_id").agg(F.min("text").alias("text"))
    return drop_ids(rows, many.select("doc_id")).unionByName(again.join(many, "doc_id", "left_semi").select("doc_id", "text"))


def _fold(doc_id: Column, text: Column | None = None) -> Column:
    key = F.xxhash64(F.lit("fold"), doc_id)
    if text is not None:
        key = F.when(doc_id.isNull(), F.xxhash64(text)).otherwise(key)
    return F.pmod(key, F.lit(MEMBERS))


def _block_weights(unlabelled: DataFrame, toxic: list[list[list[int]]], prior: float, size: int) -> DataFrame:
    """(member, place, weight) from (fold, places, n); each member leaves out its fold.

    Documents with the same features are one row, dealt to as many blocks as it stands for, so each block
    is a fair sample of all, however often a document was copied.
    """
    blocks = max(1, -(-(unlabelled.agg(F.sum("n")).first()[0] or 0) // BLOCK))
    spread = F.least(F.col("n"), F.lit(blocks))
    dealt = unlabelled.select(
        "fold", "places", (F.col("n") / spread).alias("n"),
        F.explode(F.sequence(F.lit(0).cast("long"), spread - 1)).alias("i"))
    dealt = dealt.select(
        "places", "n", F.pmod(F.xxhash64("places", "fold") + F.col("i"), F.lit(blocks)).alias("block"),
        F.explode(F.array(*[F.when(F.col("fold") != m, F.lit(m)) for m in range(MEMBERS)])).alias("member"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        member, block = int(rows["member"].iloc[0]), int(rows["block"].iloc[0])
        order = sorted(range(len(rows)), key=lambda i: rows["places"].iloc[i].tolist())
        other, counts = Rows([rows["places"].iloc[i] for i in order]), rows["n"].to_numpy()[order]
        weights, bias = fit_nnpu(Rows(toxic[member]), other, counts, prior, size, MEMBERS * block + member)
        return pd.DataFrame({"member": member, "total": counts.sum(), "weights": [np.append(weights, bias)]})

    members = [m for m in range(MEMBERS) if toxic[m]]
    fitted = dealt.where(F.col("member").isin(members)).groupBy("member", "block").applyInPandas(
        fit, "member int, total double, weights array<double>")
    each = fitted.select("member", "total", F.posexplode("weights").alias("place", "weight"))
    return each.groupBy("member", "place").agg(
        F.round(F.sum(F.col("weight") * F.col("total")) / F.sum("total"), 9).alias("weight"))


def learn(docs: DataFrame, labels: DataFrame, training: Column) -> list[str]:
    """Models as JSON, from the labels (doc_id, toxic) of those documents for which ``training`` holds.

    Rows that share an id are one document, with the smallest of their texts; rows without an id
    are documents without a label. Repeated labels of a document count as the largest, null ones not
    at all. The share of toxic documents among labelled ones is taken for that among all; where it
    is far from it, scores are off. Empty texts have no features. Without a toxic example, or without documents, there
    are no models. A very long text is one document like others.
    """
    rows = _one_each(id_and_text(docs).where(training))
    hashed = F.xxhash64(F.col("doc_id").cast("string"))
    marks = labels.select(named("doc_id").alias("doc_id"), named("toxic").cast("int").alias("toxic")).where(
        "toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = id_and_text(docs).where(training).select("doc_id").distinct()
    labelled = staged(ids.join(marks, "doc_id").select("doc_id", hashed.alias("hash"), "toxic"), "toxic-labels")
    share = labelled.agg(F.avg("toxic"), F.sum("toxic")).first()
    if not share[0]:
        return []
    prior, positive = float(share[0]), labelled.where("toxic = 1")
    confirmed = only_keys(rows, hashed, positive, "doc_id", "hash")
    frequent = staged_texts(document_frequencies(confirmed).where(F.col("n") >= LEAST_DOCS), "toxic-counts")
    every = staged_texts(document_frequencies(rows, frequent), "toxic-all-counts")
    chosen = choose_features(frequent, every, share[1], rows.count())

    def places(texts: list[str]) -> list[list]:
        finder = _chosen(chosen)
        return [[finder.of(t) for t in texts]]

    unlabelled = map_texts(
        rows.select(_fold(F.col("doc_id"), F.col("text")).alias("doc_id"), "text"), "places array<int>", places)
    unlabelled = staged_texts(
        unlabelled.groupBy(F.col("doc_id").alias("fold"), "places").agg(F.count("*").alias("n")), "toxic-unlabelled")
    # The sample: at most POSITIVE + CALIBRATION documents, of which only features reach the driver.
    picks = staged(
        _smallest(positive, POSITIVE).withColumn("fits", F.lit(True))
        .unionByName(_smallest(labelled, CALIBRATION).withColumn("fits", F.lit(False))), "toxic-sample")
    texts = rows.join(F.broadcast(picks.select("doc_id").distinct()), "doc_id")
    sample = map_texts(texts, "places array<int>", places).join(picks, "doc_id").withColumn("fold", _fold(F.col("doc_id")))
    sample = sorted(sample.collect(), key=lambda r: (r.hash, r.doc_id))
    toxic = [[r.places for r in sample if r.fits and r.fold != m] for m in range(MEMBERS)]
    weights: dict[int, np.ndarray] = {}
    for r in _block_weights(unlabelled, toxic, prior, len(chosen)).collect():
        weights.setdefault(r.member, np.zeros(len(chosen) + 1))[r.place] = r.weight
    return [_model(chosen, weights[m], [r for r in sample if not r.fits and r.fold == m], prior) for m in sorted(weights)]


def _model(chosen: tuple[int, ...], weights: np.ndarray, rest: list, prior: float) -> str:
    """A member's model, calibrated on the labelled documents it was not fitted on."""
    bias, weights = float(weights[-1]), weights[:-1]
    a, c, at, share = 1.0, 0.0, [0.0], [prior]
    if rest:
        marks = np.array([r.toxic for r in rest])
        outputs = Rows([r.places for r in rest]).outputs(weights, bias)
        a, c = calibrate(outputs, marks)
        at, share = steps(a * outputs + c, marks)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return json.dumps([[chosen[i] for i in used], (a * weights[used]).tolist(), a * bias + c, at, share])


def _smallest(ids: DataFrame, most: int) -> DataFrame:
    return ids.orderBy("hash", "doc_id").limit(most)


class Scorer:
    def __init__(self, models: tuple[str, ...]) -> None:
        parsed = [json.loads(m) for m in models]
        self.bias = np.array([m[2] for m in parsed])
        self._steps = [(np.array(m[3]), np.array(m[4])) for m in parsed]
        known = tuple(sorted(set(chain.from_iterable(m[0] for m in parsed))))
        place = {key: i for i, key in enumerate(known)}
        self._chosen = Chosen(known)
        self._weights = np.zeros((len(parsed), len(known)))
        for m, (keys, weights, *_) in enumerate(parsed):
            self._weights[m, [place[k] for k in keys]] = weights

    def scores(self, texts: list[str]) -> np.ndarray:
        """Medians of the classifiers' probabilities; each known feature of a text counts once.

        A probability is the share of toxic documents with such an output, and to a small part its
        sigmoid, which orders what has one share.
        """
        rows = Rows([self._chosen.of(t) for t in texts])
        outputs = np.array([rows.outputs(w, b) for w, b in zip(self._weights, self.bias, strict=True)])
        shares = [np.interp(o, at, share) for o, (at, share) in zip(outputs, self._steps, strict=True)]
        return 0.98 * np.median(shares, axis=0) + 0.02 * (1 / (1 + np.exp(-np.clip(outputs, -50, 50)))).mean(axis=0)


@lru_cache(maxsize=2)
def _scorer(models: tuple[str, ...]) -> Scorer:
    return Scorer(models)


def score_toxicity(docs: DataFrame, models: list[str]) -> DataFrame:
    """One row per row of ``docs``: doc_id, score (0 to 1), predicted (1 from TOXIC on).

    Only texts are inputs. Null and empty texts get the score of a text without any feature. With
    no models (no toxic example was known) every score is 0. Repeated rows repeat results. A model
    is FEATURES weights at most, and goes to the workers with the function.
    """
    known = tuple(models)

    def scored(texts: list[str]) -> list[list]:
        scores = _scorer(known).scores(texts).tolist() if known else [0.0] * len(texts)
        return [scores, [int(s >= TOXIC) for s in scores]]

    return map_texts(id_and_text(docs), "score double, predicted int", scored)


def held_out() -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(named("doc_id").cast("string")) % 3 == 1, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    found = score_toxicity(docs, learn(docs, labels, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted")

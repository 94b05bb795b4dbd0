"""Near duplicates by an LSH forest over MinHash signatures, confirmed on full shingle sets.

Equal sets are one class. Each tree sorts the classes by an order of its own over the signature;
those with the same first DEPTH values are a region. In small regions all pairs are candidates. In
crowded ones the order is followed deeper: a class is paired with those that share the longest
prefix. What that may leave open in a crowded region is settled by prefix filtering, which is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCHES, id_and_text, settings, slices, slot_filter, staged
from .components import components

#: Words of a shingle; sets are linked from this similarity on, in percent.
WORDS, PERCENT = 4, 80
#: Trees, and values that the members of a region share. A pair of 0.8 misses all trees with
#: probability (1 - 0.8 ** DEPTH) ** TREES = 5e-8. The signature has TREES * DEPTH values.
TREES, DEPTH = 32, 4
#: Members of a region whose pairs are all candidates, and of neighbours looked at in larger ones.
SMALL, NEAREST = 16, 8
#: Pairs that agree in fewer values than this are no candidates: 0.8 does so with 1e-8.
LEAST_AGREEING = 76
_VALUES = TREES * DEPTH
_MIX = np.random.default_rng(20).integers(1, 1 << 63, _VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 16:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles; one of all words if there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(n, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ values[i:len(values) - size + 1 + i]) * _STEP
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """Smallest value under each of the hash functions."""
    low = np.full(_VALUES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(found), 2048):
        part = (found[at:at + 2048, None] * _MIX) >> np.uint64(32)
        np.minimum(low, part.min(axis=0), out=low)
    return low.astype(np.uint32)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        sizes, keys, signs = [], [], []
        for text in batch["text"].to_pylist():
            found = shingles(text)
            sizes.append(len(found))
            keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest())
            signs.append(signature(found).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys), pa.array(signs, pa.binary())],
            names=["doc_id", "n", "key", "sign"])


def _values(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, _VALUES)


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and tree: the region it is in."""
    for batch in batches:
        values = _values(batch["sign"]).reshape(-1, TREES, DEPTH).astype(np.uint64)
        region = np.broadcast_to(np.arange(1, TREES + 1, dtype=np.uint64), values.shape[:2]).copy()
        for i in range(DEPTH):
            region = (region ^ values[:, :, i]) * _STEP
            region ^= region >> np.uint64(31)
        count = batch.num_rows
        at = np.repeat(np.arange(count), TREES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(region.astype(np.int64).ravel()), pa.array(np.tile(np.arange(TREES, dtype=np.int32), count)),
             batch["node"].take(pa.array(at)), batch["n"].take(pa.array(at))],
            names=["region", "tree", "node", "n"])


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The signature from below the region on, in the tree's order, and a byte of every value."""
    for batch in batches:
        values = _values(batch["sign"])
        turned = (np.arange(DEPTH, 4 * DEPTH)[None, :] + DEPTH * batch["tree"].to_numpy()[:, None]) % _VALUES
        order = np.take_along_axis(values, turned, axis=1).astype(">u4")
        yield pa.RecordBatch.from_arrays(
            [batch["region"], batch["node"], batch["n"], pa.array([o.tobytes() for o in order], pa.binary()),
             pa.array([v.tobytes() for v in values.astype(np.uint8)], pa.binary())],
            names=["region", "node", "n", "deep", "bytes"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The most similar of the next few classes in a tree's order, for each class of a region."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        held = batch.slice(max(0, batch.num_rows - NEAREST))
        region, node, n = (batch[c].to_numpy() for c in ("region", "node", "n"))
        marks = np.frombuffer(b"".join(batch["bytes"].to_pylist()), np.uint8).reshape(-1, _VALUES)
        best, other = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        for step in range(1, min(NEAREST, len(node) - 1) + 1):
            same = (region[:-step] == region[step:]) & (node[:-step] != node[step:])
            same &= 100 * np.minimum(n[:-step], n[step:]) >= PERCENT * np.maximum(n[:-step], n[step:])
            agreeing = np.where(same, (marks[:-step] == marks[step:]).sum(axis=1), 0)
            better = agreeing > best[:-step]
            best[:-step][better] = agreeing[better]
            other[:-step][better] = node[step:][better]
        keep = best >= LEAST_AGREEING
        a, b = np.minimum(node[keep], other[keep]), np.maximum(node[keep], other[keep])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def _all_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within small regions whose sizes allow the similarity."""
    for batch in batches:
        out_a, out_b = [], []
        for members in batch["members"].to_pylist():
            members.sort(key=lambda m: (m["n"], m["node"]))
            for i, x in enumerate(members):
                for y in members[i + 1:]:
                    if 100 * x["n"] < PERCENT * y["n"]:
                        break
                    if x["node"] != y["node"]:
                        out_a.append(min(x["node"], y["node"]))
                        out_b.append(max(x["node"], y["node"]))
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = (_values(batch["sign_a"]) == _values(batch["sign_b"])).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(same)], names=["a", "b", "agreeing"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    recent = lru_cache(maxsize=16)(shingles)  # of this task only
    for batch in slices(batches, 16):
        keep = []
        for left, right in zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist(), strict=True):
            x, y = recent(left), recent(right)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, text in zip(batch["node"].to_pylist(), batch["text"].to_pylist(), strict=True):
            found = shingles(text).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found), pa.array(np.full(len(found), node)), pa.array(np.full(len(found), len(found)))],
                names=["token", "node", "n"])


def _with_texts(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text) of ``nodes``; only texts that pass the slot filter are shuffled."""
    return slot_filter(texts, F.xxhash64("node"), nodes.select(F.xxhash64("node").alias("h")), "h").join(nodes, "node")


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) that are linked."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    near = staged(_with_texts(ends, texts), "near-texts")
    both = pairs.join(near.selectExpr("node AS a", "text AS text_a"), "a").join(
        near.selectExpr("node AS b", "text AS text_b"), "b")
    return both.mapInArrow(_confirmed, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Documents are linked if their sets of 4-word shingles are similar from 0.8 on; component_id is
    the smallest id that links reach, kept holds for it. Null and empty texts and texts without
    words have no shingles and link with nothing. Rows with one id are one document; rows without
    an id link with nothing, have a null component and are kept. An empty table gives no rows.
    """
    with settings(docs.sparkSession, BATCHES):
        return _near_duplicates(docs, id_col, text_col)


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    signed = staged(
        id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(_signed, "doc_id long, n long, key string, sign binary"), "signatures")
    classes = staged(
        signed.where("doc_id IS NOT NULL AND n > 0").groupBy("key").agg(
            F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sign").alias("sign")), "set-classes")
    texts = id_and_text(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("node"), "text").where(
        "node IS NOT NULL")
    repeated, differing = _repeated_ids(signed)
    if repeated:  # equal rows count once, so that their pairs don't multiply
        texts = texts.distinct()
    ends = _joined(classes.drop("key"), texts)
    same = signed.where("doc_id IS NOT NULL AND n > 0").join(classes.select("key", "node"), "key").selectExpr(
        "doc_id", "node").distinct()
    if differing:
        links = ends.selectExpr("node AS a", "component AS b").unionByName(same.selectExpr("node AS a", "doc_id AS b"))
        alone = same.selectExpr("doc_id AS node", "doc_id AS component").distinct()
        found = components(links)
        found = found.unionByName(alone.join(found, "node", "left_anti"))
    else:
        found = same.join(ends, "node", "left").selectExpr("doc_id AS node", "coalesce(component, node) AS component")
    rows = signed.select("doc_id", F.col("n").alias("n_shingles")).join(
        found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return rows.selectExpr("doc_id", "n_shingles", "coalesce(component, doc_id) AS component_id",
                           "coalesce(component, doc_id) <=> doc_id AS kept")


def _repeated_ids(signed: DataFrame) -> tuple[bool, bool]:
    """Whether an id has several rows, and whether it has different sets, so that classes meet in it."""
    found = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
    ).agg(F.expr("bool_or(rows > 1)"), F.expr("bool_or(low <> high)")).first()
    return bool(found[0]), bool(found[1])


def _joined(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, component) of the classes (node, n, sign) that have links."""
    regions = classes.mapInArrow(_regions, "region long, tree int, node long, n long")
    sizes = staged(regions.groupBy("region").count().where("count > 1"), "region-sizes")
    shared = staged(slot_filter(regions, F.col("region"), sizes, "region").join(sizes, "region"), "regions")
    small = shared.where(f"count <= {SMALL}").groupBy("region").agg(
        F.collect_list(F.struct("node", "n")).alias("members")).select("members")
    crowded = shared.where(f"count > {SMALL}").drop("count")
    ordered = (
        crowded.join(classes.select("node", "sign"), "node").mapInArrow(
            _deeper, "region long, node long, n long, deep binary, bytes binary")
        .repartitionByRange("region", "deep").sortWithinPartitions("region", "deep", "node")
    )
    pairs = small.mapInArrow(_all_pairs, "a long, b long").unionByName(
        ordered.mapInArrow(_neighbours, "a long, b long")).distinct()
    signs = classes.select("node", "sign")
    pairs = staged(
        pairs.join(signs.selectExpr("node AS a", "sign AS sign_a"), "a")
        .join(signs.selectExpr("node AS b", "sign AS sign_b"), "b")
        .mapInArrow(_agreeing, "a long, b long, agreeing long").where(f"agreeing >= {LEAST_AGREEING}"), "candidates")

    # Confirm each class's best candidate, then all that are still apart: a pair within a component
    # needs no texts.
    first = staged(_best(pairs), "to-confirm")
    found = _merged(None, staged(confirm(first, texts), "confirmed"))
    open_ = _apart(pairs.select("a", "b"), found).join(first, ["a", "b"], "left_anti")
    found = _merged(found, staged(confirm(staged(open_, "to-confirm"), texts), "confirmed"))
    rest = _crowded_rest(crowded, found, texts)
    return found if rest is None else _merged(found, rest)


def _merged(found: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components of all links so far; those found before are stars already."""
    if found is not None:
        if links.isEmpty():
            return found
        links = links.unionByName(found.where("node <> component").selectExpr("component AS a", "node AS b"))
    return staged(components(links), "components")


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    labelled = pairs
    for end in "ab":
        labelled = labelled.join(found.selectExpr(f"node AS {end}", f"component AS of_{end}"), end, "left")
    return labelled.where("coalesce(of_a, a) <> coalesce(of_b, b)").select(*pairs.columns)


def _best(pairs: DataFrame) -> DataFrame:
    """For each class the candidate that agrees most."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("end"), F.struct("agreeing", "a", "b").alias("pair"))
    return ends.groupBy("end").agg(F.max("pair").alias("pair")).select("pair.a", "pair.b").distinct()


def _crowded_rest(crowded: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame | None:
    """Links from classes that are apart from the largest component of a crowded region.

    Tokens go from rare to frequent. Two sets that are similar enough share one among their first
    20 % and 1, and what lies behind the first one they share must suffice. Members are counted by
    token, size and place before they are paired, so that a token that all of them share brings
    together only those for which this can hold.
    """
    members = crowded.select("region", "node").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    per = members.groupBy("region", "component").count()
    top = per.groupBy("region").agg(
        F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("kinds")).where("kinds > 1")
    top = staged(top.selectExpr("region", "top.component AS most"), "open-regions")
    if top.isEmpty():
        return None
    members = staged(members.join(top, "region").groupBy("node", "component").agg(
        F.max(F.expr("component <> most")).alias("stray")), "open-members")
    tokens = staged(_with_texts(members.select("node"), texts).mapInArrow(_tokens, "token long, node long, n long"),
                    "open-tokens")
    common = staged(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "open-counts")
    first = (
        tokens.join(common, "token").groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
        .select("node", "n", F.size("t").alias("size"), F.posexplode("t").alias("at", "t"))
        .selectExpr("node", "n", "n - size + at AS at", "t.token AS token")
        .where(f"at <= n - ceil({PERCENT} * n / 100)")
    )
    first = staged(first.join(members, "node"), "open-prefixes")
    places = first.groupBy("token", "n", "at").count().drop("count")
    fits = f"({100 + PERCENT}) * least(x.n - x.at, y.n - y.at) >= {PERCENT} * (x.n + y.n)"
    meets = first.where("stray").alias("x").join(
        places.alias("y"), F.expr(f"x.token = y.token AND {fits}"),
    ).selectExpr("x.node AS x", "x.component AS of_x", "y.token", "y.n", "y.at")
    pairs = meets.join(first.selectExpr("token", "n", "at", "node AS y", "component AS of_y"), ["token", "n", "at"]).where(
        "of_x <> of_y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    return staged(confirm(staged(pairs, "open-pairs"), texts), "open-links")


def op6_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))

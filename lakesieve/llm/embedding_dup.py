"""Near duplicates among embeddings by product quantisation over coarse inverted lists.

Unit vectors belong to the list of their nearest coarse centroid; their residual is a code of one
byte per subspace. A vector is compared with the lists it probes: table look-ups give its asymmetric
distance to every code, and what the stored length of the code's error leaves possible is compared
again in full double precision. So the codes lose nothing; only probing can.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import named, numbered, slices, staged
from .components import components

#: Linked from this cosine on.
COSINE = 0.93
#: Distinct vectors for each coarse centroid, and centroids at most.
PER_CELL, CELLS = 1_024, 1_024
#: Vectors that centroids and codebooks are fitted on: so many for each cell, and these at least.
PER_CENTROID, LEAST_SAMPLE = 16, 4_096
#: Subspaces, and codewords of each.
SUBSPACES, CODEWORDS = 8, 256
#: A list is probed if its border is no further than this many standard deviations of what a vector
#: at the least linked distance lies beyond it in a random direction; never further than all of it.
SPREAD = 3.0
#: Members and probing vectors of a list that one task compares at a time.
SLICE = 2_048
_ROUNDS = 8
_CHORD = math.sqrt(2 - 2 * COSINE)


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (rows @ centres.T - (centres ** 2).sum(axis=1) / 2).argmax(axis=1)


def _means(rows: np.ndarray, k: int, rng: np.random.Generator, unit: bool) -> np.ndarray:
    """k-means; a centre without rows stays where it was, ``unit`` ones are scaled to length 1."""
    centres = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(_ROUNDS):
        at = _nearest(rows, centres)
        sums, counts = np.zeros_like(centres), np.bincount(at, minlength=len(centres))
        np.add.at(sums, at, rows)
        some = counts > 0
        centres[some] = sums[some] / counts[some, None]
        if unit:
            lengths = np.linalg.norm(centres, axis=1, keepdims=True)
            centres = np.where(lengths > 1e-9, centres / np.maximum(lengths, 1e-9), centres)
    return centres


def _parts(size: int) -> list[slice]:
    """The subspaces of ``size`` dimensions."""
    edges = np.linspace(0, size, min(SUBSPACES, size) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Quantizer:
    """Coarse centroids (cells x size) and codebooks of residuals (codewords x size, by subspace)."""

    def __init__(self, cells: np.ndarray, books: np.ndarray) -> None:
        self.cells, self.books = cells, books
        self.parts = _parts(cells.shape[1])

    @classmethod
    def fit(cls, rows: np.ndarray, cells: int) -> Quantizer:
        rng = np.random.default_rng(12)
        coarse = _means(rows, cells, rng, unit=True)
        rest = rows - coarse[_nearest(rows, coarse)]
        books = np.empty((min(CODEWORDS, len(rows)), rows.shape[1]))
        for part in _parts(rows.shape[1]):
            books[:, part] = _means(rest[:, part], len(books), rng, unit=False)
        return cls(coarse, books)

    @classmethod
    def trivial(cls, size: int) -> Quantizer:
        """One list and no code: everything is compared in full."""
        return cls(np.zeros((1, size)), np.zeros((1, size)))

    def homes_and_probes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The list of each row, and a mask (rows x lists) of those it probes, its own included."""
        close = rows @ self.cells.T
        home = (close - (self.cells ** 2).sum(axis=1) / 2).argmax(axis=1)
        apart = np.sqrt(np.maximum(0, 2 - 2 * self.cells[home] @ self.cells.T))
        reach = _CHORD * min(1.0, SPREAD / math.sqrt(rows.shape[1]))
        probed = close[np.arange(len(rows)), home][:, None] - close <= reach * apart
        probed[np.arange(len(rows)), home] = True
        return home, probed

    def encode(self, rows: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows x subspaces) and the length of what they leave out."""
        rest = rows - self.cells[home]
        codes = np.stack([_nearest(rest[:, p], self.books[:, p]) for p in self.parts], axis=1).astype(np.uint8)
        for j, p in enumerate(self.parts):
            rest[:, p] -= self.books[codes[:, j], p]
        return codes, np.linalg.norm(rest, axis=1)

    def estimates(self, queries: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric cosines (queries x codes) with the members of a list, by table look-up."""
        found = np.repeat((queries @ self.cells[cell])[:, None], len(codes), axis=1)
        for j, p in enumerate(self.parts):
            found += (queries[:, p] @ self.books[:, p].T)[:, codes[:, j]]
        return found


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, also where squares would overflow or vanish."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_size(column: pa.Array, dtype: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimensions, places in the batch, raw vectors) of an array of lists without nulls."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths):
        at = np.flatnonzero(lengths == size)
        yield int(size), at, flat[starts[at][:, None] + np.arange(size)]


def _usable(vector: Column, kind: T.DataType) -> Column:
    """No null, no NaN, no infinity, and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast(kind)))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _fit(classes: DataFrame, dtype: str, per_cell: int) -> dict[int, Quantizer]:
    """A quantizer for each number of dimensions, fitted on a sample of bounded size."""
    counts = {r.size: r.n for r in classes.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).collect()}
    share = None
    cells: dict[int, int] = {}
    for size, n in counts.items():
        cells[size] = min(CELLS, max(1, n // per_cell))
        wanted = max(LEAST_SAMPLE, PER_CENTROID * cells[size])
        here = F.when(F.size("vector") == size, F.lit(int(min(1.0, wanted / n) * (1 << 20))))
        share = here if share is None else F.coalesce(share, here)
    if share is None:
        return {}
    sample = classes.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < share).select(
        F.size("vector").alias("size"), "row", "vector")

    def fitted(table: pa.Table) -> pa.Table:
        table = table.sort_by("row").combine_chunks()
        (size, _, raw), = _by_size(table["vector"].chunk(0), dtype)
        model = Quantizer.fit(unit_rows(raw), cells[size])
        return pa.table({"size": pa.array([size], pa.int32()), "cells": [model.cells.tobytes()], "books": [model.books.tobytes()]})

    found = sample.groupBy("size").applyInArrow(fitted, "size int, cells binary, books binary").collect()
    return {r.size: Quantizer(*(np.frombuffer(b).reshape(-1, r.size) for b in (r.cells, r.books))) for r in found}


def _indexed(classes: DataFrame, models, dtype: str) -> DataFrame:
    """Each class with its list, the lists it probes, its code and what the code leaves out."""
    schema = ("node long, label string, size int, copies long, cell int, probes array<int>, code binary, error double, "
              "raw binary")

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = models.value
        for batch in slices(batches, 1_024):
            for size, at, raw in _by_size(batch["vector"], dtype):
                model = known.get(size) or Quantizer.trivial(size)
                rows = unit_rows(raw)
                home, probed = model.homes_and_probes(rows)
                codes, error = model.encode(rows, home)
                taken = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    batch["row"].take(taken), batch["label"].take(taken), pa.array(np.full(len(at), size, np.int32)),
                    batch["copies"].take(taken), pa.array(home.astype(np.int32)),
                    pa.array([np.flatnonzero(p).astype(np.int32) for p in probed], pa.list_(pa.int32())),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error),
                    pa.array([r.tobytes() for r in raw], pa.binary())], names=[f.split()[0] for f in schema.split(", ")])

    return classes.select("row", "label", "copies", "vector").mapInArrow(indexed, schema)


class _Forest:
    """Which members are connected so far; edges are only told where they connect something new."""

    def __init__(self, size: int) -> None:
        self.group = np.arange(size)

    def meet(self, found: np.ndarray) -> np.ndarray:
        """One of ``found`` for each group among them, which are one group from now on."""
        groups, first = np.unique(self.group[found], return_index=True)
        if len(groups) > 1:
            self.group[np.isin(self.group, groups)] = groups[0]
        return found[first]


def compare(model: Quantizer, cell: int, members: dict, queries: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes with links, their number of linked rows, edges that connect all who are linked).

    A link counts for the vector that probes; for the member too, unless that probes the other's list
    and finds the link there.
    """
    owner = np.repeat(np.arange(len(members["node"])), [len(p) for p in members["probes"]])
    probes = np.concatenate(members["probes"])
    per_member, per_query = np.zeros(len(members["node"]), np.int64), np.zeros(len(queries["node"]), np.int64)
    forest, edges, back = _Forest(len(members["node"])), [], {}
    for start in range(0, len(queries["node"]), 64):
        part = slice(start, start + 64)
        rows, ids = queries["rows"][part], queries["node"][part]
        possible = model.estimates(rows, cell, members["codes"]) + members["error"] >= COSINE - 1e-9
        some = np.flatnonzero(possible.any(axis=0))
        linked = possible[:, some] & (rows @ members["rows"][some].T >= COSINE)
        linked &= ids[:, None] != members["node"][some]
        per_query[part] = linked @ members["copies"][some]
        for i in np.flatnonzero(linked.any(axis=1)):
            found = some[linked[i]]
            home = int(queries["cell"][start + i])
            if home not in back:
                back[home] = np.ones(len(members["node"]), bool)
                back[home][owner[probes == home]] = False
            per_member[found[back[home][found]]] += queries["copies"][start + i]
            edges += [(ids[i], members["node"][f]) for f in forest.meet(found)]
    nodes = np.concatenate([members["node"], queries["node"]])
    counts = np.concatenate([per_member, per_query])
    return nodes[counts > 0], counts[counts > 0], np.array(edges, np.int64).reshape(-1, 2)


def _columns(table: pa.Table, size: int, dtype: str) -> dict:
    raw = np.frombuffer(b"".join(table["raw"].to_pylist()), dtype).reshape(-1, size)
    return {c: table[c].to_numpy() for c in ("node", "copies", "cell", "error")} | {
        "probes": table["probes"].to_pylist(), "rows": unit_rows(raw),
        "codes": np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(len(raw), -1)}


def _found(index: DataFrame, models, dtype: str) -> DataFrame:
    """(a, b, n): a count of linked rows for a where b is null, else an edge."""
    keys = ["label", "size", "list"]
    homes = index.withColumn("list", F.col("cell"))
    probing = index.select(*(F.col(c).alias(c) for c in index.columns), F.explode("probes").alias("list"))
    # Long lists are dealt out in slices of members and of probing vectors, all of which meet.
    sliced = homes.groupBy(*keys).agg(F.count("*").alias("n")).join(
        probing.groupBy(*keys).agg(F.count("*").alias("m")), keys).select(
        *keys, F.expr(f"CAST(ceil(n / {SLICE}) AS INT) AS members"), F.expr(f"CAST(ceil(m / {SLICE}) AS INT) AS queries"))
    sliced = staged(sliced, "list-slices")

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        return rows.join(sliced, keys).withColumn("at_" + own, F.expr(f"CAST(pmod(xxhash64(node), {own}) AS INT)")).withColumn(
            "at_" + other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("members", "queries")

    by = [*keys, "at_members", "at_queries"]
    left = dealt(homes, "members", "queries").groupBy(*by)
    right = dealt(probing, "queries", "members").groupBy(*by)

    def compared(members: pa.Table, queries: pa.Table) -> pa.Table:
        if not members.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in "abn"})
        size, cell = members["size"][0].as_py(), members["list"][0].as_py()
        model = models.value.get(size) or Quantizer.trivial(size)
        nodes, counts, edges = compare(model, cell, _columns(members, size, dtype), _columns(queries, size, dtype))
        return pa.table({
            "a": pa.array(np.concatenate([nodes, edges[:, 0]])),
            "b": pa.concat_arrays([pa.nulls(len(nodes), pa.int64()), pa.array(edges[:, 1])]),
            "n": pa.concat_arrays([pa.array(counts), pa.nulls(len(edges), pa.int64())])})

    return left.cogroup(right).applyInArrow(compared, "a long, b long, n long")


def near_embeddings(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    per_cell: int = PER_CELL,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors of one label and one number of dimensions are linked from a cosine of COSINE on. A null
    label, and vectors that are null, empty or zero or hold a null, NaN or infinity, link with
    nothing. Equal vectors of a label are one class that is indexed once; its copies are linked with
    each other and count each. n_links counts rows; component_id is the smallest id that links reach,
    null only if all ids there are null, and kept holds for it. Repeated ids are rows of their own.
    An empty table gives no rows. Labels and all other columns may hold anything.

    The quantizer is fitted on a sample of the distinct vectors (PER_CENTROID for each cell, at least
    LEAST_SAMPLE, so 16,384 at most); all are indexed. Links are symmetric: a pair is compared if one
    of the two probes the other's list.
    """
    kind = vectors.schema[vector_col].dataType.elementType
    dtype = "<f4" if isinstance(kind, T.FloatType) else "<f8"
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        kind = T.DoubleType()
    rows = vectors.select(
        named(id_col).alias("vec_id"), named(label_col).cast("string").alias("label"),
        named(vector_col).cast(T.ArrayType(kind)).alias("vector"))
    usable = F.coalesce(F.col("label").isNotNull() & _usable(F.col("vector"), kind), F.lit(False))
    key = F.when(usable, F.sha2(F.concat_ws(":", F.col("vector").cast("string"), F.col("label")), 256))
    rows = rows.withColumn("key", key)
    classes = staged(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("least"),
        F.count("*").alias("copies")), "vector-classes")
    classes = numbered(classes)

    models = vectors.sparkSession.sparkContext.broadcast(_fit(classes, dtype, per_cell))
    found = staged(_found(staged(_indexed(classes, models, dtype), "vector-index"), models, dtype), "vector-links")
    counts = found.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    grown = staged(components(found.where("b IS NOT NULL").select("a", "b")), "vector-components")
    known = classes.select("row", "key", "least", "copies").join(grown.withColumnRenamed("node", "row"), "row", "left")
    known = staged(known.join(counts.withColumnRenamed("a", "row"), "row", "left").select(
        "key", "least", F.coalesce("component", "row").alias("component"),
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")), "vector-known")
    least = staged(known.groupBy("component").agg(F.min("least").alias("component_id")), "vector-least")
    known = staged(known.join(least, "component").select("key", "n_links", "component_id"), "vector-found")
    return (
        rows.select("vec_id", "key").join(known, "key", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
        .withColumn("kept", F.expr("vec_id <=> component_id"))
    )


def op12_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

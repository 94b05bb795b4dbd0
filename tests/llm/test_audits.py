"""Spelling variants, embedding near-duplicates and the filter audit against brute force."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakesieve.llm import embedding_dup, filter_audit, spelling

from helpers import LOWER, no_documents, odd_documents, texts_of


def by_all(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Spelling variants

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def spelling_by_force(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    words = sorted(w for w, k in n.items() if len(w) >= 6 and k >= 5)
    near = defaultdict(list)
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        near[w] = [x for size in (-1, 0, 1) for x in by_length[len(w) + size] if one_edit(w, x)]
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=3, max_size=8), min_size=1, max_size=60, unique=True),
       st.text(alphabet="abé", min_size=3, max_size=8))
def test_scan_of_a_sorted_list(words, query):
    words = sorted(words)
    assert [words[i] for i in spelling.SortedList(words).near(query)] == [w for w in words if one_edit(w, query)]
    start = 2
    same = [w for w in words if w[:start] == query[:start]]
    assert [same[i] for i in spelling.SortedList(same).near(query, start)] == [w for w in same if one_edit(w, query)]


def test_spelling_of_all_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    expected = spelling_by_force(texts_of(docs))
    assert by_all(spelling.op11_spelling_variants(spark, small)) == expected
    assert any(form for _, form, *_ in expected)


@pytest.mark.parametrize("long_list", [4_096, 3])
def test_spelling_of_variants_everywhere(spark, monkeypatch, long_list):
    monkeypatch.setattr(spelling, "LIST", long_list)
    rng = np.random.default_rng(3)
    letters = list("abcéÿ")
    bases = ["".join(rng.choice(letters, size=k)) for k in (6, 7, 8, 9, 13) for _ in range(4)]
    words = Counter()
    for b in bases:
        words[b] += int(rng.integers(100, 4_000))
        for _ in range(12):
            at, kind = int(rng.integers(0, len(b) + 1)), int(rng.integers(0, 3))
            w = b[:at] + (rng.choice(letters) if kind else "") + b[at + (kind < 2):]
            words[w] += int(rng.integers(5, 40))
    words |= {"chainword": 3_000, "chainwore": 300, "chainworee": 20}
    docs = [(i, (" " + w.upper() if i % 2 and w.isascii() else " " + w) * n) for i, (w, n) in enumerate(words.items())]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = by_all(spelling.spelling_variants(rows))
    assert got == spelling_by_force(docs)
    assert any(r[1] and r[2] != r[1] for r in got)


def test_spelling_of_odd_documents(spark):
    docs = odd_documents(spark)
    assert by_all(spelling.spelling_variants(docs)) == spelling_by_force([(i, t) for i, t in texts_of(docs)])
    assert spelling.spelling_variants(no_documents(spark)).count() == 0


# Near-duplicate embeddings

VECTORS = "vec_id long, embedding array<float>, label int, n_links string, key string, row long"


def embeddings_by_force(rows):
    """(vec_id, n_links, component_id, kept) per row, all pairs compared."""
    usable = [v is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
              for _, v, label, *_ in rows]
    unit = [np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if u else None
            for (_, v, *_), u in zip(rows, usable, strict=True)]
    groups = defaultdict(list)
    for i, u in enumerate(usable):
        if u:
            groups[rows[i][2], len(rows[i][1])].append(i)
    links, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at in groups.values():
        cosines = np.stack([unit[i] for i in at]) @ np.stack([unit[i] for i in at]).T
        for x, y in zip(*np.nonzero(np.triu(cosines >= 0.93, 1)), strict=True):
            links[at[x]] += 1
            links[at[y]] += 1
            parent[find(at[x])] = find(at[y])
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)].append(r[0])
    return sorted(((r[0], links[i], c := min(ids[find(i)], default=None), r[0] == c) for i, r in enumerate(rows)), key=repr)


def clusters(rng, sizes, dims, spread):
    """Unit vectors around centres, and what is far from all."""
    found = []
    for size in sizes:
        centre = rng.normal(size=dims)
        centre /= np.linalg.norm(centre)
        found += [centre + spread * rng.normal(size=dims) / np.sqrt(dims) for _ in range(size)]
    return found


@pytest.mark.parametrize("per_cell, list_slice", [(1_024, 2_048), (20, 16)])
def test_embeddings_in_clusters(spark, monkeypatch, per_cell, list_slice):
    monkeypatch.setattr(embedding_dup, "SLICE", list_slice)
    rng = np.random.default_rng(5)
    vectors = clusters(rng, [90, 30, 10, 5, 3, 2, 2] + [1] * 150, 24, 0.2)
    vectors += [vectors[0]] * 40 + [3 * v for v in vectors[100:110]]
    rows = [(int(i), [float(x) for x in np.float32(v)], int(rng.integers(0, 2)), "x", "y", 0)
            for i, v in zip(rng.permutation(len(vectors)), vectors, strict=True)]
    got = by_all(embedding_dup.near_embeddings(spark.createDataFrame(rows, VECTORS), per_cell=per_cell))
    expected = embeddings_by_force(rows)
    assert max(r[1] for r in expected) > 40
    if per_cell == 1_024:  # one list: nothing can be missed
        assert got == expected
    else:
        assert sum(r[1] for r in got) > 0.99 * sum(r[1] for r in expected)
        assert all(a[1] <= b[1] for a, b in zip(got, expected, strict=True))


def test_odd_embeddings(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(i, v, label, None, None, None) for i, v, label in [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, [0.0, 0.0], 1),
        (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1), (9, None, 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.01], 1), (12, [1e-30, 0.0], 1), (12, [1e30, 0.0], 1), (1, [1.0, 0.0], 1), (None, [0.0, 1.0], 1),
        (None, [0.0, 1.0], 1), (13, [-0.0, 1.0], 3), (14, [0.0, 1.0], 3)]]
    got = by_all(embedding_dup.near_embeddings(spark.createDataFrame(rows, VECTORS)))
    expected = sorted(((i, n, c, i is None and c is None or k) for i, n, c, k in embeddings_by_force(rows)), key=repr)
    assert got == expected
    assert embedding_dup.near_embeddings(spark.createDataFrame([], VECTORS)).count() == 0
    doubles = spark.createDataFrame([(i, v, 1) for i, v in [(1, [1e-200, 0.0]), (2, [1e200, 0.0])]],
                                    "vec_id long, embedding array<double>, label int")
    assert by_all(embedding_dup.near_embeddings(doubles)) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_recall_of_embeddings(spark, medium):
    vectors = spark.read.parquet(f"{medium}/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    rng = np.random.default_rng(8)
    top = max(r[0] for r in rows) + 1
    rows += [(top + i, [float(x) for x in np.array(r[1]) + rng.normal(size=64) * 0.36 / 8], r[2]) for i, r in enumerate(rows)]
    near = embedding_dup.near_embeddings(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), per_cell=32)
    got, expected = sum(r.n_links for r in near.collect()), sum(r[1] for r in embeddings_by_force(rows))
    assert expected > 500 and 0.99 * expected < got <= expected


# Filter audit

def audit_by_force(docs, labels):
    firsts, marks = {}, defaultdict(lambda: [0, 0])
    for i, text, _ in docs:
        if i is not None:
            firsts[text or ""] = min(i, firsts.get(text or "", i))
    for i, quality, toxic in labels:
        marks[i][0] |= quality == 1
        marks[i][1] |= toxic == 1
    rows = []
    for i, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {f for f, failed in {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
            "E": i is not None and i > firsts[text]}.items() if failed}
        rows.append((part or "", fails, *(marks[i] if i is not None else (0, 0))))
    out, shapley = [], Counter()
    for part in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] += len(gone)
                out.append([part, "".join(order), k + 1, f, len(left), len(gone), sum(f in r[1] for r in own) - len(gone),
                            sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)])
    return sorted((tuple(r) + (shapley[r[0], r[3]],) for r in out), key=repr)


def test_audit_of_odd_documents(spark):
    words = " ".join(f"w{n}" for n in range(300))
    long = [(21, words, "en", None, None), (22, words, "en", "s", None), (20, words, "en", "s", None), (20, words, "en", "t", None),
            (23, words + " A#" * 10, "en", "s", None), (24, "Same word " * 150, "en", "s", None), (None, words, "en", "s", None)]
    docs = odd_documents(spark).unionByName(
        spark.createDataFrame(long, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    labels = [(21, 1, 0), (21, 0, 1), (22, None, 1), (None, 1, 1), (23, 1, 1), (99, 1, 1), (24, 1, None), (7, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    got = by_all(filter_audit.audit_filters(docs, marks))
    assert got == audit_by_force([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], labels)
    assert filter_audit.audit_filters(no_documents(spark), marks).count() == 0
    assert filter_audit.audit_filters(docs, marks.limit(0)).count() == 3 * 120 * 5


def test_contractions_of_a_random_tensor():
    tensor = np.random.default_rng(2).integers(0, 9, (2,) * 5 + (3,))
    taken = [{}, {"A": filter_audit.FAIL}, {"E": filter_audit.PASS, "B": filter_audit.FAIL}]
    got = filter_audit.contract(tensor, taken)
    assert got.tolist() == [tensor.sum(axis=(0, 1, 2, 3, 4)).tolist(), tensor[1].sum(axis=(0, 1, 2, 3)).tolist(),
                            tensor[:, 1, :, :, 0].sum(axis=(0, 1, 2)).tolist()]

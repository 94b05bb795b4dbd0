"""Small brute-force versions that the operators are compared with."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, __h bigint"


def odd_documents(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash with results."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    texts = [
        (1, base), (2, None), (3, ""), (4, base.upper()), (5, " \t\n"), (6, "word " * 60_000), (7, "too short"),
        (7, "too short"), (None, base), (8, base + " sixteen"), (9, "Ünïcödé ßtraße 😀 中文 naïve"), (10, "12 34 !!"),
        (11, "\x00\x01 odd line ퟿"), (12, "a" * 20_000), (13, "Too Short"), (None, None),
    ]
    rows = [(i, t, "en" if n % 2 else None, None, None, 0.5, "x", n) for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def shingle_set(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(zip(*[words[i:] for i in range(n)], strict=False))


def near_components(docs):
    """id -> (n_shingles, component) by comparing all pairs of rows."""
    rows = [(i, shingle_set(t)) for i, t in docs if i is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(rows):
        for j, b in rows[n + 1:]:
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both) and find(i) != find(j):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(s), find(i)) for i, s in rows}


def contamination(text, items):
    """(n_words, n_hit, sorted ids of items with a window in the text)."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    words = re.findall(pattern, text.translate(LOWER))
    hit, found = set(), set()
    for item, said in items:
        own = re.findall(pattern, (said or "").translate(LOWER))
        size = min(13, len(own))
        windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1 if own else 0):
            if tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


class KneserNey:
    """Interpolated Kneser-Ney over characters with plain dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {order: Counter(g for t in texts for g in grams(t, order))}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.total, self.kinds = defaultdict(int), Counter()
        for level in self.counts.values():
            for g, c in level.items():
                self.total[g[:-1], len(g)] += c
                self.kinds[g[:-1], len(g)] += 1

    def discount(self, n):
        once, twice = (sum(c == k for c in self.counts[n].values()) for k in (1, 2))
        return once / (once + 2 * twice) if once and twice else 0.5

    def chance(self, gram, symbols):
        p = 1 / symbols
        for n in range(1, self.order + 1):
            g = gram[self.order - n:]
            key = g[:-1], n
            if self.total[key]:
                d = self.discount(n)
                p = max(self.counts[n][g] - d, 0) / self.total[key] + d * self.kinds[key] / self.total[key] * p
        return p


def grams(text, order):
    found, last = [], " "
    padded = " " * (order - 1)
    for ch in text.lower():
        ch = ch if ch.isalpha() else " "
        if ch == " " and last == " ":
            continue
        padded += ch
        last = ch
        found.append(padded[-order:])
    return found


def bits(model, text, order, symbols):
    found = grams(text, order)
    return sum(-math.log2(model.chance(g, symbols)) for g in found) / len(found)

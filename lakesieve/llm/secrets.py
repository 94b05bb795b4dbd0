"""Secret scan by grammar inference.

Credentials that fixed patterns find are the labelled examples. For each kind their prefix tree is
folded into a probabilistic automaton by merging states that are statistically alike. Every other
token of 6 characters or more is scored: how much likelier is it under a kind's format than as plain digits or letters?
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, map_texts, staged

#: Kinds of the fixed patterns, in their order: pattern, the group that is the credential, its least length.
PATTERNS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.ASCII | re.IGNORECASE), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
#: What every match of a pattern holds; other texts needn't be searched.
HINTS = {"assign": re.compile(r"[:=]"), "access": re.compile("AKIA"), "hex": re.compile(r"[0-9a-f]{24}")}
#: Tokens that are scored, from the least length of a credential on, and what is no part of one at its ends.
LEAST_LENGTH = min(least for _, _, least in PATTERNS.values())
CANDIDATE, TRIM = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % LEAST_LENGTH), "./_=-"
#: Tokens whose kind a worker remembers, as words repeat; those up to so many characters.
REMEMBERED, SHORT = 1 << 16, 64
#: Examples per kind that an automaton is learnt from: a classifier's bounded sample, the distinct
#: credentials whose hash is smallest.
EXAMPLES = 2_000
#: Confidence of the Hoeffding test, and bits by which a format must beat plain text at least.
ALPHA, LEAST_BITS = 0.05, 16.0
#: Sizes of the plain alphabets: digits, lower and upper case, letters, all that a token may hold.
PLAIN = [(str.isdigit, 10), (lambda t: t.isalpha() and t.islower(), 26), (lambda t: t.isalpha() and t.isupper(), 26),
         (str.isalpha, 52), (lambda t: True, 68)]


def base_spans(text: str) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, credential), leftmost and non-overlapping per kind, too short ones dropped."""
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if HINTS[kind].search(text):
            found += [(m.start(), kind, m.end(), m[group]) for m in pattern.finditer(text) if len(m[group]) >= least]
    order = list(PATTERNS)
    return sorted(found, key=lambda s: (s[0], order.index(s[1])))


class Automaton:
    """A probabilistic automaton: per state how often strings end and which symbol leads where."""

    def __init__(self, ends: list[int], edges: list[dict[str, list[int]]]) -> None:
        self.ends, self.edges = ends, edges
        self._totals = [e + sum(n for _, n in out.values()) for e, out in zip(ends, edges, strict=True)]

    def bits(self, token: str) -> float:
        """Cost of a token in bits; what was never seen is infinitely unlikely."""
        state, cost = 0, 0.0
        for ch in token:
            step = self.edges[state].get(ch)
            if step is None:
                return math.inf
            cost -= math.log2(step[1] / self._totals[state])
            state = step[0]
        # Lengths vary more than examples show, so ending costs at most as much as a rare symbol.
        return cost + min(8.0, -math.log2(max(self.ends[state], 0.5) / self._totals[state]))

    def gain(self, token: str) -> float:
        """Bits by which this format beats the best plain alphabet."""
        plain = min(size for test, size in PLAIN if test(token))
        return len(token) * math.log2(plain) - self.bits(token)


def infer(examples: Iterable[str], alpha: float = ALPHA) -> Automaton:
    """Merge the states of the examples' prefix tree, most frequent first, wherever they are alike."""
    ends, edges = [0], [{}]
    for token in examples:
        node = 0
        for ch in token:
            step = edges[node].setdefault(ch, [len(ends), 0])
            if step[0] == len(ends):
                ends.append(0)
                edges.append({})
            step[1] += 1
            node = step[0]
        ends[node] += 1
    totals = [e + sum(n for _, n in out.values()) for e, out in zip(ends, edges, strict=True)]
    bound = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(n1: int, of1: int, n2: int, of2: int) -> bool:
        return abs(n1 / of1 - n2 / of2) > bound * (1 / math.sqrt(of1) + 1 / math.sqrt(of2))

    def alike(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            x, y = todo.pop()
            if x == y or not totals[x] or not totals[y]:
                continue
            if differ(ends[x], totals[x], ends[y], totals[y]):
                return False
            for ch in edges[x].keys() | edges[y].keys():
                to_x, to_y = edges[x].get(ch), edges[y].get(ch)
                if differ(to_x[1] if to_x else 0, totals[x], to_y[1] if to_y else 0, totals[y]):
                    return False
                if to_x and to_y:
                    todo.append((to_x[0], to_y[0]))
        return True

    def fold(into: int, gone: int) -> None:
        todo = [(into, gone)]
        while todo:
            x, y = todo.pop()
            if x == y:
                continue
            ends[x] += ends[y]
            totals[x] += totals[y]
            for ch, (to, n) in edges[y].items():
                if ch in edges[x]:
                    edges[x][ch][1] += n
                    todo.append((edges[x][ch][0], to))
                else:
                    edges[x][ch] = [to, n]

    kept = [0]
    while True:
        settled = set(kept)
        fringe = [(totals[step[0]], -step[0], node, ch) for node in kept for ch, step in edges[node].items()
                  if step[0] not in settled]
        if not fringe:
            break
        _, to, node, ch = max(fringe)
        like = next((k for k in kept if alike(k, -to)), None)
        if like is None:
            kept.append(-to)
        else:
            edges[node][ch][0] = like
            fold(like, -to)
    number = {node: i for i, node in enumerate(kept)}
    return Automaton([ends[k] for k in kept], [{ch: [number[to], n] for ch, (to, n) in edges[k].items()} for k in kept])


def _learn(examples: pd.DataFrame) -> pd.DataFrame:
    tokens = sorted(examples["credential"])
    made = infer(tokens)
    least = max(LEAST_BITS, 0.5 * min(made.gain(t) for t in tokens))
    return pd.DataFrame({"kind": [examples["kind"].iloc[0]], "model": [json.dumps([made.ends, made.edges, least])]})


def learn_formats(docs: DataFrame) -> dict[str, str]:
    """A model per kind, as JSON, from the credentials that the fixed patterns find in ``docs``."""
    def labelled(texts: list[str]) -> list[list]:
        return [[sorted({f"{kind}:{token}" for _, kind, _, token in base_spans(t)}) for t in texts]]

    found = map_texts(id_and_text(docs), "found array<string>", labelled).select(F.explode("found").alias("found"))
    distinct = found.distinct().selectExpr(
        "substring_index(found, ':', 1) AS kind", "substr(found, instr(found, ':') + 1) AS credential")
    examples = None
    for kind in PATTERNS:
        part = distinct.where(F.col("kind") == kind).orderBy(F.xxhash64("credential"), "credential").limit(EXAMPLES)
        examples = part if examples is None else examples.unionByName(part)
    learnt = staged(examples, "credentials").groupBy("kind").applyInPandas(_learn, "kind string, model string")
    return {r.kind: r.model for r in learnt.collect()}


@lru_cache(maxsize=8)
def _formats(models: tuple[tuple[str, str], ...]) -> list[tuple[str, Automaton, float]]:
    return [(kind, Automaton(ends, edges), least)
            for kind, (ends, edges, least) in ((k, json.loads(m)) for k, m in models)]


class _Kinds(dict):
    """Token -> the kind whose format explains it best, or none."""

    def __init__(self, formats: list[tuple[str, Automaton, float]]) -> None:
        super().__init__()
        self._formats = formats

    def __missing__(self, token: str) -> str:
        best = max(((made.gain(token) - least, kind) for kind, made, least in self._formats), default=(-1.0, ""))
        found = best[1] if best[0] >= 0 else ""
        if len(token) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[token] = found
        return found


@lru_cache(maxsize=8)
def _kinds(models: tuple[tuple[str, str], ...]) -> _Kinds:
    return _Kinds(_formats(models))


def added_spans(text: str, base: list[tuple[int, str, int, str]], models: tuple[tuple[str, str], ...]) -> list[tuple[int, str, int]]:
    """Tokens that some format explains well, as like_<kind>; none that lies within a base span."""
    added = []
    kinds = _kinds(models)
    for m in CANDIDATE.finditer(text):
        token = m[0].strip(TRIM)
        if len(token) < LEAST_LENGTH or not (kind := kinds[token]):
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip(TRIM))
        end = start + len(token)
        if not any(s <= start and end <= e for s, _, e, _ in base):
            added.append((start, f"like_{kind}", end))
    return added


def find_secrets(docs: DataFrame, models: dict[str, str]) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    Spans are kind:start:end in code points, by start and then kind, joined by commas; the digest is
    of the base ones. Null and empty texts have none; repeated rows repeat results. Models are a few
    KB per kind, learnt by ``learn_formats``; without any, only base spans are found.
    """
    known = tuple(sorted(models.items()))
    order = [*PATTERNS, *(f"like_{k}" for k in PATTERNS)]

    def scan(texts: list[str]) -> list[list]:
        columns: list[list] = [[], [], [], [], [], []]
        for text in texts:
            base = base_spans(text)
            counts = Counter(kind for _, kind, _, _ in base)
            added = added_spans(text, base, known)
            both = sorted([(s, order.index(k), k, e) for s, k, e, _ in base] + [(s, order.index(k), k, e) for s, k, e in added])
            digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e, _ in base).encode()).hexdigest()
            row = (*(counts[k] for k in PATTERNS), digest, ",".join(f"{k}:{s}:{e}" for s, _, k, e in both), len(added))
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        return columns

    return map_texts(id_and_text(docs), "n_assign long, n_access long, n_hex long, base_sha256 string, "
                     "spans string, n_added long", scan)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find_secrets(docs, learn_formats(docs))

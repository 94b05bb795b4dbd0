"""Token counts by longest match in linear time, without building the tokens.

A trie of the vocabulary gets, at each node, a failure link and the number of tokens that are done
when it is taken. Reading a word follows trie edges and failure links only, so every character is
read once and the count is a sum of the numbers on the way.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, SparkSession

from .common import id_and_text, map_texts

#: Words that a worker remembers; it starts over when there are more.
MEMORY = 1 << 19
#: What stands for the end of a word in the vocabulary, and the character used for it here.
WORD_END, MARK = "</w>", "\x00"
#: Words of a lower-cased text; white space is dropped.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class Counter:
    """Number of tokens of a word when the longest token is taken from the left, again and again."""

    def __init__(self, tokens: list[str]) -> None:
        self._edges: list[dict[str, int]] = [{}]
        ends = set()
        for token in tokens:
            node = 0
            for ch in token:
                if ch not in self._edges[node]:
                    self._edges[node][ch] = len(self._edges)
                    self._edges.append({})
                node = self._edges[node][ch]
            ends.add(node)
        ends.discard(0)
        self._link(ends)

    def _link(self, ends: set[int]) -> None:
        """Failure links and popped tokens, level by level; -1 where no token can end."""
        self._fail, self._popped = [-1] * len(self._edges), [0] * len(self._edges)
        level = [0]
        while level:
            below = []
            for node in level:
                for ch, child in self._edges[node].items():
                    below.append(child)
                    if child in ends:
                        self._fail[child], self._popped[child] = 0, 1
                        continue
                    at, popped = self._fail[node], self._popped[node]
                    while at >= 0 and ch not in self._edges[at]:
                        popped += self._popped[at]
                        at = self._fail[at]
                    if at >= 0:
                        self._fail[child], self._popped[child] = self._edges[at][ch], popped
            level = below

    def count(self, word: str) -> int:
        """1 for a word that the vocabulary can't spell (it is one unknown token), 0 if empty."""
        edges, fail, popped = self._edges, self._fail, self._popped
        node = total = 0
        for ch in word:
            while ch not in edges[node]:
                if fail[node] < 0:
                    return 1
                total += popped[node]
                node = fail[node]
            node = edges[node][ch]
        while node:
            if fail[node] < 0:
                return 1
            total += popped[node]
            node = fail[node]
        return total


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in such vocabularies.

    Printable Latin-1 characters stand for themselves, the others for letters from U+0100 on.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + n) for n, b in enumerate(rest)}}


def read_vocabulary(raw: bytes) -> list[str]:
    """Tokens of a vocabulary in JSON, word ends marked by one character, special tokens left out."""
    data = json.loads(raw)
    special = {t["content"] for t in data.get("added_tokens", []) if t.get("special")}
    return [t.removesuffix(WORD_END) + MARK * t.endswith(WORD_END) for t in data["model"]["vocab"] if t not in special]


class TextCounter:
    def __init__(self, tokens: list[str]) -> None:
        self._counter = Counter(tokens)
        self._letters = {chr(b): ch for b, ch in byte_letters().items()}
        self._words = regex.compile(WORDS).findall
        self._known: dict[str, int] = {}

    def count(self, text: str) -> int:
        known, total = self._known, 0
        for word in self._words(text.lower()):
            n = known.get(word)
            if n is None:
                spelt = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(str.maketrans(self._letters))
                n = self._counter.count(spelt + MARK)
                if len(known) >= MEMORY:
                    known.clear()
                if len(word) < 64:
                    known[word] = n
            total += n
        return total


@lru_cache(maxsize=4)
def _text_counter(raw: bytes) -> TextCounter:
    return TextCounter(read_vocabulary(raw))


def count_tokens(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens. Null and empty texts have none.

    The vocabulary is read by the driver and broadcast (a file below 2 MB for 50,000 tokens); each
    worker builds the automaton once. Nothing is shuffled.
    """
    with open(vocabulary_path, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(texts: list[str]) -> list[list]:
        counter = _text_counter(raw.value)
        return [[counter.count(text) for text in texts]]

    return map_texts(id_and_text(docs), "n_tokens long", count)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))

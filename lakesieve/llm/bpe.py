"""Byte-level BPE: exact merges in linear time by backtracking over longest matches.

An Aho-Corasick automaton over the vocabulary, its bytes mapped to Latin-1, gives the longest token
from each position of a piece; in short pieces its trie is asked only where a token ends. A token may follow another only if no merge would have run across
their border; that is remembered per pair. Where it may not, the next shorter token is tried, and
where none is left, the token before is taken back and that position never tried again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import id_and_text, map_texts

#: Words and token pairs that a worker remembers of each (some 200 bytes a word), and an eighth as many pieces;
#: with more it forgets those not used lately.
MEMORY = 1 << 19
#: Bytes of a piece from which on the automaton runs over all of it.
LONG = 32
#: Patterns of which the above is known: a space only begins a match or is inside white space.
SPACED_PATTERNS = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",
)
#: A space that doesn't stand before a word.
WIDE_SPACE = regex.compile(r" \s").search


class Memo(dict):
    """What ``fn`` gave for short keys. Half the room full, it starts over with the other half: keys that
    are used again come along, all else is forgotten the next time."""

    def __init__(self, fn: Callable, room: int = MEMORY) -> None:
        super().__init__()
        self._fn, self._half, self._before = fn, room // 2, {}

    def __missing__(self, key):
        value = self._before.get(key)
        if value is None:
            value = self._fn(key)
            if len(key) >= 32:
                return value
        if len(self) >= self._half:
            self._before = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    """Encodes and decodes bytes with the ranks of a byte-level BPE vocabulary."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes = {i: token for token, i in ranks.items()}
        self.size = {i: len(token) for token, i in ranks.items()}
        self._automaton = ahocorasick.Automaton()
        for token, i in ranks.items():
            self._automaton.add_word(token.decode("latin-1"), (i, len(token) - 1))
        self._by_path = self._paths()
        self._automaton.make_automaton()
        self._shorter = {i: self._prefix(token) for token, i in ranks.items()}
        self._parts: dict[int, tuple[int, int]] = {}
        self._merged: dict[tuple[int, int], int] = {}
        for token, i in sorted(ranks.items(), key=lambda item: item[1]):
            self._split(token, i)
        self._fits = Memo(lambda pair: self._compatible(*pair))

    def _paths(self) -> dict[str, int | None]:
        """The longest token that each beginning of a token begins with, tokens themselves included."""
        found = {token.decode("latin-1"): i for token, i in self.ranks.items()}
        for text in [*found]:
            n = len(text) - 1
            while n and text[:n] not in found:
                n -= 1
            found.update(dict.fromkeys((text[:m] for m in range(n + 1, len(text))), found.get(text[:n])))
        return found

    def _prefix(self, token: bytes) -> int | None:
        """The longest shorter token that ``token`` begins with."""
        return next((self.ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in self.ranks), None)

    def _split(self, token: bytes, i: int) -> None:
        """Remember the two tokens whose merge makes this one; single bytes have none."""
        left = self._shorter[i]
        while left is not None:
            right = self.ranks.get(token[len(self.bytes[left]):])
            if right is not None and left < i and right < i and self._compatible(left, right):
                self._merged[left, right] = i
                self._parts[i] = left, right
                return
            left = self._shorter[left]

    def _compatible(self, left: int, right: int) -> bool:
        """Whether BPE leaves this border alone.

        Both tokens are taken apart along their merges, the later merge first. A pair that meets
        at the border on the way must not have a merge that comes before what was undone so far.
        """
        limit = 1 << 62
        while True:
            if self._merged.get((left, right), limit) < limit:
                return False
            open_left, open_right = left in self._parts, right in self._parts
            if open_left and (left > right or not open_right):
                limit, left = left, self._parts[left][1]
            elif open_right:
                limit, right = right + 1, self._parts[right][0]
            else:
                return True

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece, as merging by rank would give them."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        longest = self._longest(piece.decode("latin-1"))
        size = self.size
        fits, shorter, stop = self._fits, self._shorter, len(piece)
        dead = bytearray(stop + 1)
        ids: list[int] = []
        at, token = 0, longest(0) if piece else None
        while at < stop:
            if token is None:
                if not ids:
                    raise ValueError("a byte of the text is not in the vocabulary")
                dead[at] = 1
                token = ids.pop()
                at -= size[token]
                token = shorter[token]
                continue
            end = at + size[token]
            if not dead[end] and (not ids or fits[ids[-1], token]):
                ids.append(token)
                at, token = end, longest(end) if end < stop else None
            else:
                token = shorter[token]
        return ids

    def _longest(self, text: str) -> Callable[[int], int | None]:
        """The longest token from a position of ``text`` on."""
        if len(text) >= LONG:
            found: list[int | None] = [None] * len(text)
            for end, (i, before) in self._automaton.iter(text):
                found[end - before] = i  # matches come by their end, so the longest comes last
            return found.__getitem__
        reach, by_path = self._automaton.longest_prefix, self._by_path.get

        def longest(at: int) -> int | None:
            rest = text[at:]
            return by_path(rest[:reach(rest)])

        return longest

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


class TextEncoder:
    """Cuts texts into pieces by a pattern and encodes each.

    Between two words that one space parts, a match of the usual patterns begins at the space and
    looks at nothing before it. So such texts are cut at their spaces, and what is between them
    (a word and its punctuation) is encoded once and remembered.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY) -> None:
        self.encoder = Encoder(ranks)
        self._pieces = regex.compile(pattern).findall
        self._first, self._spaced = Memo(self._whole, memory // 8), Memo(self._after_space, memory)
        self._other = Memo(lambda piece: tuple(self.encoder.encode(piece.encode("utf-8", "surrogatepass"))), memory // 8)
        self._by_spaces = pattern in SPACED_PATTERNS

    def _whole(self, text: str) -> tuple[int, ...]:
        ids: list[int] = []
        for piece in self._pieces(text):
            word = piece[1:]
            ids += self._spaced[word] if piece[0] == " " and word.isalpha() else self._other[piece]
        return tuple(ids)

    def _after_space(self, words: str) -> tuple[int, ...]:
        if words.isalpha():  # letters only: one piece, which needs no pattern to be found
            return tuple(self.encoder.encode((" " + words).encode()))
        if words[:-1].isalpha() and words[-1] in ".,":
            return *self._spaced[words[:-1]], self.encoder.ranks[words[-1].encode()]
        return self._whole(" " + words)

    def encode(self, text: str) -> list[int]:
        if not self._by_spaces or text.endswith(" ") or WIDE_SPACE(text):
            return list(self._whole(text))
        first, *spaced = text.split(" ")
        return [*self._first[first], *chain.from_iterable(map(self._spaced.__getitem__, spaced))]

    def joined(self, ids: list[int]) -> str:
        return str(ids)[1:-1].replace(",", "")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks from lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines()) if token}


class Vocabulary:
    """The rank file and, once a worker has built it, the encoder, which is never sent."""

    def __init__(self, raw: bytes, pattern: str, memory: int) -> None:
        self._made_of, self._encoder = (raw, pattern, memory), None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_encoder": None}

    def encoder(self) -> TextEncoder:
        if self._encoder is None:
            raw, pattern, memory = self._made_of
            self._encoder = TextEncoder(read_ranks(raw), pattern, memory)
        return self._encoder


def encode_texts(docs: DataFrame, ranks_path: str, pattern: str, ids: bool = False, memory: int = MEMORY) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256 (and the ids).

    The ids are hashed as decimals joined by one space, the decoded bytes as they are. Null texts
    count as empty: no tokens and the digests of nothing. The rank file is read by the driver and
    broadcast (its size is the vocabulary's, below 1 MB for 50,000 tokens); each worker builds the
    automaton once, remembers ``memory`` words and keeps both while it gets tasks of this query, no longer. A text is held by one task, and nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(_file(ranks_path), pattern, memory))

    def encode(texts: list[str]) -> list[list]:
        coder = shared.value.encoder()
        counts, joined, decoded, all_ids = [], [], [], []
        for text in texts:
            found = coder.encode(text)
            counts.append(len(found))
            joined.append(hashlib.sha256(coder.joined(found).encode()).hexdigest())
            decoded.append(hashlib.sha256(coder.encoder.decode(found)).hexdigest())
            if ids:
                all_ids.append(found)
        return [counts, joined, decoded, *([all_ids] if ids else [])]

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return map_texts(id_and_text(docs), columns, encode)


def _file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)

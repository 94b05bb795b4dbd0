"""Spelling variants: words one edit apart, found by dynamic programming along sorted word lists.

A sorted list is scanned with a stack of edit-matrix rows, banded to three cells. The rows of what a
word shares with the word before are reused; a prefix whose row has no cell of at most one edit is
left together with all words that go on from it. Two words one edit apart share at least half of the
shorter one at their start or their end, so lists hold words with one such start (or, reversed, end)
and nearly one length, and each list is some task's small share.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import named, slices, staged

#: Letters of a word, and how often it has to occur; a form is this many times as frequent as the word.
LEAST_LETTERS, LEAST_COUNT, TIMES = 6, 5, 5
#: Runs of a document whose checksum this number divides lose a letter.
ONE_IN = 199
#: Words of a list that one task scans; a longer list is dealt out, and all words look through all of it.
LIST = 4_096
#: Distinct words a task counts before it passes them on.
HELD = 1 << 18
_RUNS = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS).findall


def _altered(doc_id: str, run: bytes) -> bytes:
    """A lower-cased run in Latin-1, without the letter that the document's checksum picks, if any."""
    said = run if run.isascii() else run.decode("latin-1").encode()
    h = zlib.crc32(f"{doc_id}:".encode() + said)
    if h % ONE_IN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def words_of(doc_id: str, text: str) -> Counter[bytes]:
    """Words of a text in Latin-1 and how often they occur; shorter runs can't become words."""
    found: Counter[bytes] = Counter()
    for run, n in Counter(_RUNS(text)).items():
        found[run.encode("latin-1").lower()] += n  # bytes: A-Z only
    words: Counter[bytes] = Counter()
    for run, n in found.items():
        word = _altered(doc_id, run)
        if len(word) >= LEAST_LETTERS:
            words[word] += n
    return words


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all texts, counted within tasks before the shuffle."""
    rows = docs.select(F.coalesce(named(id_col).cast("string"), F.lit("")).alias("doc_id"),
                       named(text_col).cast("string").alias("text")).where("text IS NOT NULL")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for word, n in words_of(doc_id, text).items():
                    held[word] += n
                if len(held) > HELD:
                    yield _as_batch(held)
                    held.clear()
        yield _as_batch(held)

    found = rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST_COUNT)


def _as_batch(held: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())],
        names=["word", "n"])


def shared(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low + 1 < high:  # a[:low] and b[:low] are the same, a[:high] and b[:high] are not
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class SortedList:
    """Distinct sorted words that can be searched for all within one edit of another."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        self.lcps = [0, *map(shared, words, words[1:])]
        # Where the next word is that shares less with the one before it than this one does.
        self._next = [len(words)] * len(words)
        waiting: list[int] = []
        for i, lcp in enumerate(self.lcps):
            while waiting and lcp < self.lcps[waiting[-1]]:
                self._next[waiting.pop()] = i
            waiting.append(i)

    def near(self, query: str, start: int = 0) -> list[int]:
        """Places of the words that differ from ``query`` by exactly one edit.

        All words and the query share their first ``start`` letters. Row d of the matrix holds the
        edits between d letters of the word and d - 1, d and d + 1 letters of the query; 2 stands
        for more than one.
        """
        found, size, words, lcps = [], len(query), self.words, self.lcps
        rows = [(2, 0, 1)] + [(1, 0, 1)] * start
        i = 0
        while i < len(words):
            word = words[i]
            if i:
                del rows[max(start, lcps[i]) + 1:]
            dead = 0
            while len(rows) <= len(word):
                d = len(rows)
                letter = word[d - 1]
                left, here, right = rows[-1]
                # The cells one row up and left, up, and left of each, within the band.
                first = min(left + (d - 2 < 0 or d - 2 >= size or query[d - 2] != letter), here + 1) if d - 1 <= size else 2
                second = min(here + (d - 1 >= size or query[d - 1] != letter), right + 1, first + 1) if d <= size else 2
                third = min(right + (d >= size or query[d] != letter), second + 1) if d + 1 <= size else 2
                if first > 1 and second > 1 and third > 1:
                    dead = d
                    break
                rows.append((first, second, third))
            if not dead:
                apart = size - len(word)
                if -1 <= apart <= 1 and rows[len(word)][apart + 1] == 1:
                    found.append(i)
                i += 1
                continue
            i += 1
            while i < len(words) and lcps[i] >= dead:
                i = self._next[i]
        return found


def _listed(words: DataFrame) -> DataFrame:
    """(list, back, length, word, n): the lists of each word, ``back`` if it stands reversed there.

    A list has a length, that of the shorter word of its pairs, and half as many letters that all its
    words start with. One edit parts the other letters of a pair, so one part is that long at least.
    """
    turned = words.select("n", F.explode(F.array(
        F.struct(F.lit(False).alias("back"), F.col("word").alias("word")),
        F.struct(F.lit(True).alias("back"), F.reverse("word").alias("word")))).alias("w"))
    sizes = turned.select("n", "w.back", "w.word", F.explode(F.expr(
        f"filter(array(length(w.word), length(w.word) - 1), l -> l >= {LEAST_LETTERS})")).alias("length"))
    start = F.expr("substr(word, 1, length DIV 2)")
    return sizes.select(F.concat_ws(":", F.col("back").cast("string"), F.col("length").cast("string"), start).alias("list"),
                        "back", "length", "word", "n")


def _dealt(listed: DataFrame) -> DataFrame:
    """``listed`` with ``slot`` and ``member``: words of a long list are members of one slot each and
    look through all slots."""
    long = staged(listed.groupBy("list").agg(F.count("*").alias("words")).where(F.col("words") > LIST).select(
        "list", F.expr(f"CAST(ceil(words / {LIST}) AS INT)").alias("slots")), "long-lists")
    rows = listed.join(long, "list", "left").withColumn("slots", F.coalesce("slots", F.lit(1)))
    rows = rows.withColumn("slot", F.explode(F.expr("sequence(0, slots - 1)")))
    return rows.select("list", "slot", F.expr("pmod(xxhash64(word), slots) = slot").alias("member"), "back", "length", "word", "n")


class _Slot:
    """The members of a slot of a list, and what each word finds among them."""

    def __init__(self) -> None:
        self._members: list[tuple[str, int]] = []
        self._list: SortedList | None = None

    def add(self, word: str, n: int) -> None:
        self._members.append((word, n))

    def search(self, word: str, back: bool, length: int) -> Iterator[tuple[str, int, int, str]]:
        """(word, near words, count of the most frequent one, that one), if there are any.

        A pair whose start is long enough is only counted there, not also by its end.
        """
        if self._list is None:
            self._list = SortedList([w for w, _ in self._members])
        count, best = 0, None
        for i in self._list.near(word, length // 2):
            other, n = self._members[i]
            if min(len(word), len(other)) != length or back and shared(word[::-1], other[::-1]) >= length // 2:
                continue
            count += 1
            ranked = -n, other[::-1] if back else other
            best = ranked if best is None else min(best, ranked)
        if best is not None:
            yield word[::-1] if back else word, count, -best[0], best[1]

    def members_found(self, back: bool, length: int) -> Iterator[tuple[str, int, int, str]]:
        if len(self._members) > 1:
            for word, _ in self._members:
                yield from self.search(word, back, length)


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, best_n, best) per word with near words in a slot. Rows come sorted by list and
    slot, members first, so the others pass by one at a time."""
    key, of, slot, found = None, (), _Slot(), []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("list", "slot", "member", "back", "length", "word", "n"))
        for name, at, member, back, length, word, n in zip(*columns, strict=True):
            if (name, at) != key:
                if key is not None:
                    found += slot.members_found(*of)
                key, of, slot = (name, at), (back, length), _Slot()
            if member:
                slot.add(word, n)
            else:
                found += slot.search(word, back, length)
        yield _result(found)
        found = []
    if key is not None:
        yield _result(list(slot.members_found(*of)))


def _result(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    columns = zip(*found, strict=True) if found else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["word", "n_near", "best_n", "best"])


def variants(words: DataFrame) -> DataFrame:
    """(word, n, form, form_n, n_near) of a stored vocabulary (word, n) of distinct Latin-1 words."""
    dealt = _dealt(_listed(words))
    scanned = dealt.repartition("list", "slot").sortWithinPartitions(
        "list", "slot", F.desc("member"), "word").mapInArrow(
        _scanned, "word string, n_near long, best_n long, best string")
    near = scanned.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("top"))
    is_form = -F.col("top.less") >= TIMES * F.col("n")
    return words.join(near, "word", "left").select(
        "word", "n", F.when(is_form, F.col("top.best")).alias("form"), F.when(is_form, -F.col("top.less")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"))


def with_roots(found: DataFrame) -> DataFrame:
    """``found`` and ``root``, the last of the forms that lead from a word; the word without one.

    Forms grow in frequency, so no chain comes back. Each round doubles the steps: a word's root so
    far is replaced by that one's.
    """
    roots = staged(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        nexts = roots.selectExpr("word AS root", "root AS further")
        moved = staged(roots.join(nexts, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        roots = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Words are maximal runs of letters up to U+00FF with A-Z in lower case, of 6 letters and 5
    occurrences at least; of runs whose checksum with the document's id is a multiple of 199 one
    letter is left out first. Near words differ by one inserted, deleted or replaced letter. The form
    of a word is its most frequent near word (ties: the first in code-point order) if that occurs 5
    times as often.

    Null and empty texts have no words; a null id counts as the empty one; a text or a run may have
    any length. Repeated rows count each; other columns are ignored. An empty table gives no rows.
    """
    words = staged(vocabulary(docs, id_col, text_col), "vocabulary")
    found = with_roots(staged(variants(words), "variants"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Spelling variants: words one code point apart, found by FM-index search schemes.

Search scheme for one error: halve the word. The error lies in one half, so the other half is matched exactly, and the
search goes on across the half with the error, on which it may once replace a code point or take in one more. A word is
searched twice, once from each side. Both searches run over an FM-index of the vocabulary with a delimiter around every
word: an interval of suffix ranks stands for all places where the pattern so far occurs, and one rank query per end
extends it by a code point. Of the two directions of the bidirectional index, the one that grows patterns to the left
indexes the words, the one that grows them to the right indexes the reversed words. As errors only replace or insert,
each word finds those of its own length and those that are one longer; shorter ones find it.

The index is cut into shards: words that share the exactly matched half meet in the same shard, whatever else it holds,
so each shard is searched only by its own words. Halves that very many words share are spread over several shards, each
with a part of the index and all of the half's searches. A shard is a group of about ``SHARD`` words, so its index has
bounded size whatever the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import stored

#: Maximal runs of letters after lower-casing A-Z; the minimum length drops short ones early.
RUN = "[a-zÀ-ÿ]{%d,}"
#: Rows of an index shard, and of a half up to which it lies in one shard.
SHARD = 8_192
#: Searches of one half that a shard answers, where its half is spread over several.
ASKED = 8 * SHARD
#: Distinct words that a task holds before it hands its counts on.
HELD = 400_000
#: Entries of an interval up to which its next code points are read off one by one.
NARROW = 24


def damaged(doc_id, text: str | None, least: int = 7, every: int = 31) -> Counter:
    """Counts of a text's words of at least ``least`` code points, after the deletions that the contract asks for."""
    lowered = (text or "").encode().lower().decode()
    found = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(re.findall(RUN % least, lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        found[run] += n
    return found


def vocabulary(docs: DataFrame, least: int = 7, occurrences: int = 2, every: int = 31, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): the distinct words of all texts with at least ``occurrences``; stored."""
    def count(batches):
        found = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.update(damaged(doc_id, text, least, every))
                if len(found) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])
                    found = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    ids = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    parts = docs.select(ids.alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return stored(parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences), "variant-words")


class Index:
    """FM-index of delimited words that grows patterns to the left, for many patterns at a time.

    ``codes`` is an array per word of symbols 1..sigma; 0 is the delimiter. The rank query of symbol c at i is a binary
    search in the sorted pairs (symbol, rank) of the Burrows-Wheeler transform, which gives C[c] + Occ(c, i) at once.
    """

    def __init__(self, words: np.ndarray):
        """``words``: distinct str."""
        self.words = words
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        self.alphabet = np.unique(points)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        n = len(points) + len(words) + 1
        self.text = np.zeros(n, dtype=np.int64)  # delimiter, word, delimiter, word, ..., delimiter
        starts = np.cumsum(lengths + 1) - lengths
        inside = np.ones(n, dtype=bool)
        inside[0] = False
        inside[starts + lengths] = False
        self.text[inside] = np.searchsorted(self.alphabet, points) + 1
        self.sigma = len(self.alphabet) + 1
        order = self._suffixes()
        self.before = self.text[order - 1]  # of the whole text's own suffix: the last delimiter
        self.n = n
        self.pairs = np.sort(self.before * (n + 1) + np.arange(n))
        word_at = np.full(n, -1, dtype=np.int64)  # word that starts behind a delimiter
        word_at[starts - 1] = np.arange(len(words))
        self.word_of = word_at[order]

    def _suffixes(self) -> np.ndarray:
        """Suffix array of the text taken as a circle, by doubling the sorted length."""
        n = len(self.text)
        rank, length = self.text.copy(), 1
        while True:
            second = np.roll(rank, -length)
            key = rank * (int(rank.max()) + 1) + second
            order = np.argsort(key)
            ranked = key[order]
            fresh = np.empty(n, dtype=np.int64)
            fresh[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
            rank, length = fresh, length * 2
            if int(rank.max()) == n - 1 or length >= n:
                return order

    def left(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of c + pattern for intervals [lo, hi) of patterns."""
        return np.searchsorted(self.pairs, c * (self.n + 1) + lo), np.searchsorted(self.pairs, c * (self.n + 1) + hi)

    def next(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, symbol) of every symbol but the delimiter that stands left of the pattern of an interval, each once."""
        size = hi - lo
        narrow = np.flatnonzero(size <= NARROW)
        reps = size[narrow]
        row = np.repeat(narrow, reps)
        at = np.repeat(lo[narrow] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
        found = [np.unique(row * self.sigma + self.before[at])]
        wide = np.flatnonzero(size > NARROW)
        if len(wide):
            row = np.repeat(wide, self.sigma - 1)
            c = np.tile(np.arange(1, self.sigma), len(wide))
            l, h = self.left(c, lo[row], hi[row])
            found.append((row * self.sigma + c)[l < h])
        codes = np.concatenate(found)
        row, c = codes // self.sigma, codes % self.sigma
        return row[c > 0], c[c > 0]

    def variants(self, queries: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers: words that come from a query by replacing or inserting one code point among its first
        ``whole`` code points (or before or behind them), all later ones being equal.
        """
        empty = np.zeros(0, dtype=np.int64)
        lengths = np.fromiter(map(len, queries), dtype=np.int64, count=len(queries))
        points = np.frombuffer("".join(queries).encode("utf-32-le"), dtype=np.uint32)
        at = np.searchsorted(self.alphabet, points).clip(max=len(self.alphabet) - 1)
        flat = np.where(self.alphabet[at] == points, at + 1, self.sigma)  # sigma: a symbol that the index lacks
        first = np.cumsum(lengths) - lengths
        q = np.arange(len(queries))
        at = lengths.copy()  # symbols still to be matched
        lo, hi = self.left(np.zeros(len(q), dtype=np.int64), np.zeros(len(q), dtype=np.int64), np.full(len(q), self.n))
        # the half without error
        done = []
        while len(q):
            ready = at == whole[q]
            done.append((q[ready], lo[ready], hi[ready]))
            q, at, lo, hi = q[~ready], at[~ready] - 1, lo[~ready], hi[~ready]
            lo, hi = self.left(flat[first[q] + at], lo, hi)
            live = lo < hi
            q, at, lo, hi = q[live], at[live], lo[live], hi[live]
        q, lo, hi = (np.concatenate(x) for x in zip(*done))
        at = whole[q]
        # no error so far: at each place go on without, or replace or insert here
        hits = []
        wrong = (empty,) * 4
        while len(q) or len(wrong[0]):
            wq, wat, wlo, whi = wrong
            end = wat == 0
            if end.any():
                lo0, hi0 = self.left(np.zeros(int(end.sum()), dtype=np.int64), wlo[end], whi[end])
                hits.append((wq[end], lo0, hi0))
                wq, wat, wlo, whi = wq[~end], wat[~end], wlo[~end], whi[~end]
            wlo, whi = self.left(flat[first[wq] + wat - 1], wlo, whi)
            wat = wat - 1
            row, c = self.next(lo, hi)
            nlo, nhi = self.left(c, lo[row], hi[row])
            own = at[row] > 0
            own[own] = flat[first[q[row[own]]] + at[row[own]] - 1] != c[own]  # replaced by another symbol
            parts = ((wq, wat, wlo, whi), (q[row], at[row], nlo, nhi),
                     (q[row[own]], at[row[own]] - 1, nlo[own], nhi[own]))
            wrong = tuple(np.concatenate(x) for x in zip(*parts))
            live = wrong[2] < wrong[3]
            wrong = tuple(x[live] for x in wrong)
            more = at > 0
            q, at, lo, hi = q[more], at[more] - 1, lo[more], hi[more]
            lo, hi = self.left(flat[first[q] + at], lo, hi)
            live = lo < hi
            q, at, lo, hi = q[live], at[live], lo[live], hi[live]
        if not hits:
            return empty, empty
        q, lo, hi = (np.concatenate(x) for x in zip(*hits))
        # the delimiter in front: each rank of these intervals is one whole word
        reps = np.maximum(hi - lo, 0)
        word = self.word_of[np.repeat(lo - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))]
        both = np.unique(np.repeat(q, reps) * len(self.words) + word)
        return both // len(self.words), both % len(self.words)


def _halves(words: DataFrame) -> DataFrame:
    """(word, n, side, half, length, asks): under which halves a word is indexed; ``asks`` where it is searched for too.

    A word of ``length`` code points has length div 2 in its first half. Words of that length and one more are indexed
    under it: with the first half at their start (side 0), or with the second half at their end (side 1).
    """
    size = F.length("word")
    places = []
    for shorter in (0, 1):
        length = size - shorter
        front = F.expr(f"(length(word) - {shorter}) div 2")
        for side, half in ((0, F.expr(f"left(word, (length(word) - {shorter}) div 2)")),
                           (1, F.right("word", length - front))):
            places.append(F.struct(F.lit(side).alias("side"), half.alias("half"), length.alias("length"), F.lit(shorter == 0).alias("asks")))
    return words.select("word", "n", F.explode(F.array(*places)).alias("p")).select("word", "n", "p.*")


def _sharded(words: DataFrame) -> DataFrame:
    """(side, shard, word, n, indexed, asks): every word in each shard whose index or searches it belongs to."""
    rows, key = _halves(words), ["side", "length", "half"]
    total = 4 * words.count()
    # halves with more rows than a shard: at most total / SHARD of them, as many as there are shards
    large = rows.groupBy(*key).agg(F.count("*").alias("size")).where(F.col("size") > SHARD).select(
        *key, F.ceil(F.col("size") / SHARD).cast("int").alias("parts"), F.ceil(F.col("size") / ASKED).cast("int").alias("blocks"))
    rows = rows.join(F.broadcast(large), key, "left")
    # such a half is cut into parts of its index times blocks of its searches, all of which meet
    at = lambda part, block, indexed, asks: F.struct(
        part.alias("part"), block.alias("block"), indexed.alias("indexed"), asks.alias("asks"))
    zero, yes, no = F.lit(0), F.lit(True), F.lit(False)
    own = [F.pmod(F.xxhash64("word", F.lit(k)), F.col(c)).cast("int") for k, c in enumerate(("parts", "blocks"))]
    index = F.transform(F.sequence(zero, F.col("blocks") - 1), lambda b: at(own[0], b, yes, no))
    asked = F.transform(F.sequence(zero, F.col("parts") - 1), lambda p: at(p, own[1], no, yes))
    cells = F.when(F.col("parts").isNull(), F.array(at(zero, zero, yes, F.col("asks")))).when(
        F.col("asks"), F.concat(index, asked)).otherwise(index)
    rows = rows.select("side", "length", "half", "word", "n", F.explode(cells).alias("c"))
    shard = F.pmod(F.xxhash64("length", "half", "c.part", "c.block"), F.lit(max(1, -(-total // (2 * SHARD)))))
    return rows.select("side", shard.alias("shard"), "word", "n", "c.indexed", "c.asks")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of ``words`` (word, n) that are one code point apart."""
    def search(shard: pa.Table) -> pa.Table:
        side, given = shard.column("side")[0].as_py(), shard.column("word").to_pylist()
        number = {w: i for i, w in enumerate(sorted(set(given)))}
        text = np.array(list(number), dtype=object)
        row = np.fromiter(map(number.__getitem__, given), dtype=np.int64, count=len(given))
        n = np.zeros(len(text), dtype=np.int64)
        n[row] = shard.column("n").to_numpy()
        indexed, asks = (np.unique(row[shard.column(c).to_numpy()]) for c in ("indexed", "asks"))
        a = b = np.zeros(0, dtype=np.int64)
        if len(indexed) and len(asks):
            turned = np.array([w[::-1] for w in text], dtype=object) if side == 0 else text
            sizes = np.fromiter(map(len, turned[asks]), dtype=np.int64, count=len(asks))
            # of the reversed word the second half comes first
            whole = sizes - sizes // 2 if side == 0 else sizes // 2
            q, w = Index(turned[indexed]).variants(turned[asks], whole)
            a, b = asks[q], indexed[w]
            a, b = np.concatenate([a, b]), np.concatenate([b, a])
        return pa.table({"word": pa.array(text[a], pa.string()), "n": n[a], "near": pa.array(text[b], pa.string()), "near_n": n[b]})

    return _sharded(words).groupBy("side", "shard").applyInArrow(search, "word string, n long, near string, near_n long").distinct()


def _rooted(links: DataFrame) -> DataFrame:
    """(word, root) over ``links`` (word, form): the last word that forms lead to. A form has more occurrences than its
    word, so there is no circle; each round doubles the steps taken.
    """
    steps = stored(links.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        moved = stored(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("moved")), "variant-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


def variants(docs: DataFrame, least: int = 7, occurrences: int = 2, ratio: int = 10, every: int = 31,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root): the words of all texts of ``docs`` with their variants.

    Words are runs of letters (A-Z, a-z, U+00C0 to U+00FF) of at least ``least`` code points with A-Z lower-cased, found
    at least ``occurrences`` times in all; of every ``every``-th run by its hash with the document's id one code point is
    taken out first. ``n_near`` counts the words one code point apart. ``form`` is the near word with the most occurrences
    (of ties the first in code-point order) if those are at least ``ratio`` times the word's, else null; ``root`` is
    where forms lead to, the word itself if it has none.

    Null and empty texts have no words; a null id reads ``null`` in the hash; repeated rows count again; an empty table
    gives no rows; other columns of ``docs`` are not read.
    """
    words = vocabulary(docs, least, occurrences, every, id_col, text_col)
    found = near_words(words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("top"))
    # a word has a bounded number of near words, so no group is hot
    near = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("top.n") >= ratio * F.col("n"), F.struct(F.col("top.form").alias("form"), (-F.col("top.n")).alias("n"))).alias("top")),
        "variant-near")
    near = near.select("word", "n", "n_near", F.col("top.form").alias("form"), F.col("top.n").alias("form_n"))
    roots = _rooted(near.where("form is not null").select("word", "form"))
    return near.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

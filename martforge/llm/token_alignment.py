"""Alignment of two tokenizers' tokens over a corpus, each distinct text once.

Texts are shuffled by their full text; each distinct one is tokenised and aligned once and stands for its ``copies``.
Where a token of A and a token of B end at the same byte, both sequences are cut; the tokens between two cuts are a group,
and every A token of a group is linked with every B token of it. An id pair counts the documents that hold it linked,
each distinct text with its number of copies. The measures of a text then join all of its documents.

A is a byte-level BPE in the ``tokenizers`` JSON format and reads a space before the text; B is a SentencePiece model
that adds the space itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import join_groups, stored

#: Characters whose classes (letter, number, space) all Unicode versions agree on; texts of these alone take the
#: faster of A's two encoders.
PLAIN = re.compile(r"[\x00-ɏ‐-‧€]*")
#: Bytes of text that are aligned together.
BATCH = 1 << 19
#: Pairs of one group up to which its occurrences are listed; beyond, its distinct ids are paired with their counts.
LISTED = 1 << 18
#: Most id pairs that are broadcast; the rarer ones beyond them join in a shuffle.
WIDE = 1_000_000


def _byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers with the bytes of their tokens; made from the files' contents."""

    def __init__(self, a_json: str, b_model: bytes):
        self.a = tokenizers.Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        chars = _byte_chars()
        vocab = self.a.get_vocab(with_added_tokens=False)
        self.n_a = self.a.get_vocab_size()
        self.bytes_a = [b""] * self.n_a
        for token, i in vocab.items():
            if all(c in chars for c in token):
                self.bytes_a[i] = bytes(chars[c] for c in token)
        self.fast = self._fast(json.loads(a_json))
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.n_b = self.b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(self.b.id_to_piece(list(range(self.n_b))))]
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        ids_a, ids_b = ([b"%d" % i for i in range(n)] for n in (self.n_a, self.n_b))
        # an id and what follows it: inside and at the end of a group's A tokens, of its B tokens
        self.shown = [x + end for ids, ends in ((ids_a, b",|"), (ids_b, b",;")) for end in (ends[:1], ends[1:]) for x in ids]

    def _fast(self, spec: dict) -> tiktoken.Encoding | None:
        """The same merges by rank; only where the ids above the single bytes are in the merges' order."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        if [vocab.get(x + y) for x, y in merges] != list(range(256, 256 + len(merges))):
            return None
        ranks = {self.bytes_a[i]: i for i in range(256 + len(merges))}
        return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        """A's ids of a space and the text."""
        if self.fast is not None and PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(" " + text)
        return self.a.encode(" " + text, add_special_tokens=False).ids

    def both(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """The ids of A and B; both empty for an empty text and where either's bytes differ from space and text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a, whole = self.ids(text), b" " + text.encode()
            same = text and b"".join(map(self.bytes_b.__getitem__, b)) == whole and b"".join(map(self.bytes_a.__getitem__, a)) == whole
            out.append((a, b) if same else ([], []))
        return out

    def align(self, texts: list[str]):
        """n_a, n_b, n_groups, n_links, groups_sha256 of each text, and its distinct linked pairs (a * n_b + b) with
        the number of their links, as (offsets, pairs, links) over all texts."""
        both = self.both(texts)
        n = len(both)
        n_a, n_b = (np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1))
        a, b = (np.array([i for x in both for i in x[k]], dtype=np.int64) for k in (0, 1))
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.zeros(len(a), dtype=bool)
        last_a[at < len(b)] = ends_b[at[at < len(b)]] == ends_a[at < len(b)]
        last_b = np.zeros(len(b), dtype=bool)
        last_b[at[last_a]] = True
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b  # groups, numbered over all texts
        groups = int(last_a.sum())
        in_a, in_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        from_a, from_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        doc_a = np.repeat(np.arange(n), n_a)
        n_groups = np.bincount(doc_a[last_a], minlength=n)
        doc_of = doc_a[last_a]  # text of each group
        linked = in_a * in_b
        n_links = np.zeros(n, dtype=np.int64)
        np.add.at(n_links, doc_of, linked)

        span = self.n_a * self.n_b
        wide = linked > LISTED
        reps = np.where(wide[of_a], 0, in_b[of_a]) if len(a) else np.zeros(0, dtype=np.int64)
        first = np.cumsum(reps) - reps
        mate = np.repeat(from_b[of_a] - first, reps) + np.arange(int(reps.sum())) if len(a) else np.zeros(0, dtype=np.int64)
        codes, links = np.unique(np.repeat(doc_a * span + a * self.n_b, reps) + b[mate], return_counts=True)
        for g in np.flatnonzero(wide):
            xs, nx = np.unique(a[from_a[g]:from_a[g] + in_a[g]], return_counts=True)
            ys, ny = np.unique(b[from_b[g]:from_b[g] + in_b[g]], return_counts=True)
            more = (doc_of[g] * span + xs[:, None] * self.n_b + ys).ravel()
            codes, where = np.unique(np.concatenate([codes, more]), return_inverse=True)
            links = np.bincount(where, np.concatenate([links, (nx[:, None] * ny).ravel()])).astype(np.int64)
        offsets = np.searchsorted(codes, np.arange(n + 1) * span)

        mixed = np.empty(len(a) + len(b), dtype=np.int64)  # A's tokens of a group, then B's
        if len(a):
            mixed[np.arange(len(a)) + from_b[of_a]] = a + self.n_a * last_a
            mixed[np.arange(len(b)) + (from_a + in_a)[of_b]] = 2 * self.n_a + b + self.n_b * last_b
        shown, cuts = mixed.tolist(), np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        shas = []
        for d in range(n):
            text = b"".join(map(self.shown.__getitem__, shown[cuts[d]:cuts[d + 1]]))[:-1]
            shas.append(hashlib.sha256(text).hexdigest() if text else "")
        return n_a, n_b, n_groups, n_links, shas, offsets, codes % span, links


@lru_cache(maxsize=2)
def _aligner(files: tuple[str, bytes]) -> Aligner:
    return Aligner(*files)


def _files(a_path: str, b_path: str) -> tuple[str, bytes]:
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return a.read(), b.read()


def aligned(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(tid, text_key, copies, n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) per row (text, copies); stored.

    ``pairs`` has each linked id pair of the text once, as a * (ids of B) + b; ``links`` has how often each is linked.
    """
    files = texts.sparkSession.sparkContext.broadcast(_files(a_path, b_path))  # two vocabularies
    arrays = [T.StructField(c, T.ArrayType(T.LongType())) for c in ("pairs", "links")]
    counts = [T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    schema = T.StructType([T.StructField("tid", T.LongType()), T.StructField("text_key", T.StringType()),
                           T.StructField("copies", T.LongType()), *counts, T.StructField("groups_sha256", T.StringType()), *arrays])

    def run(batches):
        both = _aligner(files.value)
        tid = TaskContext.get().partitionId() << 33

        def packed(at: int, keys, copies, texts):
            n_a, n_b, n_groups, n_links, shas, offsets, pairs, links = both.align(texts)
            offsets = pa.array(offsets, pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(at, at + len(texts))), keys, copies, *map(pa.array, (n_a, n_b, n_groups, n_links)),
                 pa.array(shas), *(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (pairs, links))], names=schema.names)

        for batch in batches:
            texts, start, held = batch.column(2).to_pylist(), 0, 0
            for i, text in enumerate(texts):
                held += len(text)
                if held >= BATCH or i + 1 == len(texts):
                    yield packed(tid, batch.column(0).slice(start, i + 1 - start), batch.column(1).slice(start, i + 1 - start),
                                 texts[start:i + 1])
                    tid, start, held = tid + i + 1 - start, i + 1, 0

    return stored(texts.select("text_key", "copies", "text").mapInArrow(run, schema), "aligned")


def _weighed(own: DataFrame, counts: DataFrame) -> DataFrame:
    """(tid, n_best, count_sum): the links of each text measured by their pairs' counts.

    ``counts`` has (pair, count, best). The most frequent pairs, ``WIDE`` at most, are broadcast; only links of rarer
    ones are shuffled, and such a pair has few documents.
    """
    by_size = counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).agg(F.count("*").alias("n"))
    sizes = sorted(((r.power, r.n) for r in by_size.collect()), reverse=True)  # a row per power of two
    least, held = 62, 0
    for power, n in sizes:
        if held + n > WIDE:
            break
        least, held = power, held + n
    listed = own.select("tid", F.explode(F.arrays_zip("pairs", "links")).alias("l")).select("tid", "l.pairs", "l.links")
    common = F.broadcast(counts.where(F.col("count") >= 1 << least).withColumnRenamed("pair", "pairs"))
    joined = listed.join(common, "pairs")
    if held < sum(n for _, n in sizes):
        rare = counts.where(F.col("count") < 1 << least).withColumnRenamed("pair", "pairs")
        joined = joined.unionByName(listed.join(common.select("pairs"), "pairs", "left_anti").join(rare, "pairs"))
    return joined.groupBy("tid").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"),
        F.sum(F.col("links") * F.col("count")).alias("count_sum"))


def pair_counts(own: DataFrame, n_b: int) -> DataFrame:
    """(pair, count, best) over the output of :func:`aligned`: how many documents hold the pair linked, and whether
    no pair of the same A id has more. Stored.
    """
    counts = stored(own.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count")),
                    "pair-counts")
    a = F.expr(f"pair div {n_b}").alias("a")
    highest = counts.groupBy(a).agg(F.max("count").alias("highest"))
    return stored(counts.select("*", a).join(highest, "a").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best")), "pair-best")


def measure(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``.

    ``n_best`` counts the links whose pair count is the highest of their A id, ties included; ``count_sum`` adds up the
    counts over all links. ``groups_sha256`` digests the groups as ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and texts
    that either tokenizer does not give back byte for byte, have no tokens: zeros and an empty digest. Repeated rows and
    null ids are documents like others; an empty table gives no rows; other columns of ``docs`` are not read.

    Equal texts are found by the full text; documents get their text's measures by its SHA-256.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    distinct = docs.select(text.alias("text")).groupBy("text").agg(F.count("*").alias("copies"))
    own = aligned(distinct.select("text", "copies", F.sha2("text", 256).alias("text_key")), a_path, b_path)
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    linked = stored(_weighed(own, pair_counts(own, n_b)), "text-links")
    texts = stored(own.drop("pairs", "links").join(linked, "tid", "left"), "text-measures")
    rows = docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("text_key"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return join_groups(rows, texts, ["text_key"], "copies").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")

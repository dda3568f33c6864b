"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

A piece (one match of the split pattern) is merged greedily: the adjacent pair with the lowest rank first, the
leftmost among equals. The leaves of a segment tree are the byte positions of the piece; a live leaf holds the
rank of the pair that starts there, an inner node the smallest (rank, position) below it, so the root is the next
merge. A merge changes three leaves - the merged pair, its left live neighbour and the swallowed position - and
each change climbs one path to the root.

Short pieces of one power-of-two width are merged side by side, one numpy column per piece; pieces beyond
``WIDE`` bytes go through the same tree one at a time. Equal pieces are merged once while they stay in the
worker's bounded table.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes up to which pieces are merged side by side.
WIDE = 64
#: Pieces that a worker remembers before it starts anew.
REMEMBERED = 200_000
#: Characters of documents that are split before their unknown pieces are merged together.
TOGETHER = 1_000_000
NONE = np.int64(1) << 40
#: Slots of the pair table that is asked first, and the multiplier that deals pairs to them.
SLOTS, MIX = 1 << 20, np.int64(0x1E3779B97F4A7C15)


class Codec:
    """Encoder and decoder of one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.vocab = {i: b for b, i in ranks.items()}
        self.text = {i: str(i) for i in self.vocab}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = rank
        self.pairs = pairs
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.fromiter(pairs.values(), dtype=np.int64, count=len(pairs))[order], NONE)
        self.slot_keys, self.slot_values = np.full(SLOTS, -1, dtype=np.int64), np.zeros(SLOTS, dtype=np.int64)
        slot = (self.keys[:-1] * MIX >> 40) & (SLOTS - 1)
        self.slot_keys[slot], self.slot_values[slot] = self.keys[:-1], self.values[:-1]
        self.known: dict[str, tuple[int, ...]] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 20) | b
        slot = (key * MIX >> 40) & (SLOTS - 1)
        found = self.slot_keys[slot]
        rank = np.where(found == key, self.slot_values[slot], NONE)
        more = np.flatnonzero((found != key) & (found >= 0))
        if more.size:  # the slot is another pair's: look the rest up in order
            rest = key.ravel()[more]
            at = np.searchsorted(self.keys, rest)
            rank.ravel()[more] = np.where(self.keys[at] == rest, self.values[at], NONE)
        return rank

    def _merge_many(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Ids of pieces of 2 to ``width`` bytes (a power of two): one segment tree per column."""
        n = len(pieces)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(n, width)
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        ids = np.ascontiguousarray(self.byte[raw].T)
        place = np.arange(width)[:, None]
        after = np.where(place + 1 < size, place + 1, -1)
        back = np.where(place < size, place - 1, -1)
        live = place < size
        tree = np.full((2 * width, n), NONE * width, dtype=np.int64)
        rank = np.where(after >= 0, self._rank(ids, np.roll(ids, -1, axis=0)), NONE)
        tree[width:] = np.where(rank < NONE, rank * width + place, NONE * width)
        for node in range(width - 1, 0, -1):
            tree[node] = np.minimum(tree[2 * node], tree[2 * node + 1])

        def put(pos: np.ndarray, col: np.ndarray, rank: np.ndarray) -> None:
            node = width + pos
            tree[node, col] = np.where(rank < NONE, rank * width + pos, NONE * width)
            node = node >> 1
            while node.size and node[0]:
                tree[node, col] = np.minimum(tree[2 * node, col], tree[2 * node + 1, col])
                node = node >> 1

        col = np.flatnonzero(tree[1] < NONE * width)
        while col.size:
            top = tree[1, col]
            i, merged = top % width, top // width
            j = after[i, col]
            k, p = after[j, col], back[i, col]
            ids[i, col], live[j, col], after[i, col] = merged, False, k
            has = k >= 0
            back[k[has], col[has]] = i[has]
            put(j, col, np.full(col.size, NONE))
            put(i, col, np.where(has, self._rank(merged, ids[k, col]), NONE))
            has = p >= 0
            put(p[has], col[has], self._rank(ids[p, col], merged)[has])
            col = col[tree[1, col] < NONE * width]
        flat, kept = ids.T, live.T
        ends = np.cumsum(kept.sum(axis=1))
        out = flat[kept].tolist()
        return [tuple(out[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one long piece: the same tree in plain lists, a merge costs a few paths of log2(bytes) nodes."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        none, find = int(NONE) * width, self.pairs.get
        ids = self.byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, back, live = [*range(1, n), -1], [*range(-1, n - 1)], bytearray(b"\1") * n
        tree = [none] * (2 * width)
        for i in range(n - 1):
            rank = find(ids[i] << 20 | ids[i + 1])
            if rank is not None:
                tree[width + i] = rank * width + i
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(pos: int, other: int, left: int) -> None:
            rank = find(ids[left] << 20 | ids[other]) if left >= 0 <= other else None
            node = width + pos
            tree[node] = none if rank is None else rank * width + pos
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        while tree[1] < none:
            merged, i = divmod(tree[1], width)
            j = after[i]
            k, p = after[j], back[i]
            ids[i], live[j], after[i] = merged, 0, k
            if k >= 0:
                back[k] = i
            put(j, -1, -1)
            put(i, k, i)
            if p >= 0:
                put(p, i, p)
        return tuple(t for t, on in zip(ids, live) if on)

    def learn(self, pieces: set[str]) -> None:
        """Merges the pieces that the table does not hold yet."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, ranks, groups = self.known, self.ranks, {}
        new = list(pieces - known.keys())
        for piece, data in zip(new, map(str.encode, new)):
            if data in ranks:
                known[piece] = (ranks[data],)
            elif len(data) > WIDE:
                known[piece] = self._merge_long(data)
            else:
                names, raw = groups.setdefault((len(data) - 1).bit_length(), ([], []))
                names.append(piece)
                raw.append(data)
        for bits, (names, raw) in groups.items():
            step = 1 << 17 - bits  # the trees of one call stay in the processor's cache
            for at in range(0, len(raw), step):
                known.update(zip(names[at:at + step], self._merge_many(raw[at:at + step], 1 << bits)))

    def encode_many(self, texts: list[str | None]) -> Iterator[list[int]]:
        """Token ids of each text; none for null or empty texts."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            held.append(self.split(text) if text else [])
            size += len(text or "")
            if size > TOGETHER:
                yield from self._flush(held)
                held, size = [], 0
        yield from self._flush(held)

    def _flush(self, held: list[list[str]]) -> Iterator[list[int]]:
        self.learn(set().union(*held))
        get = self.known.__getitem__
        for pieces in held:
            yield list(chain.from_iterable(map(get, pieces)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids))

    def spelled(self, ids: list[int]) -> str:
        return " ".join(map(self.text.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank table of a ``.tiktoken`` file: a base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


_CODECS: dict[str, Codec] = {}


def _codec(shared, key: str) -> Codec:
    """The worker's codec: built once per process and rank table."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(*shared.value)
        gc.freeze()  # the vocabulary never becomes garbage
        gc.set_threshold(200_000, 20, 20)
    return _CODECS[key]


def _share(df: DataFrame, ranks_path: str, pattern: str):
    """The rank table is read by the driver (a vocabulary of at most 2**20 entries, checked) and broadcast."""
    ranks = load_ranks(ranks_path)
    if len(ranks) >= 1 << 20:
        raise ValueError("vocabularies of 2**20 or more entries do not fit the pair keys")
    return df.sparkSession.sparkContext.broadcast((ranks, pattern)), f"{ranks_path}|{pattern}"


def _mapped(df: DataFrame, fields: list[T.StructField], work, take: str) -> DataFrame:
    """``df`` without column ``take``'s old outputs, plus ``fields`` computed by ``work`` from column ``take``."""
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([*(df.schema[c] for c in kept), *fields])

    def run(batches):
        for batch in batches:
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            values = batch.column(batch.schema.get_field_index(take)).to_pylist()
            yield pa.RecordBatch.from_arrays(arrays + work(values), names=[*kept, *(f.name for f in fields)])

    return df.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*kept, take]))).mapInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds array column ``out`` with the token ids of each whole text, as the published rank-merge encoders give them.

    No special tokens. Null and empty texts give an empty array. A column already named ``out`` is replaced; all
    other columns pass unchanged, repeated rows stay. Rows are independent: no shuffle, an empty table stays empty.
    """
    shared, key = _share(df, ranks_path, pattern)

    def work(texts):
        return [pa.array(list(_codec(shared, key).encode_many(texts)), type=pa.list_(pa.int32()))]

    return _mapped(df, [T.StructField(out, T.ArrayType(T.IntegerType()))], work, text_col)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds binary column ``out`` with the bytes of each id list; null lists give empty bytes.

    Ids outside the vocabulary raise an error. A column already named ``out`` is replaced.
    """
    shared, key = _share(df, ranks_path, pattern)

    def work(lists):
        codec = _codec(shared, key)
        return [pa.array([codec.decode(ids or []) for ids in lists], type=pa.binary())]

    return _mapped(df, [T.StructField(out, T.BinaryType())], work, ids_col)


def digests(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encodes, decodes the ids again and adds n_tokens, ids_sha256, decoded_sha256 (and ids if asked) in one pass.

    The digests are of the decimal ids joined by one space and of the decoded bytes. Null and empty texts have no
    tokens. Columns of these names are replaced.
    """
    shared, key = _share(df, ranks_path, pattern)

    def work(texts):
        codec = _codec(shared, key)
        count, spelled, decoded, ids = [], [], [], []
        for row in codec.encode_many(texts):
            count.append(len(row))
            spelled.append(hashlib.sha256(codec.spelled(row).encode()).hexdigest())
            decoded.append(hashlib.sha256(codec.decode(row)).hexdigest())
            if with_ids:
                ids.append(np.array(row, dtype=np.int32))
        return [pa.array(count, type=pa.int64()), pa.array(spelled), pa.array(decoded),
                *([pa.array(ids, type=pa.list_(pa.int32()))] if with_ids else [])]

    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    return _mapped(df, fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids, work, text_col)

"""Order MinHash fingerprints: sketches of occurrence-numbered k-mers that keep their text order.

Every k-mer of code points is numbered by its occurrence, so repeats are different elements. Each of ``sketches``
hash functions selects the ``tuple_size`` elements with the smallest values; the selected elements are put back into
text order and the tuple is hashed (Marcais et al., "Locality-sensitive hashing for the edit distance"). The share of
equal tuples of two fingerprints falls with the edit distance of the texts - moving a passage changes it, which plain
MinHash does not see.

Texts are hashed in numpy inside map tasks. To set a document beside its successor the rows are range-partitioned by
id once; only the first and last row of each partition are joined across partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import stored

#: A text that keeps half has a likeness of about an eighth, which 128 sketches tell from none.
K, SKETCHES, TUPLE = 6, 128, 2
#: Elements that are hashed by several functions at once: the block stays in the processor's cache.
BLOCK = 1 << 16
#: Rows of one output batch.
BATCH = 1000


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(hashlib.shake_256(b"order minhash").digest(8 * n), dtype=np.uint32)
    return raw[:n, None].copy(), raw[n:, None] | np.uint32(1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def elements(text: str, k: int = K) -> np.ndarray:
    """64-bit hashes of the occurrence-numbered k-mers of a text, in text order; a shorter text is one element."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return codes
    width = min(k, len(codes))
    n = len(codes) - width + 1
    h = codes[:n] + np.uint64(width)
    for t in range(1, width):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[t:t + n]
    h = _mix(h)
    bits = np.uint64(max(1, (n - 1).bit_length()))
    place = np.uint64((1 << int(bits)) - 1)
    order = np.sort((h & ~place) | np.arange(n, dtype=np.uint64))
    group = order >> bits
    repeated = np.concatenate(([False], group[1:] == group[:-1]))
    if repeated.any():
        at = np.arange(n)
        occurrence = at - np.maximum.accumulate(np.where(repeated, 0, at))
        number = np.empty(n, dtype=np.uint64)
        number[(order & place).astype(np.int64)] = occurrence
        h = h + number * np.uint64(0xD6E8FEB86659FD93)
    return _mix(h)


def sketch(text: str | None, k: int = K, sketches: int = SKETCHES, size: int = TUPLE) -> np.ndarray:
    """One 32-bit tuple hash per sketch; all zero for null and empty texts."""
    h = elements(text or "", k)
    n = len(h)
    if not n:
        return np.zeros(sketches, dtype=np.uint32)
    short = (h >> np.uint64(32)).astype(np.uint32)
    xors, factors = _constants(sketches)
    picked = np.empty((min(size, n), sketches), dtype=np.int64)
    step = max(1, BLOCK // n)
    for a in range(0, sketches, step):
        values = (short ^ xors[a:a + step]) * factors[a:a + step]
        rows = np.arange(len(values))
        for t in range(len(picked)):
            low = values.argmin(axis=1)
            picked[t, a:a + step] = low
            values[rows, low] = 0xFFFFFFFF
    picked.sort(axis=0)
    tuples = np.full(sketches, len(picked), dtype=np.uint64)
    for t in range(len(picked)):
        tuples = _mix(tuples * np.uint64(0xC2B2AE3D27D4EB4F) + h[picked[t]])
    return (tuples >> np.uint64(32)).astype(np.uint32)


def spelled(fingerprint: np.ndarray) -> str:
    """The upper half of every tuple hash in hex: two tuples that differ look alike once in 65,536 times, so likeness is
    measured on the whole hashes."""
    return (fingerprint >> np.uint32(16)).astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal tuples, 0 to 1."""
    return float((a == b).mean())


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """Adds the fingerprint (hex text) of each whole text; a column of that name is replaced, no shuffle."""
    kept = [c for c in docs.columns if c != out]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(out, T.StringType())])

    def run(batches):
        for batch in batches:
            own = [spelled(sketch(t)) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(own, type=pa.string())], names=[*kept, out])

    return docs.mapInArrow(run, schema)


def _row(text: str, own: np.ndarray, after: str, next_own: np.ndarray) -> dict:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    changed = sketch(edited)
    return {"n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(), "fingerprint": spelled(own),
            "edited_fingerprint": spelled(changed), "near_edited": likeness(own, changed), "near_next": likeness(own, next_own)}


_OUT = [("n_chars", T.LongType(), pa.int64()), ("edited_sha256", T.StringType(), pa.string()), ("fingerprint", T.StringType(), pa.string()),
        ("edited_fingerprint", T.StringType(), pa.string()), ("near_edited", T.DoubleType(), pa.float64()),
        ("near_next", T.DoubleType(), pa.float64())]


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text keeps the first half and takes as many code points as the rest has from the start of the next
    document's text. The next document follows in ascending id (null ids last, rows that repeat an id by text); the
    first follows the last, a single row follows itself. Null texts count as empty. An empty table gives no rows;
    other columns are not read.
    """
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_last(), F.xxhash64("text"), F.col("text")]
    placed = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    schema = T.StructType([T.StructField("role", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("id", kind),
                           *(T.StructField(n, t) for n, t, _ in _OUT), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, out, id_type = TaskContext.get().partitionId(), None, [], None

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r["role"] for r in out], type=pa.int32()), pa.array([part] * len(out), type=pa.int32()),
                 pa.array([r["id"] for r in out], type=id_type), *(pa.array([r.get(n) for r in out], type=t) for n, _, t in _OUT),
                 pa.array([r.get("text") for r in out], type=pa.string())], names=schema.fieldNames())
            out.clear()
            return batch

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = sketch(text)
                if held is None:
                    out.append({"role": 1, "id": key, "text": text})
                else:
                    out.append({"role": 0, "id": held[0], **_row(held[1], held[2], text, own)})
                held = (key, text, own)
                if len(out) >= BATCH:
                    yield flush()
        if held is not None:
            out.append({"role": 2, "id": held[0], "text": held[1]})
            yield flush()

    # hex text is stored as bytes, half as long
    hexes = ("edited_sha256", "fingerprint", "edited_fingerprint")
    done = stored(placed.mapInArrow(run, schema).withColumns({c: F.unhex(c) for c in hexes}), "order-minhash")
    done = done.withColumns({c: F.lower(F.hex(c)) for c in hexes})
    # one row per partition that has rows: its last document meets the first one of the next such partition
    parts = done.where("role = 1").select("part")
    around = Window.orderBy("part")
    follow = parts.select("part", F.coalesce(F.lead("part").over(around), F.first("part").over(around)).alias("next"))
    last = done.where("role = 2").select("part", "id", F.col("text").alias("text"))
    first = done.where("role = 1").select(F.col("part").alias("next"), F.col("text").alias("after"))
    ends = last.join(follow, "part").join(first, "next").select("id", "text", "after")
    names = [n for n, _, _ in _OUT]
    end_schema = T.StructType([T.StructField("id", kind), *(T.StructField(n, t) for n, t, _ in _OUT)])

    def close(batches):
        for batch in batches:
            found = [_row(a, sketch(a), b, sketch(b)) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[n] for r in found], type=t) for n, _, t in _OUT)],
                                             names=["id", *names])

    return done.where("role = 0").select("id", *names).union(ends.mapInArrow(close, end_schema)).withColumnRenamed("id", id_col)

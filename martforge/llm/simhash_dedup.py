"""SimHash near-duplicates with pigeonring candidate filtering.

Fingerprints: 64 bits from word shingles, a bit is set if more than half of the shingle hashes set it. Two
fingerprints link when they differ in at most ``max_bits`` bits (1 or 2).

Pigeonring (Qin and Xiao, "Pigeonring: A Principle for Faster Thresholded Similarity Search"): the fingerprint is
a ring of four 16-bit segments. Whenever the whole distance is at most t, some segment starts a chain whose first l
segments differ in at most l * t / 4 bits, for every l. With t <= 2 that segment is equal (l = 1 allows no bit) and
so is one of the next two (l = 3 allows one bit). So candidates share two whole segments: six equality keys of 32 bits. The chain check prunes the candidates, the
full distance decides.

Keys that many distinct fingerprints share are not paired up: there, every member joins the balls of radius one
around the values of its other 32 bits, and members that meet in a ball are linked through its smallest member.
Any two that meet are at most two bits apart, and any two at most two apart meet. That path is exact and linear.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import connected_components, stored

#: The two segments that make up each key, and the shifts of those left over.
KEYS = ((0, 1), (1, 2), (2, 3), (3, 0), (0, 2), (1, 3))
#: Distinct fingerprints of a key up to which they are compared pair by pair.
PAIRED = 48


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of one text; 0 for null and for texts without a word.

    Only A-Z is lower-cased; words are split at space, tab, LF, VT, FF and CR. A text with fewer words than a
    shingle is one shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) > shingle:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        count = len(words) - shingle + 1
    else:
        grams, count = [b" ".join(words)], 1
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(g, 42) for g in grams), dtype=np.uint64, count=count)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, fp) for every row of ``docs``, fp as signed long; no shuffle, other columns are not read."""
    schema = T.StructType([docs.schema[id_col], T.StructField("text_hash", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(fps, dtype=np.uint64).view(np.int64))],
                names=[id_col, "text_hash", "fp"])

    return docs.select(id_col, F.xxhash64(text_col).alias("text_hash"), text_col).mapInArrow(run, schema)


def _segment(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF))


def _keyed(distinct: DataFrame) -> DataFrame:
    """(fp, kind, key, rest): one row per fingerprint and pair of segments."""
    fp = F.col("fp")
    structs = []
    for n, (a, b) in enumerate(KEYS):
        c, d = sorted({0, 1, 2, 3} - {a, b})
        structs.append(F.struct(
            F.lit(n).alias("kind"),
            F.shiftleft(_segment(fp, a), 16).bitwiseOR(_segment(fp, b)).alias("key"),
            F.shiftleft(_segment(fp, c), 16).bitwiseOR(_segment(fp, d)).alias("rest")))
    return distinct.select("fp", F.explode(F.array(*structs)).alias("k")).select("fp", "k.*")


def _chained(x: Column, max_bits: int) -> Column:
    """Whether a chain of the ring of ``x`` (the differing bits) stays within the proportional budgets."""
    apart = [F.bit_count(_segment(x, k)) for k in range(4)]
    found = F.lit(False)
    for start in range(4):
        held, total = F.lit(True), F.lit(0)
        for length in range(1, 5):
            total = total + apart[(start + length - 1) % 4]
            held = held & (total <= F.lit(length * max_bits // 4))
        found = found | held
    return found


def links(distinct: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b) edges over distinct fingerprints ``fp``, with the same components as all pairs within ``max_bits``.

    Keys of at most ``PAIRED`` fingerprints give each of their pairs; larger ones give one edge per ball member.
    """
    if max_bits not in (1, 2):
        raise ValueError("keys of two whole segments out of four hold for 1 or 2 bits")
    keyed = _keyed(distinct)
    sizes = keyed.groupBy("kind", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(keyed.join(sizes, ["kind", "key"]), "simhash-keys")
    small = shared.where(F.col("size") <= PAIRED)
    left = small.select("kind", "key", F.col("fp").alias("a"))
    right = small.select("kind", "key", F.col("fp").alias("b"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (left.join(right, ["kind", "key"]).where(F.col("a") < F.col("b"))
             .where(_chained(x, max_bits)).where(F.bit_count(x) <= max_bits).select("a", "b"))
    large = shared.where(F.col("size") > PAIRED)
    bits = F.array(F.lit(0).cast("long"), *(F.lit(1 << b).cast("long") for b in range(32)))
    ball = large.select("kind", "key", "fp", "rest", F.explode(bits).alias("bit")).select(
        "kind", "key", "fp", F.col("rest").bitwiseXOR(F.col("bit")).alias("centre"))
    if max_bits == 2:  # members of a ball are at most two bits apart
        hubs = ball.groupBy("kind", "key", "centre").agg(F.min("fp").alias("a"))
    else:  # only the member in the middle is one bit from the others
        hubs = large.select("kind", "key", F.col("rest").alias("centre"), F.col("fp").alias("a"))
    met = ball.join(hubs, ["kind", "key", "centre"]).where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(met).distinct()


def _placed(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_hash, fp, root, low): root names the component, low is its smallest id."""
    rows = stored(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle, "id", "text"),
                  "simhash-fps")
    nodes = rows.groupBy("fp").agg(F.min("id").alias("low"))
    groups = connected_components(links(nodes.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    member = groups.join(nodes, "fp")
    lowest = member.groupBy("component").agg(F.min("low").alias("component_low"))
    linked = member.join(lowest, "component").select("fp", "component", "component_low")
    places = nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("root"), F.coalesce("component_low", "low").alias("low"))
    return rows.join(stored(places, "simhash-places"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits. ``component_id`` is the smallest id among the rows whose
    fingerprints are reachable over links, the row's own included. Null and empty texts have fingerprint zero and
    link like any other; repeated rows each come back; rows with a null id take part but never name a component
    unless all of it is null; an empty table gives no rows. Extra columns of ``docs`` are ignored.

    Exact copies meet in a map-side combined minimum per fingerprint, so a group of copies of any size is one
    node of the graph.
    """
    return _placed(docs, shingle, max_bits, id_col, text_col).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("low").alias("component_id"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: of each component the row with the smallest id.

    Of rows with that id the one with the smallest text hash stays, and one of those that repeat both. Null ids
    come after all others, so such a row stays only where a component has no id at all. An empty table stays empty.
    """
    placed = _placed(docs, shingle, max_bits, id_col, text_col)
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k"))
    kept = first.select(F.col("k.id").alias("__id"), F.col("k.text_hash").alias("__hash")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__hash"))
    equal = Window.partitionBy(id_col, F.xxhash64(text_col)).orderBy(F.lit(0))
    return (docs.join(kept, same, "left_semi").withColumn("__copy", F.row_number().over(equal))
            .where("__copy = 1").drop("__copy"))

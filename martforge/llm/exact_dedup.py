"""Exact deduplication by deterministic block naming.

After Karp, Miller and Rosenberg ("Rapid Identification of Repeated Patterns in Strings, Trees and Arrays"): every
normalised text is cut into blocks of a fixed number of bytes. All blocks are sorted, and equal blocks get one integer
name. Then the names of adjacent blocks are paired, the pairs are sorted and named the same way, and so on until each
text is one name. Equal texts have equal names on every level; different texts differ in a block or in their number of
blocks, so (level, name) is an identity without collisions: names are given by comparing the bytes themselves.

Sorting runs over range partitions of (hash, row), so that copies of one block, however many, are dealt over several
tasks. A hash only places blocks; inside a partition they are sorted and compared by their bytes. A block that lies on
both sides of a partition's end gets two names there; the keys next to the ends, two a partition, are named again
together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import join_groups, stored

#: Bytes of a block. Most documents are one block; a text of n blocks takes log2(n) more levels.
BLOCK = 2048
#: Bytes of text that a task hands back at a time.
BATCH = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _blocks(docs: DataFrame, block: int) -> DataFrame:
    """(rid, pos, of, id, sha, key): the blocks of each row (rid, id, text); id and sha stand at block 0 only."""
    schema = T.StructType([
        T.StructField("rid", T.LongType()), T.StructField("pos", T.IntegerType()), T.StructField("of", T.IntegerType()),
        docs.schema["id"], T.StructField("sha", T.StringType()), T.StructField("key", T.BinaryType())])

    def cut(batches):
        for batch in batches:
            id_type = batch.column(1).type
            ids, rows, held = batch.column(1), [], 0

            def packed():
                rid, pos, of, at, sha, key = zip(*rows)
                own = ids.take(pa.array(at, pa.int64())) if len(ids) else pa.nulls(len(at), id_type)
                return pa.RecordBatch.from_arrays(
                    [pa.array(rid, pa.int64()), pa.array(pos, pa.int32()), pa.array(of, pa.int32()), own,
                     pa.array(sha, pa.string()), pa.array(key, pa.binary())], names=schema.names)

            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for i, (rid, text) in enumerate(zip(batch.column(0).to_pylist(), texts)):
                text = (text or b"").lower()  # of bytes: A-Z only
                of = max(1, -(-len(text) // block))
                sha = hashlib.sha256(text).hexdigest()
                for pos in range(of):
                    key = text[pos * block:(pos + 1) * block]
                    rows.append((rid, pos, of, None if pos else i, None if pos else sha, key))
                    held += len(key)
                    if held >= BATCH:
                        yield packed()
                        rows, held = [], 0
            if rows:
                yield packed()

    return docs.select("rid", "id", "text").mapInArrow(cut, schema)


def named(parts: DataFrame, place: Column | None = None) -> DataFrame:
    """``parts`` (rid, pos, key binary, ...) with the key replaced by its ``name`` (long): equal keys, equal names.

    ``place`` is the number that deals keys out, a hash by default. Rows of one key may lie in many partitions; the
    result does not depend on how many keys share a place, but the keys of the first and last place of a partition
    are held in memory.
    """
    place = F.xxhash64("key") if place is None else place
    rows = (parts.withColumn("__h", place).repartitionByRange("__h", "rid", "pos")
            .sortWithinPartitions("__h", "key", "rid", "pos"))
    kept = [f for f in parts.schema.fields if f.name != "key"]
    schema = T.StructType([*kept, T.StructField("name", T.LongType()), T.StructField("edge", T.BinaryType())])
    h_at, key_at = rows.columns.index("__h"), rows.columns.index("key")
    kept_at = [rows.columns.index(f.name) for f in kept]

    def number(batches):
        base = TaskContext.get().partitionId() << 33
        at, last_h, last_key = -1, None, None
        first, ends = None, {}  # names by key of the place in hand, and of the first place
        types = None
        for batch in batches:
            if not batch.num_rows:
                continue
            hs, keys = batch.column(h_at).to_numpy(zero_copy_only=False), batch.column(key_at)
            types = [batch.column(k).type for k in kept_at]
            new = np.ones(len(hs), dtype=bool)
            new[0] = last_h is None or hs[0] != last_h or keys[0].as_py() != last_key
            if len(hs) > 1:
                other = pc.not_equal(keys.slice(1), keys.slice(0, len(hs) - 1)).to_numpy(zero_copy_only=False)
                new[1:] = other | (hs[1:] != hs[:-1])
            names = base + at + np.cumsum(new)
            moved = np.flatnonzero(np.concatenate([[last_h is not None and hs[0] != last_h], hs[1:] != hs[:-1]]))
            if len(moved):
                if first is None:  # the rest of the partition's first place
                    for i in np.flatnonzero(new[:moved[0]]):
                        ends[keys[int(i)].as_py()] = int(names[i])
                    first = ends
                ends, since = {}, moved[-1]
            else:
                since = 0
            for i in np.flatnonzero(new[since:]) + since:
                ends[keys[int(i)].as_py()] = int(names[i])
            at += int(new.sum())
            last_h, last_key = hs[-1], keys[len(hs) - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in kept_at), pa.array(names, pa.int64()), pa.nulls(len(hs), pa.binary())],
                names=schema.names)
        edges = {**(first or {}), **ends}
        if edges:
            yield pa.RecordBatch.from_arrays(
                [*(pa.nulls(len(edges), t) for t in types), pa.array(edges.values(), pa.int64()),
                 pa.array(edges.keys(), pa.binary())], names=schema.names)

    out = stored(rows.mapInArrow(number, schema), "block-names")
    edges = out.where("edge is not null").select("edge", "name")
    again = (edges.join(edges.groupBy("edge").agg(F.min("name").alias("__to")), "edge")
             .where("name <> __to").select("name", "__to"))
    # at most two rows a partition, but for keys of one hash
    return (out.where("edge is null").drop("edge").join(F.broadcast(again), "name", "left")
            .withColumn("name", F.coalesce("__to", "name")).drop("__to"))


def identities(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, text_sha256, level, name) per row of ``docs``; rows with equal normalised texts, and only those,
    share level and name. ``rid`` numbers the rows. Stored.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = named(_blocks(rows, block))
    heads = names.where("pos = 0").select("rid", "id", F.col("sha").alias("text_sha256"), "of", "name")
    found = heads.where("of = 1").select("rid", "id", "text_sha256", F.lit(0).alias("level"), "name")
    level, names, done = 0, names.select("rid", "pos", "of", "name").where("of > 1"), []
    while not names.isEmpty():
        level += 1
        even = F.col("pos") % 2 == 0
        pairs = names.groupBy("rid", F.shiftright("pos", 1).alias("pos")).agg(
            F.min(F.shiftright(F.col("of") + 1, 1)).alias("of"),
            F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b"))
        # one number if the row's last block has no neighbour, else two
        pairs = pairs.select("rid", "pos", "of", F.concat_ws(",", "a", "b").cast("binary").alias("key"))
        paired = named(pairs)
        done.append(paired.where("of = 1").select("rid", F.lit(level).alias("level"), "name"))
        names = paired.where("of > 1")
    if done:
        longer = done[0]
        for more in done[1:]:
            longer = longer.union(more)
        found = found.union(heads.where("of > 1").drop("of", "name").join(longer, "rid"))
    return stored(found, "block-identities")


def mark(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) per row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. Of equal texts the row with
    the largest id stays (``kept``), null ids come before all others, and of rows that repeat the id one stays.
    ``keep_id`` is the id of the row that stays, ``group_size`` counts the rows with an equal text (long),
    ``text_sha256`` is the lowercase hex SHA-256 of the normalised text in UTF-8. An empty table gives no rows;
    other columns of ``docs`` are not read.
    """
    rows = identities(docs, block, id_col, text_col)
    groups = rows.groupBy("level", "name").agg(
        F.max(F.struct("id", "rid")).alias("keep"), F.count("*").alias("group_size"))
    return join_groups(rows, groups, ["level", "name"], "group_size").select(
        F.col("id").alias(id_col), F.col("keep.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged: of equal texts the one with the largest id.

    Of rows that repeat that id the one with the smallest text in code-point order stays. Nulls and ties as in
    :func:`mark`.
    """
    kept = mark(docs, block, id_col, text_col).where("kept").select(
        F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")).distinct()
    sha = F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER), 256)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (sha == F.col("__sha"))
    repeated = Window.partitionBy(id_col, sha).orderBy(text_col)
    return (docs.join(kept, same, "left_semi").withColumn("__copy", F.row_number().over(repeated))
            .where("__copy = 1").drop("__copy"))

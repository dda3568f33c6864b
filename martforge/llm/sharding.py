"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to ``2 ** bits`` cells: metadata columns by the rank of their distinct whole values, size and
id by the rank of the row, so that cells hold about equal shares. The cells of a row are
turned into one index along the Hilbert curve, and the rows, sorted by that index, are cut into runs of equal length.
Neighbours on the curve are neighbours in all dimensions, so a file's value ranges are narrow in each of them and a
filter on any dimension skips most files. Equal texts share one place on the curve.

Only SQL functions are used. The curve's step table is built from the rule of the Gray code (Hamilton, "Compact
Hilbert Indices").
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.llm.common import join_groups, ranked, stored


def _steps(n: int) -> list[int]:
    """Step table of the n-dimensional curve: entry ``state * 2**n + cell bits`` holds ``next state * 2**n + digit``."""
    mask = (1 << n) - 1
    turn = lambda x, k: ((x << k % n) | (x >> (n - k % n))) & mask
    gray = [w ^ w >> 1 for w in range(1 << n)]
    ungray = {g: w for w, g in enumerate(gray)}
    ones = lambda w: (w ^ w + 1).bit_length() - 1  # noqa: E731  trailing set bits
    table = []
    for state in range(n << n):
        entry, axis = divmod(state, n)
        for bits in range(1 << n):
            digit = ungray[turn(bits ^ entry, n - (axis + 1) % n)]
            first = gray[2 * ((digit - 1) // 2)] if digit else 0
            axes = 0 if not digit else ones(digit if digit % 2 else digit - 1) % n
            after = (entry ^ turn(first, axis + 1)) * n + (axis + axes + 1) % n
            table.append(after << n | digit)
    return table


def hilbert(cells: list[Column], bits: int) -> Column:
    """Index of a cell along the curve; ``cells`` are integers below ``2 ** bits``."""
    n = len(cells)
    table = F.lit(_steps(n))
    parts = F.transform(F.sequence(F.lit(bits - 1), F.lit(0)), lambda i: sum(
        (F.call_function("shiftright", c, i).bitwiseAND(F.lit(1)) * (1 << j) for j, c in enumerate(cells)), F.lit(0)))
    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))

    def step(a: Column, cell: Column) -> Column:
        found = F.get(table, F.shiftleft(a["state"], n).bitwiseOR(cell))
        return F.struct(F.shiftleft(a["index"], n).bitwiseOR(found.bitwiseAND(F.lit((1 << n) - 1)).cast("long")).alias("index"),
                        F.shiftright(found, n).alias("state"))

    return F.aggregate(parts, start, step, lambda a: a["index"])


def _cells(rows: DataFrame, name: str, bits: int, distinct: bool) -> DataFrame:
    """(name, cell): the cell of every value of a column, by its rank among the distinct values or among the rows.

    Nulls come first. Ranked by distinct values, up to ``2 ** bits`` values have a cell each. Only distinct values with
    their counts are sorted, so that the rows of a frequent value never meet.
    """
    counted = rows.groupBy(name).agg((F.lit(1) if distinct else F.count("*")).cast("long").alias("n"))
    runs = stored(counted.orderBy(F.col(name).asc_nulls_first()).withColumn(
        "run", F.shiftright(F.monotonically_increasing_id(), 33).cast("int")), "shard-ranks")
    sizes = runs.groupBy("run").agg(F.sum("n").alias("size"))  # a row per partition of the sort
    in_front = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    total = sizes.agg(F.sum("size")).first()[0] or 1
    inside = Window.partitionBy("run").orderBy(F.col(name).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    offsets = sizes.select("run", F.coalesce(F.sum("size").over(in_front), zero).alias("offset"))
    ranks = (runs.withColumn("rank", F.coalesce(F.sum("n").over(inside), zero)).join(F.broadcast(offsets), "run")
             .withColumn("rank", F.col("rank") + F.col("offset")))
    return ranks.select(name, F.expr(f"int(rank * {1 << bits} div {total})").alias("cell"))


def assign(docs: DataFrame, shards: int = 8, bits: int = 6, id_col: str = "doc_id", text_col: str = "text",
           by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs``; law ``rows``.

    The dimensions are the columns ``by``, the size and the id. Shards hold runs of the curve whose
    row counts differ by at most one; ``slot`` is the place in the shard. A text has one place on the curve, that of its
    row with the smallest id (nulls last), so that the rows of equal texts follow each other: in one shard, or in
    consecutive ones where a cut falls into the group. Inside a group rows follow their own curve index and id; ties beyond
    that are equal rows. The columns ``by`` are ranked by distinct value. Nulls take the lowest cell, null and empty texts have size 1 and CRC-32 zero; an empty table gives no rows; ``grown_shard`` is null.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    dims = [*(F.col(c) for c in by), F.octet_length(text), F.col(id_col)]
    rows = stored(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"), F.xxhash64(text).alias("hash"), *(d.alias(f"d{i}") for i, d in enumerate(dims))), "shard-rows")
    total = max(rows.count(), 1)
    placed = rows
    for i in range(len(dims)):
        cells = _cells(rows, f"d{i}", bits, i < len(by)).select(F.col(f"d{i}").alias("__d"), F.col("cell").alias(f"c{i}"))
        placed = placed.join(cells, F.col(f"d{i}").eqNullSafe(F.col("__d"))).drop("__d")
    placed = placed.withColumn("curve", hilbert([F.col(f"c{i}") for i in range(len(dims))], bits))
    same = ["hash", "crc", "size"]
    placed = stored(placed.select("id", *same, "curve"), "shard-curve")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "curve"))
    groups = placed.groupBy(*same).agg(first.alias("first"), F.count("*").alias("copies"))
    groups = stored(groups.select(*same, F.col("first.curve").alias("group_curve"), "copies"), "shard-groups")
    placed = join_groups(placed, groups, same, "copies")
    at = ranked(placed, [F.col(c) for c in ("group_curve", *same, "curve", "id")], "rank")
    shard = F.expr(f"int(rank * {shards} div {total})")
    start = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return at.withColumn("shard", shard).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("rows").alias("law"), "shard",
        (F.col("rank") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes ``docs`` as Parquet in one folder per shard, in curve order, many files a shard if it is large.

    ``shards`` comes from :func:`assign` over the same rows with unique ids.
    """
    placed = docs.join(shards.select(id_col, "shard", "slot"), id_col)
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))

"""Helpers shared by the corpus operators: shared-storage tables, connected components, exact global ranks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.session import checkpoint_dir, write_and_read

#: A word is a maximal run of characters other than space, tab, line feed, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the cluster's shared checkpoint folder and read back.

    Cuts the lineage: a lost executor costs no recomputation of what came before, and branches that
    read the result twice see the same rows.
    """
    return write_and_read(df, f"{checkpoint_dir(df.sparkSession).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}")


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected ``edges`` (a, b); component is the smallest node.

    Alternates the large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
    Beyond") until the edges form stars around smallest nodes. Each step is a map-side combined minimum and an
    equality join, so a hub's neighbours are never gathered into one row; every round is written to shared storage.
    Self-loops and edges with a null end are ignored. An empty input gives no rows.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, "edges")
    while not _stars(pairs):
        both = pairs.select("u", "v").union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: every larger neighbour of u hangs under the smallest node around u
        big = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: u and its smaller neighbours hang under the smallest of them
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        small = (big.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u <> v").distinct())
        pairs = stored(small, "edges")
    tops = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(tops)


def _stars(pairs: DataFrame) -> bool:
    """Whether each u of (u, v) has one v, and no v is a u."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        pairs.select("v", F.lit(0), F.lit(1)))
    other = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")
    return other.agg(F.count("*")).first()[0] == 0


def ranked(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``df`` with its exact 0-based rank under ``order`` as long column ``rank``, without a one-task step.

    The rows are sorted across range partitions and written with their place inside their partition; the sizes of
    the partitions (one row each) give the offsets. ``order`` should leave no ties between rows that differ.
    """
    rows = stored(df.orderBy(*order).withColumn("__m", F.monotonically_increasing_id()), "ranked")
    run = F.shiftright("__m", 33).cast("int")
    sizes = rows.groupBy(run.alias("__run")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__run", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (rows.withColumn("__run", run).join(F.broadcast(offsets), "__run")
            .withColumn(rank, F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("__before"))
            .drop("__run", "__before", "__m"))


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str, least: int = 500) -> DataFrame:
    """Inner join of ``rows`` with the one row of their group, without a hot group in one task.

    ``size`` names the column of ``groups`` with the group's number of rows. Groups of more than a ten-thousandth of all
    rows (and more than ``least``) are at most 10,000, so these are broadcast; the others meet their few rows in a
    shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    limit = max(least, total // 10_000)
    large = F.broadcast(groups.where(F.col(size) > limit))
    few = rows.join(large.select(*on), on, "left_anti").join(groups.where(F.col(size) <= limit), on)
    return rows.join(large, on).unionByName(few)

"""Top-1-per-key, ranking and ordering operators.

``row_number() = 1`` over a partition is planned by Catalyst with a
``WindowGroupLimit`` before the shuffle, so each map task keeps only its
local winner per key; the exchange carries at most one row per key and task.
Every ordering ends in a unique key so the winner is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _order(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in cols]


def top1(df: DataFrame, keys, order, rank_fn=F.row_number) -> DataFrame:
    """Keep the first row(s) per ``keys`` under ``order``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn("_rn", rank_fn().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest(df: DataFrame, key, ts: str, tie=()) -> DataFrame:
    """Newest row per key (ts desc, NULL ts last), ties broken by ``tie``."""
    return top1(df, key, [F.col(ts).desc_nulls_last(), *_order(tie)])


def latest_priority(df: DataFrame, key, first_if: Column, ts: str, tie=()) -> DataFrame:
    """Rows matching ``first_if`` win, then newest."""
    return top1(df, key, [F.when(first_if, 0).otherwise(1).asc(), F.col(ts).desc_nulls_last(),
                          *_order(tie)])


def first_row(df: DataFrame, key, ts: str, tie=()) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (PARTITION BY key ORDER BY ts) = 1."""
    return top1(df, key, [F.col(ts).asc_nulls_last(), *_order(tie)])


def closest(df: DataFrame, key, matched: Column, delta: Column, tie=()) -> DataFrame:
    """Prefer matched rows, then the smallest |delta|."""
    return top1(df, key, [F.when(matched, 0).otherwise(1).asc(), F.abs(delta).asc_nulls_last(),
                          *_order(tie)])


def limit_by(df: DataFrame, key, order) -> DataFrame:
    """``ORDER BY ... LIMIT 1 BY key``."""
    return top1(df, key, order)


def keep_latest(df: DataFrame, key, ver: str) -> DataFrame:
    """Keep the newest version per key, **ties kept** (rank, not row_number).

    Keys are compared null-safely (window partitions group NULLs together).
    """
    return top1(df, key, [F.col(ver).desc_nulls_last()], rank_fn=F.rank)


def keep_first(df: DataFrame, id_col: str, seq: str) -> DataFrame:
    """First arrival per id; rows without an id are keyed by their JSON."""
    key = F.coalesce(F.nullif(F.col(id_col).cast("string"), F.lit("")),
                     F.to_json(F.struct(*[F.col(c) for c in df.columns if c != seq])))
    return top1(df.withColumn("_kf_key", key), "_kf_key", [seq]).drop("_kf_key")


def second_newest(df: DataFrame, ts: str, keys=(), **aggs: Column) -> DataFrame:
    """O2: per key, the newest and the second-newest value of ``ts``
    (``ORDER BY ts DESC LIMIT 1 OFFSET 1``: duplicates count, so two equal
    newest stamps make the second one equal to the first), and further aggregates.

    One scan finds both: every task keeps its two newest rows of a key, and only those are shuffled
    (``WindowGroupLimit``). ``aggs`` are a partial and final aggregate over the same column; the two results are
    stacked and folded, not joined. Without keys one row comes back, also for no rows.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("_ts").desc_nulls_last())
    top = df.select(*keys, F.col(ts).alias("_ts")).withColumn("_rn", F.row_number().over(w)).where("_rn <= 2")
    fold = [F.max(F.when(F.col("_rn") == n, F.col("_ts"))).alias(c) for n, c in ((1, "newest"), (2, "previous"))]
    if not aggs:
        return top.groupBy(*keys).agg(*fold)
    counted = df.groupBy(*keys).agg(*(c.alias(n) for n, c in aggs.items()))
    both = top.unionByName(counted, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*fold, *(F.max(n).alias(n) for n in aggs))


def order(df: DataFrame, *keys) -> DataFrame:
    """O1: final multi-key sort; pass ``F.col(x).desc_nulls_last()`` etc."""
    return df.orderBy(*_order(keys))


def newest(df: DataFrame, value: str, ts: str) -> DataFrame:
    """O3: the value at the newest timestamp (one row)."""
    return df.agg(F.max_by(F.col(value), F.col(ts)).alias(value))

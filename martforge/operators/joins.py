"""Join operators.

Broadcast policy: only sides whose size is bounded by construction (literal
dimensions, one-row aggregates) get an explicit ``broadcast`` hint. Sides
derived from data are left to the planner: the static estimate and, at run
time, AQE's measured size decide between broadcast and sort-merge, so a side
that grows with the data falls back to a shuffle join instead of blowing up
executor memory.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.time import OPEN_END
from martforge.session import stored


def left_agg(df: DataFrame, side: DataFrame, key: str, **aggs: Column) -> DataFrame:
    """Left join to a side pre-aggregated to one row per key (no fan-out).

    The aggregate runs partial-then-final, so the side is reduced before it is
    shuffled; the join then matches at most one row per fact.
    """
    agg = side.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(agg, on=key, how="left")


def left(df: DataFrame, side: DataFrame, on, how: str = "left") -> DataFrame:
    """Plain equi join; fan-out is kept."""
    return df.join(side, on=on, how=how)


def inner(df: DataFrame, side: DataFrame, on) -> DataFrame:
    """Inner equi join."""
    return df.join(side, on=on, how="inner")


def left_dim(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
             prefix: str, cols, bounded: bool = False) -> DataFrame:
    """Small dimension join under an alias prefix (the same dimension can
    be joined twice under two prefixes). ``bounded=True`` marks a dimension of
    fixed size, which is broadcast explicitly."""
    side = dim.select(F.col(dim_key).alias(f"{prefix}{dim_key}"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    if bounded:
        side = F.broadcast(side)
    return df.join(side, df[left_key] == side[f"{prefix}{dim_key}"], "left").drop(f"{prefix}{dim_key}")


def versioned_dim(df: DataFrame, dim: DataFrame, left_key: str, dim_key: str, at: Column,
                  cols, bounded: bool = False) -> DataFrame:
    """Pick the dimension version valid at ``at``: equi join on the key plus
    ``valid_from <= at < valid_to``. Equality first, so never a nested loop.
    ``bounded`` broadcasts the dimension; ask for it only where its size is known."""
    side = dim.select(F.col(dim_key).alias("_vd_key"), F.col("valid_from").alias("_vd_from"),
                      F.col("valid_to").alias("_vd_to"), *cols)
    if bounded:
        side = F.broadcast(side)
    cond = (df[left_key] == side["_vd_key"]) & (side["_vd_from"] <= at) & (at < side["_vd_to"])
    return df.join(side, cond, "left").drop("_vd_key", "_vd_from", "_vd_to")


def left_cast(df: DataFrame, side: DataFrame, keys, type_: str = "string") -> DataFrame:
    """Composite-key join with both sides' keys cast to one type."""
    lk = {k: F.col(k).cast(type_) for k in keys}
    return df.withColumns(lk).join(side.withColumns(lk), on=list(keys), how="left")


def same_within(a: Column, b: Column) -> Column:
    """Equality that is only compared, among the rows that another key has brought together: in a join, rows are not
    dealt by it, so sides that lie by that other key stay where they are. NULL is equal to nothing."""
    return (a <= b) & (a >= b)


def left_strict(df: DataFrame, side: DataFrame, keys, within: str | None = None) -> DataFrame:
    """Multi-column left join where NULL never matches (plain ``==``, not
    ``<=>``): a fact with a NULL second key gets no side columns, on purpose.

    ``within`` names a key that has few rows per value on both sides: rows meet by it alone and the other keys are
    compared, so sides that already lie by it are not dealt again."""
    renamed = side.withColumnsRenamed({k: f"_ls_{k}" for k in keys})
    equal = lambda k: same_within if within not in (None, k) else lambda a, b: a == b
    cond = reduce(lambda a, b: a & b, [equal(k)(df[k], renamed[f"_ls_{k}"]) for k in keys])
    return df.join(renamed, cond, "left").drop(*[f"_ls_{k}" for k in keys])


def membership(df: DataFrame, side: DataFrame, key: str, out: str, yes=1, no=0,
               side_key: str | None = None) -> DataFrame:
    """Flag whether ``key`` occurs in ``side``.

    Written as a left-semi/anti pair over a distinct key set would scan twice;
    a left join to the DISTINCT keys keeps one pass and cannot fan out.
    """
    sk = side_key or key
    keys = side.select(F.col(sk).alias("_m_key")).where(F.col("_m_key").isNotNull()).distinct()
    joined = df.join(keys, df[key] == keys["_m_key"], "left")
    return joined.withColumn(out, F.when(F.col("_m_key").isNotNull(), F.lit(yes))
                             .otherwise(F.lit(no))).drop("_m_key")


def semi(df: DataFrame, side: DataFrame, key: str, side_key: str | None = None) -> DataFrame:
    """``key IN (subquery)`` as a left-semi pre-filter."""
    sk = side_key or key
    return df.join(side.select(F.col(sk).alias("_s_key")), df[key] == F.col("_s_key"), "left_semi")


def anti_pair(df: DataFrame, side: DataFrame, c1: str, c2: str, exempt=()) -> DataFrame:
    """Drop rows whose (c1, c2) pair occurs in ``side``; rows whose c2 is
    in ``exempt`` are never dropped. Equality semantics: a NULL in the pair
    never matches, so such rows are kept (documented deviation from NOT IN)."""
    s = side.select(F.col(c1).alias("_a1"), F.col(c2).alias("_a2"))
    if exempt:
        s = s.where(~F.col("_a2").isin(list(exempt)))
    cond = (df[c1] == s["_a1"]) & (df[c2] == s["_a2"])
    return df.join(s, cond, "left_anti")


#: Added to a day's number since 1970, so that all dates of the calendar are non-negative ...
DAY_ZERO = 1 << 20
#: ... and lie in this many levels of nodes, each node being four of the level below.
LEVELS = 11


def _node(level: int):
    return lambda at: F.struct(F.lit(level).alias("level"), at.alias("at"))


def _nodes(first: Column, last: Column) -> Column:
    """The fewest nodes (level, at) that together are the days ``[first, last]``: at most six a level."""
    def quarter(day: Column, level: int) -> Column:
        return F.shiftright(day, 2 * level)

    none = F.array().cast("array<int>")
    run = lambda lo, hi: F.when(lo < hi, F.sequence(lo, hi - 1)).otherwise(none)
    found = []
    for level in range(LEVELS):
        lo, hi = quarter(first + (1 << 2 * level) - 1, level), quarter(last + 1, level)
        if level < LEVELS - 1:  # whole quadruples go to the next level
            up, down = F.shiftleft(quarter(lo + 3, 1), 2), F.shiftleft(quarter(hi, 1), 2)
            at = F.when(up > down, run(lo, hi)).otherwise(F.concat(run(lo, up), run(down, hi)))
        else:
            at = run(lo, hi)
        found.append(F.transform(at, _node(level)))
    return F.concat(*found)


def interval_winner(df: DataFrame, periods: DataFrame, key: str, at: str,
                    start: str = "start_date", end: str = "end_date", name: str = "name",
                    out: str = "period_name") -> DataFrame:
    """The one period whose [start, end] holds the date ``at`` (open end =
    2099-12-31); winner = latest start, then smallest name; NULL when none.

    A sweep over starts and ends cut to nodes of time, so that it needs no order within a key: the calendar is a tree
    whose nodes are 1, 4, 16, ... days. A period is the sum of a few nodes, and each node of a key keeps the winner of
    the periods that cover all of it (a map-side combined minimum; stored). A date lies in one node per level; the best of
    their winners is its own, of the levels that some period has. Work is linear in periods and in facts, no fact meets a
    period and no period another one's ends; a key with very many of either is spread over its nodes. The answer joins
    back on (key, date): at most one row, no fan-out.
    """
    day = lambda c: F.unix_date(c) + DAY_ZERO
    p = (periods.select(F.col(key).alias("_k"), F.col(start).cast("date").alias("s"),
                        F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END)).alias("e"), F.col(name).alias("n"))
         .where(F.col("_k").isNotNull() & F.col("s").isNotNull()))
    own = F.struct((-F.unix_date("s")).alias("o"), F.col("n").alias("n"))
    won = stored(p.select("_k", own.alias("w"), F.explode(_nodes(day("s"), day("e"))).alias("d"))
                 .groupBy("_k", F.col("d.level").alias("level"), F.col("d.at").alias("at")).agg(F.min("w").alias("w")), "period-nodes")
    levels = sorted(r["level"] for r in won.select("level").distinct().collect())  # LEVELS at most
    dates = (df.select(F.col(key).alias("_k"), F.col(at).cast("date").alias("_t"))
             .where(F.col("_k").isNotNull() & F.col("_t").isNotNull()).distinct())
    up = F.array(*(F.struct(F.lit(k).alias("level"), F.shiftright(day("_t"), 2 * k).alias("at")) for k in levels or [0]))
    hit = (dates.select("_k", "_t", F.explode(up).alias("d")).select("_k", "_t", "d.level", "d.at")
           .join(won, ["_k", "level", "at"]).groupBy("_k", "_t").agg(F.min("w").alias("w"))
           .select(F.col("_k").alias("_iw_k"), F.col("_t").alias("_iw_t"), F.col("w.n").alias(out)))
    j = df.join(hit, (df[key] == F.col("_iw_k")) & (F.col(at).cast("date") == F.col("_iw_t")), "left")
    return j.drop("_iw_k", "_iw_t")


def overlap(df: DataFrame, side: DataFrame, key: str, at: str, lo: str, hi: str,
            how: str = "inner") -> DataFrame:
    """Equi join on ``key`` plus ``side.lo <= df.at <= side.hi``."""
    s = side.withColumnRenamed(key, "_ov_key")
    cond = (df[key] == s["_ov_key"]) & (df[at] >= s[lo]) & (df[at] <= s[hi])
    return df.join(s, cond, how).drop("_ov_key")


def event_window(df: DataFrame, events: DataFrame, key: str, start: str, end: str,
                 ev_time: str, pad_minutes: int = 5) -> DataFrame:
    """Events joined to the study by key and classed as inside
    ``[start - pad, end]`` (column ``in_window``) or outside."""
    e = events.withColumnRenamed(key, "_ew_key")
    j = df.join(e, df[key] == e["_ew_key"], "inner").drop("_ew_key")
    lo = F.col(start) - F.make_interval(mins=F.lit(pad_minutes))
    return j.withColumn("in_window", (F.col(ev_time) >= lo) & (F.col(ev_time) <= F.col(end)))


def cross_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row relation to every row (broadcast, no shuffle)."""
    return df.crossJoin(F.broadcast(one_row))


def bridge(df: DataFrame, br: DataFrame, key: str, out_key: str) -> DataFrame:
    """Enrich through a DISTINCT bridge (key -> out_key)."""
    b = br.select(key, out_key).where(F.col(key).isNotNull()).distinct()
    return df.join(b, on=key, how="left")


def new_ids(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Ids in ``df`` not in ``existing`` (left anti, distinct)."""
    return df.select(key).where(F.col(key).isNotNull()).distinct().join(
        existing.select(key), on=key, how="left_anti")


def resolve(df: DataFrame, lookup: DataFrame, id_col: str, lk_id: str, lk_name: str,
            out: str) -> DataFrame:
    """Id -> name through a lookup (the smallest name if an id repeats), else the id as text."""
    lk = lookup.groupBy(F.col(lk_id).alias("_r_id")).agg(F.min(lk_name).alias("_r_name"))
    j = df.join(lk, df[id_col] == lk["_r_id"], "left")
    return j.withColumn(out, F.coalesce(F.col("_r_name"), F.col(id_col).cast("string"))).drop("_r_id", "_r_name")


def nearest_by_time(left: DataFrame, right: DataFrame, keys, lt: str, rt: str, rid: str,
                    bucket_seconds: int = 3600, carried=()) -> DataFrame:
    """Nearest right row in time within the same keys, for each distinct
    (keys, lt, carried) of ``left``; ties go to the smaller ``rid``.

    Returns (keys, carried, lt, near_id, near_time, near_dist_s) with NULLs when the
    key has no right rows. Times are compared, and near_time is given, in whole
    seconds. Never forms all pairs within a key:

    * rows are cut into time buckets of ``bucket_seconds``; inside a
      (key, bucket) two running windows (ascending and descending) give the
      last right row at or before and the first right row at or after each
      left time;
    * a per-(key, bucket) summary (last/first right row of the bucket) with a
      window over buckets carries the neighbour from earlier/later buckets.
      That window has one row per touched bucket, so its size depends on the
      time span, not on how many rows a hot key holds.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    from martforge.functions.time import epoch_micros, secs
    b = lambda c: F.floor(epoch_micros(c) / F.lit(bucket_seconds * 1_000_000))
    whole = lambda df, c: F.date_trunc("second", F.col(c)).cast(df.schema[c].dataType).alias("_t")
    L = left.select(*keys, *carried, F.col(lt).alias("_lt"), whole(left, lt)).where(F.col("_t").isNotNull()).distinct() \
        .withColumn("_b", b("_t"))
    R = right.select(*keys, whole(right, rt), F.col(rid).alias("_rid")).where(F.col("_t").isNotNull()) \
        .withColumn("_b", b("_t"))
    last_key = F.struct(F.col("_t").alias("t"), (-F.col("_rid")).alias("nr"))   # max -> latest, then min id
    first_key = F.struct(F.col("_t").alias("t"), F.col("_rid").alias("r"))     # min -> earliest, then min id

    # bucket summaries and carries from neighbouring buckets
    summ = R.groupBy(*keys, "_b").agg(F.max(last_key).alias("_bl"), F.min(first_key).alias("_bf"))
    touched = L.select(*keys, "_b").distinct().join(summ, [*keys, "_b"], "full")
    wb = Window.partitionBy(*keys).orderBy("_b")
    carry = touched.select(
        *keys, "_b",
        F.max("_bl").over(wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_c"),
        F.min("_bf").over(wb.rowsBetween(1, Window.unboundedFollowing)).alias("_next_c"))

    # inside the bucket: right rows sort before left rows at the same time
    u = (L.select(*keys, *carried, "_b", "_t", F.lit(None).cast("long").alias("_rid"), F.lit(1).alias("_is_l"), "_lt")
         .unionByName(R.select(*keys, *(F.lit(None).cast(left.schema[c].dataType).alias(c) for c in carried), "_b", "_t",
                               "_rid", F.lit(0).alias("_is_l"), F.lit(None).cast(left.schema[lt].dataType).alias("_lt"))))
    w_up = Window.partitionBy(*keys, "_b").orderBy("_t", "_is_l").rowsBetween(Window.unboundedPreceding, 0)
    w_dn = Window.partitionBy(*keys, "_b").orderBy(F.col("_t").desc(), "_is_l").rowsBetween(Window.unboundedPreceding, 0)
    is_r = F.col("_is_l") == 0
    inb = u.select(*keys, *carried, "_b", "_t", "_is_l", "_lt",
                   F.max(F.when(is_r, last_key)).over(w_up).alias("_prev_i"),
                   F.min(F.when(is_r, first_key)).over(w_dn).alias("_next_i")).where(F.col("_is_l") == 1)
    j = inb.join(carry, [*keys, "_b"], "left")
    prev = F.coalesce(F.col("_prev_i"), F.col("_prev_c"))
    nxt = F.coalesce(F.col("_next_i"), F.col("_next_c"))
    cand_p = F.when(prev.isNotNull(), F.struct(secs(prev["t"], F.col("_t")).alias("d"),
                                               (-prev["nr"]).alias("id"), prev["t"].alias("t")))
    cand_n = F.when(nxt.isNotNull(), F.struct(secs(F.col("_t"), nxt["t"]).alias("d"),
                                              nxt["r"].alias("id"), nxt["t"].alias("t")))
    best = F.least(cand_p, cand_n)
    return j.select(*keys, *carried, F.col("_lt").alias(lt), best["id"].alias("near_id"), best["t"].alias("near_time"),
                    best["d"].alias("near_dist_s"))

"""Mixing sources to target weights by min-cost flow.

Documents are summed by membership pattern (the set of sources they belong to). Each pattern offers its size once per
repetition, at a cost that rises with every repetition, and every source asks for its quota: a small transport
problem whose min-cost flow says how many words each pattern gives. Patterns and sources that share nothing are
solved apart, one connected part per task. Then documents are drawn in a seeded order until their pattern's words
are met: all of them for every full repetition, a seeded share for the rest. A document that does not fit what is left
is passed over, not the ones behind it.
"""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from martforge.llm.common import WORD, connected_components, ranked, stored

#: Runs of the seeded order whose sizes are summed before documents are ordered inside them.
RUNS = 1024


def flow(supply: list[tuple[list[int], int]], demand: list[int], repeats: int = 3) -> list[dict[int, int]]:
    """Words that each pattern gives to each source: a min-cost maximum flow.

    ``supply`` lists (sources, size) per pattern, ``demand`` the words each source asks for. The t-th repetition of a
    pattern costs t - 1 a word, so repetition is spread before it is deepened. Successive cheapest paths; work grows
    with the patterns of one connected part, not with documents.
    """
    n = len(supply) + len(demand) + 2
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []

    def arc(a: int, b: int, size: int, price: int) -> None:
        for x, y, r, c in ((a, b, size, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(r)
            cost.append(c)

    source, sink = n - 2, n - 1
    given = []
    for p, (sources, size) in enumerate(supply):
        for t in range(repeats):
            arc(source, p, size, t)
        for s in sources:
            given.append((p, s, len(to)))
            arc(p, len(supply) + s, size * repeats, 0)
    for s, asked in enumerate(demand):
        arc(len(supply) + s, sink, asked, 0)
    while True:
        far, via, queue, queued = [None] * n, [-1] * n, deque([source]), [False] * n
        far[source] = 0
        while queue:
            a = queue.popleft()
            queued[a] = False
            for e in graph[a]:
                if room[e] and (far[to[e]] is None or far[a] + cost[e] < far[to[e]]):
                    far[to[e]], via[to[e]] = far[a] + cost[e], e
                    if not queued[to[e]]:
                        queued[to[e]] = True
                        queue.append(to[e])
        if far[sink] is None:
            break
        path, b = [], sink
        while b != source:
            path.append(via[b])
            b = to[via[b] ^ 1]
        moved = min(room[e] for e in path)
        for e in path:
            room[e] -= moved
            room[e ^ 1] += moved
    out: list[dict[int, int]] = [{} for _ in supply]
    for p, s, e in given:
        if room[e ^ 1]:
            out[p][s] = room[e ^ 1]
    return out


def targets(sources: DataFrame, total: float, weights: tuple[float, ...], repeats: int) -> DataFrame:
    """(source, source_size, target): shares of ``total`` words by weight, none above ``repeats`` times its source's size.

    Sources in code-point order (null last) weigh ``weights``, repeating. The excess of capped sources is shared anew by
    weight until none is above; each round is one aggregate that brings two sums to the driver.
    """
    rows = ranked(sources, [F.col("source").asc_nulls_last()], "rank").withColumn(
        "weight", F.element_at(F.lit([float(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    rows = stored(rows.withColumn("cap", F.col("source_size").cast("double") * repeats), "mix-sources")
    weight = rows.agg(F.sum("weight")).first()[0]
    level = 0.0
    if weight:
        level = total / weight
        while True:
            capped = F.col("weight") * level >= F.col("cap")
            full, open_ = rows.agg(F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~capped, F.col("weight")))).first()
            if not open_ or (total - full) / open_ <= level * (1 + 1e-12):
                break
            level = (total - full) / open_
    return rows.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * level).alias("target"))


def _mixed(docs: DataFrame, weights: tuple[float, ...], repeats: int, seed: int, id_col: str, text_col: str,
           source_col: str) -> DataFrame:
    """(id, text_hash, size, source_size, target, taken) for every row; see :func:`mix`."""
    many = isinstance(docs.schema[source_col].dataType, T.ArrayType)
    member = F.array_sort(F.array_distinct(source_col)) if many else F.array(F.col(source_col).cast("string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored(docs.select(
        F.col(id_col).alias("id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), member.alias("pattern"),
        F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text)).alias("h")).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    patterns = stored(rows.groupBy("pattern").agg(F.sum("size").alias("size")), "mix-patterns")
    by_source = patterns.select(F.explode("pattern").alias("source"), "size").groupBy("source").agg(F.sum("size").alias("source_size"))
    total = patterns.where(F.size("pattern") > 0).agg(F.sum("size").cast("double")).first()[0] or 0.0
    asked = stored(targets(by_source, total, weights, repeats), "mix-targets")
    given = _arcs(patterns, asked, many).groupBy("part").applyInPandas(_solver(repeats), "pattern array<string>, words long")
    plan = patterns.join(given, "pattern").select(
        "pattern", F.when(F.col("size") > 0, F.expr("words div size")).otherwise(0).alias("full"),
        F.when(F.col("size") > 0, F.expr("words % size")).otherwise(0).alias("rest"))
    plan = stored(plan, "mix-plan")
    # seeded order: sums of runs first, then the documents of a run
    run = F.shiftrightunsigned("h", 64 - (RUNS.bit_length() - 1)).cast("int")
    drawn = rows.where("size > 0").withColumn("run", run)
    sums = drawn.groupBy("pattern", "run").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("pattern").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sums.select("pattern", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
                    .join(plan.select("pattern", "rest"), "pattern"), "mix-starts")
    inside = Window.partitionBy("pattern", "run").orderBy("h", "id", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = (drawn.withColumn("end", F.sum("size").over(inside)).join(starts, ["pattern", "run"])
             .withColumn("end", F.col("end") + F.col("before"))
             .select("row", "pattern", "run", "size", "h", "id", "rest", (F.col("end") <= F.col("rest")).alias("drawn"), "end"))
    reach = stored(reach, "mix-reach")
    # what is left: passes over the documents that still fit, in the seeded order, until none does; each pass draws one
    # per open pattern at least. Then the nearest if it comes nearer than none
    reached = stored(reach.groupBy("pattern", "rest").agg(
        F.coalesce(F.max(F.when(F.col("drawn"), F.col("end"))), F.lit(0)).alias("reached")), "mix-reached")
    gaps = reached.select("pattern", (F.col("rest") - F.col("reached")).alias("gap"))
    left, extra = reach.where(~F.col("drawn")).select("row", "pattern", "run", "size", "h", "id"), None
    while True:
        spread = starts.select("pattern", "run").join(gaps.where("gap > 0"), "pattern")  # dealt by run: a source may hold most rows
        apart = left if extra is None else left.join(extra.select("row"), "row", "left_anti")
        fit = apart.join(spread, ["pattern", "run"]).where("size <= gap")
        sums = fit.groupBy("pattern", "run", "gap").agg(F.sum("size").alias("n"))
        met = stored(sums.select("pattern", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "gap")
                     .where("before < gap"), "mix-open")
        if met.isEmpty():
            break
        more = (fit.drop("gap").join(met, ["pattern", "run"]).withColumn("end", F.sum("size").over(inside) + F.col("before"))
                .where("end <= gap").select("row", "pattern", "size"))
        extra = stored(more if extra is None else extra.union(more), "mix-extra")
        filled = extra.groupBy("pattern").agg(F.sum("size").alias("filled"))
        gaps = reached.join(filled, "pattern", "left").select(
            "pattern", (F.col("rest") - F.col("reached") - F.coalesce("filled", F.lit(0))).alias("gap"))
    off = F.abs(F.col("gap") - F.col("size"))
    best = apart.join(spread, ["pattern", "run"]).where(off < F.col("gap")).groupBy("pattern").agg(
        F.min(F.struct(off.alias("off"), "h", "row", "size")).alias("b"))
    nearest = best.select("b.row", "pattern", "b.size")
    extra = nearest if extra is None else extra.union(nearest)
    extra = extra.select("row", F.lit(True).alias("extra"))
    chosen = reach.where("drawn").select("row", F.lit(True).alias("extra")).union(extra)
    first = asked.select(F.array("source").alias("key"), "source_size", "target")
    key = F.when(F.size("pattern") > 0, F.slice("pattern", 1, 1)).otherwise(F.col("pattern"))
    return (rows.join(chosen, "row", "left").join(plan, "pattern", "left").withColumn("key", key)
            .join(first, "key", "left").select(
                F.col("id").alias(id_col), "text_hash", "size", F.coalesce("source_size", F.lit(0)).alias("source_size"),
                F.coalesce("target", F.lit(0.0)).alias("target"),
                (F.col("size") * (F.coalesce("full", F.lit(0)) + F.coalesce("extra", F.lit(False)).cast("int"))).cast("long").alias("taken")))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), repeats: int = 3, seed: int = 11, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) for every row of ``docs``.

    ``source_col`` is one source or an array of them; with an array, source_size and target are those of the row's first
    source in code-point order. Size counts the words of the text (null and empty: 0, never taken). No row is taken more
    than ``repeats`` times and every row is taken whole, so a source (without overlaps) ends within half of its smallest document
    not drawn of its target. A null source is a source of its own, an empty array belongs to none and is not taken. Reruns agree: the seeded
    order depends on id, text hash and seed alone; an empty table gives no rows.
    """
    return _mixed(docs, weights, repeats, seed, id_col, text_col, source_col).drop("text_hash")


def mixed_rows(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), repeats: int = 3, seed: int = 11,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mix` takes it, all columns unchanged.

    Rows that are not taken, rows without a word among them, go.
    """
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    plan = _mixed(docs, weights, repeats, seed, id_col, text_col, source_col).where("taken > 0")
    times = plan.select(F.col(id_col).alias("__i"), F.col("text_hash").alias("__h"), F.expr("int(taken div size)").alias("__times"))
    nth = Window.partitionBy("__i", "__h").orderBy(F.col("__times").desc())
    times = times.withColumn("__nth", F.row_number().over(nth))
    same = Window.partitionBy(id_col, "__text").orderBy(F.lit(0))
    rows = docs.withColumn("__text", text_hash).withColumn("__row", F.row_number().over(same))
    on = F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__h")) & (F.col("__row") == F.col("__nth"))
    return rows.join(times, on).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(
        *(F.col(f"`{c}`") for c in docs.columns))


def _arcs(patterns: DataFrame, asked: DataFrame, many: bool) -> DataFrame:
    """(part, pattern, size, source, target): one row per pattern and source; part names the connected part."""
    arcs = patterns.select("pattern", "size", F.explode("pattern").alias("source")).withColumn("key", F.array("source"))
    arcs = arcs.join(asked.select(F.array("source").alias("key"), "target"), "key")
    if not many:  # one source a pattern: nothing is shared
        return arcs.withColumn("part", F.to_json(F.struct("pattern")))
    name = F.to_json(F.struct("pattern"))
    edges = arcs.select(name.alias("a"), F.concat(F.lit("s:"), F.to_json(F.struct("source"))).alias("b"))
    parts = connected_components(edges).select(F.col("node").alias("__n"), F.col("component").alias("part"))
    return arcs.join(parts, name == F.col("__n")).drop("__n")


def _solver(repeats: int):
    def solve(part: pd.DataFrame) -> pd.DataFrame:
        names = part["source"].map(lambda s: (s is None, s or ""))
        sources = {s: i for i, s in enumerate(sorted(set(names)))}
        asked = [0] * len(sources)
        rows: dict[tuple, tuple[list[int], int]] = {}
        for pattern, size, name, target in zip(part["pattern"], part["size"], names, part["target"]):
            asked[sources[name]] = round(target)
            rows.setdefault(tuple(pattern), ([], int(size)))[0].append(sources[name])
        keys = sorted(rows, key=lambda k: [(s is None, s or "") for s in k])
        got = flow([rows[k] for k in keys], asked, repeats)
        return pd.DataFrame({"pattern": [list(k) for k in keys], "words": [sum(g.values()) for g in got]})

    return solve

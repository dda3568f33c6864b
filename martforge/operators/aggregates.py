"""Aggregate builders and grouped operators.

Builders return Columns for one ``groupBy().agg(...)`` pass, so twenty
conditional counters still cost one hash aggregate with map-side partial
aggregation (no per-counter scan).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions._util import col as _c


def n_distinct(*cols) -> Column:
    """A1: distinct count (NULLs not counted)."""
    return F.count_distinct(*[_c(c) for c in cols])


def n_rows() -> Column:
    """A2: row count."""
    return F.count(F.lit(1))


def sum_tariff(coef) -> Column:
    """A3: exact sum of a decimal coefficient."""
    return F.sum(_c(coef).cast("decimal(18,2)"))


def value_at_first(x, t, tie=None) -> Column:
    """A5: argMin(x, t): ``x`` at the earliest ``t``, rows with NULL ``x`` skipped.

    ``min_by`` alone would return NULL when the earliest row's value is NULL,
    so the ordering is nulled for those rows (min_by ignores NULL orderings).
    A unique ``tie`` column makes equal times deterministic.
    """
    xc = _c(x)
    order = F.struct(_c(t), _c(tie)) if tie is not None else _c(t)
    return F.min_by(xc, F.when(xc.isNotNull() & _c(t).isNotNull(), order))


def any_det(x) -> Column:
    """Deterministic stand-in for ``any(x)``: the minimum."""
    return F.min(_c(x))


def count_where(pred: Column) -> Column:
    """countIf."""
    return F.count_if(pred)


def min_where(x, pred: Column) -> Column:
    """minIf; NULL when no row qualifies."""
    return F.min(F.when(pred, _c(x)))


def max_where(x, pred: Column) -> Column:
    """maxIf; NULL when no row qualifies."""
    return F.max(F.when(pred, _c(x)))


def join_distinct(x, sep: str = ", ") -> Column:
    """Distinct non-NULL values, sorted, joined."""
    return F.array_join(F.array_sort(F.collect_set(_c(x))), sep)


def chain(t, s, sep: str = " -> ") -> Column:
    """A10: values of ``s`` ordered by ``t`` (then ``s``), joined by ``sep``."""
    ordered = F.array_sort(F.collect_list(F.struct(_c(t).alias("t"), _c(s).alias("s"))))
    return F.array_join(F.transform(ordered, lambda e: e["s"]), sep)


def chains(df: DataFrame, keys, t: str, s: str, out: str = "chain", sep: str = " -> ", **aggs) -> DataFrame:
    """A10 for keys of any size: per key the chain of :func:`chain`, with further figures.

    The rows are dealt out by ranges of (keys, t, s), so a hot key lies in several tasks, each with a stretch of its
    time. Every stretch becomes one text, and a key's stretches are joined in their order. ``aggs`` maps a name to
    (aggregate of the rows, aggregate of the stretches' column of that name).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    spread = df.repartitionByRange(*keys, t, s).withColumn("_run", F.spark_partition_id())
    parts = spread.groupBy(*keys, "_run").agg(
        F.when(F.count(s) > 0, chain(t, s, sep)).alias("_text"), *(a.alias(n) for n, (a, _) in aggs.items()))
    own = F.array_sort(F.collect_list(F.struct("_run", "_text")))  # a stretch without any status has no text
    return parts.groupBy(*keys).agg(
        F.array_join(F.transform(own, lambda x: x["_text"]), sep).alias(out), *(a(n).alias(n) for n, (_, a) in aggs.items()))


def collect_periods(start, end, name) -> Column:
    """Validity periods as an array of (start, end, name)."""
    return F.collect_list(F.struct(_c(start).alias("s"), _c(end).alias("e"), _c(name).alias("n")))


def any_true(pred: Column) -> Column:
    """Boolean OR across the group."""
    return F.bool_or(pred)


def min_json(c, *keys: str) -> Column:
    """Minimum JSON text, absent values counted as ''."""
    from martforge.functions.text import json_text
    return F.min(json_text(c, *keys))


def union_lists(c, sep: str = ",", out_sep: str = ", ") -> Column:
    """Union of comma lists across the group: trimmed, distinct, sorted,
    joined; NULL when nothing is left."""
    parts = F.flatten(F.collect_set(F.split(F.coalesce(_c(c), F.lit("")), sep)))
    items = F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda p: F.trim(p)),
                                                   lambda p: p != "")))
    return F.nullif(F.array_join(items, out_sep), F.lit(""))


def n_distinct_null(*cols) -> Column:
    """Distinct tuples of any column types; NULL counts as a value."""
    return F.count_distinct(F.struct(*[_c(c) for c in cols]))


def group_hidden(df: DataFrame, keys, hidden, **aggs: Column) -> DataFrame:
    """Group by ``keys + hidden`` and drop ``hidden``: visible duplicates
    are intended (one row per hidden id)."""
    hidden = [hidden] if isinstance(hidden, str) else list(hidden)
    return df.groupBy(*keys, *hidden).agg(*[c.alias(n) for n, c in aggs.items()]).drop(*hidden)


def group_all(df: DataFrame, keys, **aggs: Column) -> DataFrame:
    """GROUP BY ALL: every non-aggregate output column is a key."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def dup_audit(df: DataFrame, keys, by=None) -> DataFrame:
    """Rows, distinct key tuples (NULL counted via A24) and the difference."""
    by = list(by or [])
    g = df.groupBy(*by) if by else df.groupBy()
    return (g.agg(F.count(F.lit(1)).alias("total_rows"),
                  n_distinct_null(*keys).alias("distinct_keys"))
            .withColumn("duplicates", F.col("total_rows") - F.col("distinct_keys")))


def health(df: DataFrame, critical: Column, **counts: Column) -> DataFrame:
    """One-row roll-up: any critical problem (1/0), number of items, and
    one conditional count per keyword (``name=condition``)."""
    return df.agg(F.max(F.when(critical, 1).otherwise(0)).alias("has_critical"),
                  F.count(F.lit(1)).alias("n_items"),
                  *[F.sum(F.when(c, 1).otherwise(0)).alias(n) for n, c in counts.items()])

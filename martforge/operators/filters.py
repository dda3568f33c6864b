"""Projection and filter operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.functions._util import col as _c
from martforge.functions.time import parse_ts, secs
from martforge.session import stored


def non_empty(df: DataFrame, *keys: str) -> DataFrame:
    """keys neither NULL nor '' (text keys); numeric keys just not NULL."""
    types = dict(df.dtypes)
    cond = F.lit(True)
    for k in keys:
        c = F.col(k)
        cond = cond & (c.isNotNull() & (c != "") if types.get(k) == "string" else c.isNotNull())
    return df.where(cond)


def where_code(df: DataFrame, column: str, op: str, value) -> DataFrame:
    """code comparison; NULL codes drop, as in SQL."""
    c = F.col(column)
    ops = {"=": c == value, "!=": c != value, "<": c < value, "<=": c <= value,
           ">": c > value, ">=": c >= value}
    return df.where(ops[op])


def name_match(df: DataFrame, column: str, substr: str, names=()) -> DataFrame:
    """``col LIKE '%substr%' OR col IN (names)``."""
    c = F.col(column)
    cond = c.contains(substr)
    if names:
        cond = cond | c.isin(list(names))
    return df.where(cond)


def having_not_in(agg: DataFrame, column: str, values) -> DataFrame:
    """drop aggregate rows whose alias is in ``values`` (HAVING NOT IN)."""
    return agg.where(~F.col(column).isin(list(values)))


def in_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """inclusive numeric range."""
    return df.where(F.col(column).between(lo, hi))


def valid_duration(df: DataFrame, start: str, end: str, max_seconds: int) -> DataFrame:
    """end >= start and the span is at most ``max_seconds``."""
    s = secs(start, end)
    return df.where((s >= 0) & (s <= max_seconds))


def drop_flagged(df: DataFrame, flag: str, action: str, flagged_action: str, flag_value=1) -> DataFrame:
    """two rules, both must hold: ``flag`` is not ``flag_value`` (a NULL flag goes too),
    and ``action`` is NULL or not ``flagged_action``."""
    a = F.col(action)
    return df.where((F.col(flag) != flag_value) & (a.isNull() | (a != flagged_action)))


def parsed_ok(df: DataFrame, column, since=None) -> DataFrame:
    """F8: keep rows whose text parses as a timestamp (and is >= ``since``)."""
    p = parse_ts(column)
    cond = p.isNotNull()
    if since is not None:
        cond = cond & (p >= F.lit(since).cast("timestamp_ntz"))
    return df.where(cond)


def non_blank(df: DataFrame, column: str) -> DataFrame:
    """trimmed text not empty (NULL drops too)."""
    return df.where(F.trim(F.col(column)) != "")


def drop_null_key(df: DataFrame, key: str, metric_name: str = "dropped_null_key"):
    """drop NULL keys; the number dropped is observed during the write,
    not counted by an extra job. Returns (df, observation)."""
    from pyspark.sql import Observation
    obs = Observation(metric_name)
    df = df.observe(obs, F.count_if(F.col(key).isNull()).alias("dropped"))
    return df.where(F.col(key).isNotNull()), obs


def stamp(df: DataFrame, **constants) -> DataFrame:
    """constant columns (e.g. one run stamp shared by all rows)."""
    return df.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()})


def stamp_batch_max(df: DataFrame, column: str, out: str) -> DataFrame:
    """F16: batch-wide max of ``column`` on every row.

    A global window would pull every row into one task; instead the batch is stored in the shared folder, so that it
    is computed once, and a one-row aggregate over the stored column is broadcast back.
    """
    batch = stored(df, "batch")
    return batch.crossJoin(F.broadcast(batch.agg(F.max(column).alias(out))))


def conform(df: DataFrame, cols) -> DataFrame:
    """reorder/select to a declared column list."""
    return df.select(*cols)


def add(df: DataFrame, **cols) -> DataFrame:
    """``SELECT *, <computed>``."""
    return df.withColumns({k: _c(v) for k, v in cols.items()})

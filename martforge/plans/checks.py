"""Operator-level marts over driver data: status chains (A10), first values
(A5), time arithmetic (X3-X10), best-effort timestamp parsing (X12-X15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import (clamp_ts, date_or_floor, fix_sec60, hhmmss, hms, hours_floor,
                                 json_text, minute_boundaries, minutes_elapsed, minutes_float,
                                 parse_ts, secs)
from martforge.operators import aggregates as A


def status_chains(changes: DataFrame, key: str, t: str, status: str) -> DataFrame:
    """Per key, the ordered status chain, the number of a given
    status and the first/last time of another; a hot key's chain is built in stretches."""
    return A.chains(
        changes, key, t, status, "status_chain",
        cnt_assistant=(A.count_where(F.col(status) == "assistant"), F.sum),
        first_user=(A.min_where(t, F.col(status) == "user"), F.min),
        last_user=(A.max_where(t, F.col(status) == "user"), F.max),
        n_changes=(A.n_rows(), F.sum))


def first_values(df: DataFrame, key: str, t: str, value: str, tie: str) -> DataFrame:
    """A5: per key, the value at the earliest time (NULL values skipped) and
    the distinct values joined (A9)."""
    return df.groupBy(key).agg(
        A.value_at_first(value, t, tie=tie).alias("first_value"),
        F.min(t).alias("first_time"),
        A.join_distinct(value).alias("all_values"))


def time_arithmetic(df: DataFrame, id_col: str, a: str, b: str) -> DataFrame:
    """X3-X10 over every row: seconds, whole hours, minute boundaries,
    half-even minutes, fractional minutes and two clock formats."""
    s = secs(a, b)
    return df.select(id_col, s.alias("seconds"), hours_floor(a, b).alias("hours"),
                     minute_boundaries(a, b).alias("minute_boundaries"),
                     minutes_elapsed(a, b).alias("minutes_elapsed"),
                     minutes_float(a, b).alias("minutes_float"),
                     hhmmss(F.abs(s)).alias("hhmmss"), hms(F.abs(s) / F.lit(7.0)).alias("hms"))


def parsed_times(reports: DataFrame, id_cols, keys) -> DataFrame:
    """X12-X15 over every report: raw text, leap-second repair, parse,
    clamp and date-or-floor."""
    cols = list(id_cols)
    for k in keys:
        raw = json_text("computed_data", k)
        cols += [parse_ts(raw).alias(f"{k}_raw"),
                 parse_ts(fix_sec60(raw)).alias(f"{k}_ts"),
                 clamp_ts(parse_ts(fix_sec60(raw))).alias(f"{k}_clamped"),
                 date_or_floor(fix_sec60(raw)).alias(f"{k}_date")]
    return reports.select(*cols)

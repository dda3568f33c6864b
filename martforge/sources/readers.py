"""Sources: table scans, date windows, delimited/JSON files.

Date windows are written so the predicate reaches the parquet scan: when the
mart filters on a *derived* date (local wall time, +3 h shift), an extra
raw-timestamp range a day wider on each side is added. The raw range is
implied by the exact predicate, so results do not change, but the scan skips
row groups (``PushedFilters`` in the plan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions.time import local_date, plus_hours


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet", **options) -> DataFrame:
    """Whole-table scan (parquet path, catalog table, or JDBC with options)."""
    if fmt == "table":
        return spark.table(path_or_name)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(dbtable=path_or_name, **options).load()
    return spark.read.format(fmt).options(**options).load(path_or_name)


def _ts_lit(d) -> F.Column:
    from martforge.functions.time import ntz
    return ntz(d)


def in_window(df: DataFrame, ts: str, as_of: dt.date, days: int, *, local: bool = False,
              shift_hours: int = 0, end_offset: int = 0, pad_before: int = 0,
              pad_after: int = 0) -> DataFrame:
    """Keep rows whose day lies in ``[as_of - days - pad_before,
    as_of - end_offset + pad_after]`` (both ends inclusive).

    ``local`` compares the Moscow calendar day of a UTC instant;
    ``shift_hours`` compares the day of ``ts + shift_hours``.
    """
    lo = as_of - dt.timedelta(days=days + pad_before)
    hi = as_of - dt.timedelta(days=end_offset) + dt.timedelta(days=pad_after)
    c = F.col(ts)
    if local:
        day = local_date(c)
    elif shift_hours:
        day = F.to_date(plus_hours(c, shift_hours))
    else:
        day = F.to_date(c)
    exact = (day >= F.lit(lo)) & (day <= F.lit(hi))
    if local or shift_hours:
        # implied raw range (local offsets are below one day), pushed to the scan
        raw = (c >= _ts_lit(lo - dt.timedelta(days=1))) & (c < _ts_lit(hi + dt.timedelta(days=2)))
        return df.where(raw & exact)
    return df.where((c >= _ts_lit(lo)) & (c < _ts_lit(hi + dt.timedelta(days=1))))


def since(df: DataFrame, ts: str, start) -> DataFrame:
    """Open-ended window ``ts >= start`` (date or datetime)."""
    return df.where(F.col(ts) >= _ts_lit(start))


def read_delimited(spark: SparkSession, path: str, sep: str = ";", required=(),
                   schema: T.StructType | None = None) -> DataFrame:
    """Delimited text with a header; fails early when a required column is missing."""
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", True) \
        .option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    df = clean_column_names(reader.csv(path))
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def read_dim_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Small typed dimension from CSV (no inference)."""
    return spark.read.schema(schema).option("header", True).option("sep", sep).csv(path)


def flatten_items(df: DataFrame, field_map) -> DataFrame:
    """JSON items -> flat typed columns by (api field, column, kind).

    ``kind`` is 'text' (scalar, list or bool rendered as text), 'date'
    (bad/empty -> 1900-01-01), 'long' or 'raw'.
    """
    from martforge.functions.text import scalar_text, to_text, yes_no
    from martforge.functions.time import date_or_floor
    types = dict(df.dtypes)
    cols = []
    for api, name, kind in field_map:
        src = F.col(f"`{api}`") if api in types else F.lit(None).cast("string")
        t = types.get(api, "string")
        if kind == "text":
            if t.startswith("array"):
                v = to_text(src.cast("array<string>"))
            elif t == "boolean":
                v = yes_no(src)
            else:
                v = scalar_text(src)
        elif kind == "date":
            v = date_or_floor(src)
        elif kind == "long":
            v = src.cast("string").try_cast("long")
        else:
            v = src
        cols.append(v.alias(name))
    return df.select(*cols)


def read_id_lists(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """First column of every headerless file in a folder, with its file."""
    df = (spark.read.option("header", False).option("pathGlobFilter", glob)
          .csv(folder).select(F.col("_c0").alias("raw_id"), F.col("_metadata.file_path").alias("file"),
                              F.col("_metadata.file_modification_time").alias("file_mtime")))
    return df


def latest_file(df: DataFrame, file_col: str = "file", mtime_col: str = "file_mtime") -> DataFrame:
    """Rows of the newest file only (one-row max, broadcast back)."""
    newest = df.agg(F.max_by(F.col(file_col), F.col(mtime_col)).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(file_col) == F.col("_newest"), "left_semi")


def file_index(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """(path, modificationTime, length) of a folder's files from their listing; no file is opened."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
            .select("path", "modificationTime", "length"))


def newest_file(spark: SparkSession, folder: str, glob: str = "*.csv") -> str | None:
    """The path of the newest file (of equal times the last by name); None for an empty folder."""
    row = file_index(spark, folder, glob).agg(F.max(F.struct("modificationTime", "path")).alias("f")).first()
    return row["f"]["path"] if row["f"] else None


def read_newest_ids(spark: SparkSession, folder: str, glob: str = "*.csv") -> DataFrame:
    """S10 on the newest file alone: (raw_id, file, file_mtime); the other files are listed, not read."""
    newest = newest_file(spark, folder, glob)
    if newest is None:
        return spark.createDataFrame([], "raw_id string, file string, file_mtime timestamp")
    return read_id_lists(spark, newest, "*")


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip 1-3 quote characters at both ends of each header, then a BOM."""
    import re
    names = []
    for c in df.columns:
        n = re.sub(r'^["\']{1,3}|["\']{1,3}$', "", c)
        names.append(n.replace("﻿", "").strip())
    return df.toDF(*names)

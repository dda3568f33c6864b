"""Readers and scan windows (S1-S13) and small operators."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge import functions as X
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.operators import windows as W
from martforge.sources import readers as S

D = dt.datetime


def test_in_window_bounds_and_pushdown(spark):
    df = spark.createDataFrame([(D(2024, 1, 9, 20, 59),), (D(2024, 1, 9, 21, 0),), (D(2024, 1, 10, 20, 59),),
                                (D(2024, 1, 10, 21, 0),)], "t timestamp_ntz")
    # local (Moscow, +3) days 2024-01-10 only: 21:00 UTC on the 9th .. 20:59 on the 10th
    got = [r[0] for r in S.in_window(df, "t", dt.date(2024, 1, 10), 0, local=True).collect()]
    assert got == [D(2024, 1, 9, 21, 0), D(2024, 1, 10, 20, 59)]
    # window ending yesterday (S4) and padded
    assert S.in_window(df, "t", dt.date(2024, 1, 11), 1, end_offset=1).count() == 2
    assert S.in_window(df, "t", dt.date(2024, 1, 10), 0, pad_before=1).count() == 4
    assert S.since(df, "t", D(2024, 1, 10)).count() == 2


def test_window_filter_reaches_parquet_scan(spark, tmp):
    path = os.path.join(tmp, "t.parquet")
    spark.createDataFrame([(D(2024, 1, 1),)], "t timestamp_ntz").write.parquet(path)
    plan = S.in_window(spark.read.parquet(path), "t", dt.date(2024, 1, 10), 3, local=True)._jdf \
        .queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), GreaterThanOrEqual(t," in plan


def test_delimited_and_header_cleanup(spark, tmp):
    path = os.path.join(tmp, "in.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('﻿"""accession""";"comment"\n"A123456";"line one\nline two"\n')
    df = S.read_delimited(spark, path, ";", required=("accession", "comment"))
    assert df.columns == ["accession", "comment"]
    assert df.collect()[0]["comment"] == "line one\nline two"
    with pytest.raises(ValueError):
        S.read_delimited(spark, path, ";", required=("missing",))


def test_dim_csv_id_lists_and_latest_file(spark, tmp):
    dim = os.path.join(tmp, "tariffs.csv")
    with open(dim, "w") as f:
        f.write("model_id,current,possible\n1003,1.50,2.00\n")
    schema = T.StructType([T.StructField("model_id", T.LongType()), T.StructField("current", T.DecimalType(10, 2)),
                           T.StructField("possible", T.DecimalType(10, 2))])
    assert S.read_dim_csv(spark, dim, schema).collect()[0]["model_id"] == 1003
    folder = os.path.join(tmp, "ids")
    os.makedirs(folder)
    for i, ids in enumerate([["A111111"], ["A222222", "A333333"]]):
        p = os.path.join(folder, f"list{i}.csv")
        with open(p, "w") as f:
            f.write("\n".join(ids) + "\n")
        os.utime(p, (time.time() + i * 10, time.time() + i * 10))
    ids = S.read_id_lists(spark, folder)
    assert sorted(r["raw_id"] for r in ids.collect()) == ["A111111", "A222222", "A333333"]
    assert sorted(r["raw_id"] for r in S.latest_file(ids).collect()) == ["A222222", "A333333"]


def test_flatten_items(spark):
    items = spark.createDataFrame([(7, ["a", None, "b"], True, " x ", "2024-01-02"), (None, None, None, None, "bad")],
                                  "id long, tags array<string>, flag boolean, name string, day string")
    out = S.flatten_items(items, [("id", "id", "long"), ("tags", "tags", "text"), ("flag", "flag", "text"),
                                  ("name", "name", "text"), ("day", "day", "date"), ("nope", "nope", "text")])
    got = [tuple(r) for r in out.collect()]
    assert got == [(7, "a; b", "Да", "x", dt.date(2024, 1, 2), ""), (None, "", "", "", dt.date(1900, 1, 1), "")]


def test_small_operators(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00", 3), (2, "bad", None), (3, "", 5)],
                               "id int, s string, c int")
    assert [r[0] for r in Fl.parsed_ok(df, "s").collect()] == [1]
    assert [r[0] for r in Fl.where_code(df, "c", "!=", 3).collect()] == [3]      # NULL code drops
    assert [r[0] for r in Fl.non_blank(df, "s").select("id").collect()] == [1, 2]
    out = df.select(X.case((F.col("c") > 4, "big"), (F.col("c") > 0, "small"), default="none").alias("k"))
    assert [r[0] for r in out.collect()] == ["small", "none", "big"]
    assert [r[0] for r in df.select(X.null_if("c", 3)).collect()] == [None, None, 5]
    left = spark.createDataFrame([(1, 10)], "p int, e long")
    right = spark.createDataFrame([("1", "10", "hit")], "p string, e string, v string")
    assert J.left_cast(left, right, ["p", "e"]).collect()[0]["v"] == "hit"
    ev = spark.createDataFrame([("a", D(2024, 1, 1)), ("b", D(2024, 1, 3))], "v string, t timestamp_ntz")
    assert W.newest(ev, "v", "t").collect()[0][0] == "b"
    assert [r[0] for r in W.order(ev, F.col("t").desc_nulls_last()).collect()] == ["b", "a"]

"""T3 properties of load policies and streaming jobs."""

import datetime as dt
import os

from pyspark.sql import functions as F

from martforge.sinks import policies as K
from martforge.streaming import jobs as R


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is not None, x) for x in t))


def test_replace_window_idempotent_and_empties_days(spark, tmp):
    path = os.path.join(tmp, "target")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    first = spark.createDataFrame([(d1, 1), (d2, 2), (d3, 3)], "d date, v int")
    assert K.replace_window(first, path, "d", d1, d3)
    # rerun with day 2 gone and day 3 changed: day 2 must be emptied
    second = spark.createDataFrame([(d1, 1), (d3, 30)], "d date, v int")
    assert K.replace_window(second, path, "d", d1, d3)
    assert rows(spark.read.parquet(path), "d", "v") == [(d1, 1), (d3, 30)]
    # running the same load again changes nothing
    K.replace_window(second, path, "d", d1, d3)
    assert rows(spark.read.parquet(path), "d", "v") == [(d1, 1), (d3, 30)]
    # an empty extract leaves the target alone
    assert not K.replace_window(second.where("v < 0"), path, "d", d1, d3)
    assert rows(spark.read.parquet(path), "d", "v") == [(d1, 1), (d3, 30)]


def test_replace_window_keeps_days_outside(spark, tmp):
    path = os.path.join(tmp, "target")
    d0, d1 = dt.date(2023, 12, 31), dt.date(2024, 1, 1)
    K.replace_window(spark.createDataFrame([(d0, 0)], "d date, v int"), path, "d", d0, d0)
    K.replace_window(spark.createDataFrame([(d1, 1)], "d date, v int"), path, "d", d1, d1)
    assert rows(spark.read.parquet(path), "d", "v") == [(d0, 0), (d1, 1)]


def test_upsert_latest_keeps_ties(spark, tmp):
    path = os.path.join(tmp, "up")
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    K.upsert_latest(spark.createDataFrame([("a", t1, 1), ("b", t1, 2)], "k string, ts timestamp_ntz, v int"),
                    path, "k", "ts")
    K.upsert_latest(spark.createDataFrame([("a", t2, 10), ("a", t2, 11), (None, t1, 5)],
                                          "k string, ts timestamp_ntz, v int"), path, "k", "ts")
    got = rows(spark.read.parquet(path), "k", "v")
    assert got == [(None, 5), ("a", 10), ("a", 11), ("b", 2)]


def test_insert_unseen_never_adds_twice(spark, tmp):
    path = os.path.join(tmp, "ids")
    df = spark.createDataFrame([("A1",), ("A2",), ("A2",)], "id string")
    K.insert_unseen(df, path, "id")
    K.insert_unseen(spark.createDataFrame([("A2",), ("A3",)], "id string"), path, "id")
    assert rows(spark.read.parquet(path), "id") == [("A1",), ("A2",), ("A3",)]


def test_append_retain_drops_old_partitions(spark, tmp):
    path = os.path.join(tmp, "snap")
    for day in (1, 2, 5):
        d = dt.date(2024, 1, day)
        K.append_retain(spark.createDataFrame([(d, day)], "load_date date, v int"), path, "load_date", d, 3)
    assert rows(spark.read.parquet(path), "v") == [(2,), (5,)]


def test_align_schema_fills_defaults(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    new = spark.createDataFrame([(2, 3.5)], "a int, c double")
    out = K.align_schema(old, new)
    assert out.columns == ["a", "b", "c"]
    assert rows(out, "a", "b", "c") == [(1, "x", 0.0), (2, "", 3.5)]


def test_export_and_refresh(spark, tmp):
    df = spark.createDataFrame([(1, "a;b")], "a int, b string")
    K.export(df, os.path.join(tmp, "j"), "json")
    K.export(df, os.path.join(tmp, "c"), "csv", ";")
    back = spark.read.option("header", True).option("sep", ";").csv(os.path.join(tmp, "c"))
    assert back.collect()[0]["b"] == "a;b"
    seen = []
    assert K.refresh([(lambda: df, seen.append), (lambda: df, seen.append)]) == 2 and len(seen) == 2


def test_stream_ids_restart_adds_nothing_twice(spark, tmp):
    src, dst, ck = (os.path.join(tmp, n) for n in ("in", "out", "ck"))
    os.makedirs(src)
    for i, lines in enumerate([[" 12345 6", "А123456", "x"], ["a1234567", "123"], ["12345 6"]]):
        with open(os.path.join(src, f"f{i}.csv"), "w") as f:
            f.write("\n".join(lines) + "\n")
    with open(os.path.join(src, "skip.txt"), "w") as f:
        f.write("A999999\n")
    q = R.stream_ids(spark, src, dst, ck, max_files=2)
    q.awaitTermination()
    got = rows(spark.read.parquet(dst), "accession")
    assert got == [("A123456",), ("A1234567",)]
    # a new file plus a restart: only the new id is added
    with open(os.path.join(src, "f9.csv"), "w") as f:
        f.write("A7654321\nA123456\n")
    R.stream_ids(spark, src, dst, ck).awaitTermination()
    assert rows(spark.read.parquet(dst), "accession") == [("A123456",), ("A1234567",), ("A7654321",)]


def test_stream_event_log_equals_batch_distinct(spark, tmp):
    src, dst, ck = (os.path.join(tmp, n) for n in ("ev", "log", "ck"))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("event_type").alias("entity"), F.col("ts").cast("timestamp").alias("loaded"))
    ev.unionByName(ev.limit(50)).write.parquet(src)
    R.stream_event_log(spark, src, dst, ck, ev.schema).awaitTermination()
    got = spark.read.parquet(dst)
    assert got.count() == ev.distinct().count()
    assert got.exceptAll(ev.distinct()).count() == 0


def test_stream_event_log_keeps_late_rows(spark, tmp):
    src, dst, ck = (os.path.join(tmp, n) for n in ("late", "late-log", "late-ck"))
    log = lambda *days: spark.createDataFrame([("a", d) for d in days], "entity string, loaded string").withColumn(
        "loaded", F.col("loaded").cast("timestamp"))
    log("2024-03-01", "2024-03-01").write.parquet(src)
    schema = spark.read.parquet(src).schema
    R.stream_event_log(spark, src, dst, ck, schema, max_files=1).awaitTermination()
    log("2024-01-01", "2024-03-01").write.mode("append").parquet(src)
    R.stream_event_log(spark, src, dst, ck, schema, max_files=1).awaitTermination()
    assert sorted(str(r.loaded.date()) for r in spark.read.parquet(dst).collect()) == ["2024-01-01", "2024-03-01"]


def test_snapshot_and_upsert_rerun_change_nothing(spark, tmp):
    import datetime as dt
    snap = spark.createDataFrame([(dt.date(2024, 1, 5), 1)], "load_date date, v int")
    for _ in range(2):
        K.append_retain(snap, os.path.join(tmp, "snap"), "load_date", dt.date(2024, 1, 5), 3)
    assert spark.read.parquet(os.path.join(tmp, "snap")).count() == 1
    rows_ = spark.createDataFrame([("a", 1, 5), (None, 1, 6)], "k string, ver int, v int")
    for _ in range(2):
        K.upsert_latest(rows_, os.path.join(tmp, "up"), "k", "ver")
    assert spark.read.parquet(os.path.join(tmp, "up")).count() == 2


def test_replace_window_null_partition_and_failing_rename(spark, tmp):
    import datetime as dt

    import pytest
    from martforge.sinks import policies
    path = os.path.join(tmp, "win")
    frame = lambda *d: spark.createDataFrame([(x, 1) for x in d], "d date, v int")
    day = dt.date(2024, 1, 2)
    frame(None, day).write.partitionBy("d").parquet(path)
    assert K.replace_window(frame(day), path, "d", day, day)
    assert spark.read.parquet(path).count() == 2

    class Stuck:
        def rename(self, a, b):
            return False

    with pytest.raises(OSError):
        policies._move(Stuck(), "a", "b")

"""Versioned tables: each load is all or nothing, wherever it is killed."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from martforge.sinks.versioned import ConcurrentLoad, VersionedTable, _range_of

D = [dt.date(2024, 1, d) for d in range(1, 10)]


class Killed(Exception):
    pass


def killer(at):
    """A step hook that stops the load before its ``at``-th file-system step."""
    seen = []

    def step(name):
        if len(seen) == at:
            raise Killed(name)
        seen.append(name)
    return step, seen


def rows(table, *cols):
    return sorted((tuple(r) for r in table.read().select(*cols).collect()), key=str)


def every_kill(spark, tmp, prepare, load, cols):
    """Kills ``load`` before each of its steps: old or new version, and a rerun gives the new one."""
    table = VersionedTable(spark, os.path.join(tmp, "whole"))
    prepare(table)
    old = rows(table, *cols)
    step, steps = killer(-1)
    load(VersionedTable(spark, table.path, step))
    new = rows(table, *cols)
    assert old != new and "publish" in steps
    outcomes = set()
    for at in range(len(steps)):
        path = os.path.join(tmp, f"killed{at}")
        table = VersionedTable(spark, path)
        prepare(table)
        with pytest.raises(Killed):
            load(VersionedTable(spark, path, killer(at)[0]))
        seen = rows(table, *cols)
        assert seen == (new if steps[at] in ("published", "discard") else old), steps[at]
        outcomes.add(seen == new)
        load(table)
        assert rows(table, *cols) == new
        table.vacuum(keep=1, min_age=dt.timedelta(0))
        assert rows(table, *cols) == new
        left = {e["path"].split("/")[1] for e in table.manifest()["entries"]}
        assert set(os.listdir(os.path.join(path, "data"))) == left
    assert False in outcomes


def test_window_killed_anywhere(spark, tmp):
    frame = lambda *r: spark.createDataFrame(list(r), "d date, v int")
    every_kill(spark, tmp,
               lambda t: t.replace_window(frame((D[0], 1), (D[1], 2), (D[2], 3)), "d", D[0], D[2]),
               lambda t: t.replace_window(frame((D[2], 30)), "d", D[1], D[2]), ["d", "v"])


def test_overwrite_killed_anywhere(spark, tmp):
    frame = lambda *r: spark.createDataFrame([(x,) for x in r], "v int")
    every_kill(spark, tmp, lambda t: t.overwrite(frame(1, 2)), lambda t: t.overwrite(frame(3)), ["v"])


def test_upsert_killed_anywhere(spark, tmp):
    frame = lambda *r: spark.createDataFrame(list(r), "k string, ver int, v int")
    every_kill(spark, tmp, lambda t: t.upsert_latest(frame(("a", 1, 1), ("b", 1, 2)), "k", "ver"),
               lambda t: t.upsert_latest(frame(("a", 2, 10), ("c", 1, 3)), "k", "ver"), ["k", "ver", "v"])


def test_window_keeps_other_days_and_empties(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "w"))
    frame = lambda *r: spark.createDataFrame(list(r), "d date, v int")
    assert t.version() == 0
    with pytest.raises(FileNotFoundError):
        t.read()
    assert t.replace_window(frame(), "d", D[0], D[2]) is None and t.version() == 0
    t.replace_window(frame(*((d, i) for i, d in enumerate(D))), "d", D[0], D[-1])
    before = {e["part"]: e["path"] for e in t.manifest()["entries"]}
    t.replace_window(frame((D[4], 40)), "d", D[3], D[5])
    assert rows(t, "d", "v") == [(d, 40 if i == 4 else i) for i, d in enumerate(D) if i not in (3, 5)]
    after = {e["part"]: e["path"] for e in t.manifest()["entries"]}
    assert all(after[k] == before[k] for k in after if k != "2024-01-05")
    with pytest.raises(ValueError):
        t.replace_window(frame((D[8], 1)), "d", D[3], D[5])
    with pytest.raises(ValueError):
        t.replace_window(frame((None, 1)), "d", D[3], D[5])
    assert t.version() == 2 and {r.v for r in t.read().collect()} == {0, 1, 2, 40, 6, 7, 8}
    assert t.read(version=1).count() == 9
    assert [r.v for r in t.read(parts=["2024-01-05"]).collect()] == [40]
    t.replace_window(frame((D[4], 40)), "d", D[3], D[5])
    assert t.read().count() == 7


def test_second_of_two_loads_fails_whole(spark, tmp):
    path = os.path.join(tmp, "c")
    frame = lambda v: spark.createDataFrame([(v,)], "v int")
    other = VersionedTable(spark, path)

    def meanwhile(name):
        if name == "publish" and not other.version():
            other.overwrite(frame(2))

    with pytest.raises(ConcurrentLoad):
        VersionedTable(spark, path, meanwhile).overwrite(frame(1))
    assert rows(other, "v") == [(2,)]
    assert not [n for n in os.listdir(os.path.join(path, "_versions")) if n.startswith(".draft")]


def test_columns_added_later(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "s"))
    day = lambda d, sql: spark.sql(f"SELECT DATE'{d}' AS d, {sql}")
    t.append_retain(day(D[0], "1 AS a"), "d", D[0], 30)
    t.append_retain(day(D[1], "2 AS a, 'x' AS b, 1.5D AS c"), "d", D[1], 30)
    t.append_retain(day(D[2], "CAST(NULL AS STRING) AS b, 3 AS a"), "d", D[2], 30)
    got = sorted(t.read().select("a", "b", "c").collect())
    assert [tuple(r) for r in got] == [(1, "", 0.0), (2, "x", 1.5), (3, None, 0.0)]


def test_snapshots_are_kept_for_their_days(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "r"))
    snap = lambda d: spark.createDataFrame([(d, d.day)], "load_date date, v int")
    for d in (D[0], D[1], D[4], D[4]):
        t.append_retain(snap(d), "load_date", d, 3)
    assert rows(t, "v") == [(2,), (5,)]


def test_upsert_equals_brute_force_and_spares_files(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "u"))
    rng = random.Random(1)
    schema, model = "k1 string, k2 int, ver int, v int", {}

    def load(batch):
        t.upsert_latest(spark.createDataFrame(batch, schema), ["k1", "k2"], "ver", rows_per_file=50)
        for key in {r[:2] for r in batch}:
            own = [r for r in batch if r[:2] == key]
            mine = [r for r in model.get(key, []) if r[2] not in {o[2] for o in own}] + own
            top = max((r[2] for r in mine), key=lambda x: (x is not None, x))
            model[key] = [r for r in mine if r[2] == top]
        want = sorted((r for rs in model.values() for r in rs), key=str)
        assert sorted(map(tuple, t.read().collect()), key=str) == want

    load([(f"s{rng.randrange(300):03d}", rng.choice([1, 2, None]), 1, i) for i in range(900)])
    files = {e["path"]: (e["lo"], e["hi"]) for e in t.manifest()["entries"]}
    assert len(files) > 5
    lows = [e["lo"] for e in sorted(t.manifest()["entries"], key=lambda e: e["at"])]
    assert lows == sorted(lows, key=lambda x: (x[0], int(x[1] or 0)))
    stamps = {p: os.stat(os.path.join(t.path, p)).st_mtime_ns for p in files}
    batch = [("s150", 1, 2, -1), ("s150", 1, 2, -2), ("s151", None, 2, -3)]
    load(batch)
    after = {e["path"] for e in t.manifest()["entries"]}
    hit = {p for p, (lo, hi) in files.items() if lo[0] <= "s151" and hi[0] >= "s150"}
    assert files.keys() - after <= hit and len(files.keys() - after) <= 2
    assert all(os.stat(os.path.join(t.path, p)).st_mtime_ns == stamps[p] for p in files.keys() & after)
    load(batch)  # again: nothing changes
    load([("a", 1, 1, 5), ("zzz", 1, 1, 6), (None, None, 1, 7), ("s150", 1, 1, 8)])
    for _ in range(3):
        load([(f"s{rng.randrange(400):03d}", rng.choice([1, 2]), rng.randrange(4), rng.randrange(99)) for _ in range(60)])


def test_range_of_finds_the_range(spark):
    lows = [["b", "2"], ["b", "10"], ["d", None]]
    data = [(None, 1), ("a", 5), ("b", 1), ("b", 2), ("b", 9), ("b", 10), ("c", 0), ("d", None), ("d", -1), ("z", 0)]
    df = spark.createDataFrame(data, "k string, n int")
    got = [r[0] for r in df.select(_range_of(["k", "n"], [df.schema["k"].dataType, df.schema["n"].dataType], lows)).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_loads_record_their_figures(spark, tmp):
    from martforge.operators.filters import drop_null_key
    t = VersionedTable(spark, os.path.join(tmp, "m"))
    df = spark.createDataFrame([(1,), (None,), (None,), (4,)], "k int")
    kept, seen = drop_null_key(df, "k")
    t.overwrite(kept, observed=[seen])
    assert {(r.metric, r.value) for r in t.metrics().collect()} == {("rows", 2), ("dropped", 2)}


def test_a_replayed_batch_is_added_once(spark, tmp):
    t = VersionedTable(spark, os.path.join(tmp, "b"))
    one = spark.createDataFrame([(1,)], "v int")
    for batch in (0, 0, 1, 1, 0):
        t.append(one, "s", batch)
    assert t.read().count() == 2 and t.version() == 2
    t.append(one)
    assert t.append(one, "s", 1) is None and t.read().count() == 3

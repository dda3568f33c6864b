"""Joins, aggregates, windows and set operators."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martforge.operators import aggregates as A
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.operators import setops as U
from martforge.operators import windows as W

D = dt.datetime
d = dt.date


def _key(t):
    return tuple((x is not None, str(x)) for x in t)


def rows(df, *cols):
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=_key)


def S(expected):
    return sorted(expected, key=_key)


def test_interval_winner_latest_start_then_name(spark):
    facts = spark.createDataFrame([(1, 1, d(2024, 3, 1)), (2, 1, d(2024, 1, 1)), (3, 2, d(2024, 1, 1)),
                                   (4, 1, d(2030, 1, 1)), (5, 9, d(2024, 1, 1)), (6, 1, d(2024, 2, 1))],
                                  "id int, p int, at date")
    periods = spark.createDataFrame([
        (1, d(2024, 1, 1), d(2024, 12, 31), "B"),
        (1, d(2024, 2, 1), None, "Z"),              # open end, later start
        (1, d(2024, 2, 1), d(2024, 2, 1), "A"),     # same start, smaller name, both bounds inclusive
        (2, d(2023, 1, 1), d(2023, 12, 31), "X"),
    ], "p int, start_date date, end_date date, name string")
    out = J.interval_winner(facts, periods, "p", "at")
    assert rows(out, "id", "period_name") == S([(1, "Z"), (2, "B"), (3, None), (4, "Z"), (5, None), (6, "A")])
    assert out.count() == facts.count()  # at most one row per fact


def test_nearest_by_time_matches_brute_force(spark):
    rnd = random.Random(7)
    base = D(2024, 1, 1)
    left = [(rnd.randint(0, 3), base + dt.timedelta(minutes=rnd.randint(0, 20000))) for _ in range(300)]
    right = [(rnd.randint(0, 3), base + dt.timedelta(minutes=rnd.randint(0, 20000)), i) for i in range(120)]
    right += [(0, right[0][1], 1000), (1, base + dt.timedelta(minutes=500), 1001),
              (1, base + dt.timedelta(minutes=700), 1002)]
    left += [(1, base + dt.timedelta(minutes=600)), (5, base)]
    L = spark.createDataFrame(left, "k int, t timestamp_ntz")
    R = spark.createDataFrame(right, "k int, rt timestamp_ntz, rid long")
    got = {(r["k"], r["t"]): (r["near_id"], r["near_dist_s"])
           for r in J.nearest_by_time(L, R, ["k"], "t", "rt", "rid", bucket_seconds=7200).collect()}
    for k, t in set(left):
        cands = [(abs(int((rt - t).total_seconds())), rid) for kk, rt, rid in right if kk == k]
        want = min(cands) if cands else None
        assert got[(k, t)] == ((want[1], want[0]) if want else (None, None)), (k, t)


def test_anti_pair_keeps_exempt_and_null(spark):
    df = spark.createDataFrame([(1, "AE1", 5), (2, "AE1", 33), (3, "AE2", 5), (4, "AE1", None)],
                               "id int, ae string, rid int")
    seen = spark.createDataFrame([("AE1", 5), ("AE1", 33)], "ae string, rid int")
    assert rows(J.anti_pair(df, seen, "ae", "rid", exempt=(33,)), "id") == [(2,), (3,), (4,)]


def test_membership_semi_strict_resolve(spark):
    df = spark.createDataFrame([(1, "s1"), (2, None), (3, "s3")], "a int, s string")
    side = spark.createDataFrame([(1,), (1,), (None,)], "a int")
    assert rows(J.membership(df, side, "a", "flag"), "a", "flag") == [(1, 1), (2, 0), (3, 0)]
    assert rows(J.semi(df, side, "a"), "a") == [(1,)]
    acts = spark.createDataFrame([(1, "s1", 10), (2, None, 20)], "a int, s string, n int")
    assert rows(J.left_strict(df, acts, ["a", "s"]), "a", "n") == S([(1, 10), (2, None), (3, None)])
    lk = spark.createDataFrame([(1, "one")], "id int, name string")
    assert rows(J.resolve(df, lk, "a", "id", "name", "nm"), "a", "nm") == [(1, "one"), (2, "2"), (3, "3")]


def test_versioned_dim_and_left_agg(spark):
    dim = spark.createDataFrame([(34, "old", d(1900, 1, 1), d(2026, 6, 1)), (34, "new", d(2026, 6, 1), d(2999, 1, 1))],
                                "code int, service_type string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(34, d(2026, 5, 31)), (34, d(2026, 6, 1)), (35, d(2026, 6, 1))], "code int, day date")
    out = J.versioned_dim(facts, dim, "code", "code", F.col("day"), ["service_type"])
    assert rows(out, "day", "service_type") == S([(d(2026, 5, 31), "old"), (d(2026, 6, 1), "new"), (d(2026, 6, 1), None)])
    side = spark.createDataFrame([(34, 5), (34, 7)], "code int, age int")
    assert rows(J.left_agg(facts, side, "code", age=F.min("age")), "code", "age") == S([(34, 5), (34, 5), (35, None)])


def test_value_at_first_skips_null_values(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), None, 1), (1, D(2024, 1, 2), "b", 2), (1, D(2024, 1, 2), "a", 3),
                                (2, D(2024, 1, 1), None, 4)], "k int, t timestamp_ntz, x string, id int")
    out = df.groupBy("k").agg(A.value_at_first("x", "t", tie="x").alias("v"))
    assert rows(out, "k", "v") == S([(1, "a"), (2, None)])


def test_chain_union_lists_join_distinct(spark):
    df = spark.createDataFrame([(1, 2, "RUNNING", "b, a"), (1, 1, "NEW", None), (1, 2, "DEFERRED", "a,,c "),
                                (2, 1, "NEW", "")], "k int, t int, s string, m string")
    out = df.groupBy("k").agg(A.chain("t", "s").alias("c"), A.union_lists("m").alias("u"),
                              A.join_distinct("s").alias("j"), A.count_where(F.col("s") == "NEW").alias("n"))
    assert rows(out) == S([(1, "NEW -> DEFERRED -> RUNNING", "a, b, c", "DEFERRED, NEW, RUNNING", 1),
                           (2, "NEW", None, "NEW", 1)])


def test_dup_audit_counts_null_keys(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), (None, "1"), (None, "1"), ("b", None)], "k string, v string")
    assert rows(A.dup_audit(df, ["k", "v"])) == [(5, 3, 2)]


def test_group_hidden_keeps_visible_duplicates(spark):
    df = spark.createDataFrame([("x", "s1", 1), ("x", "s2", 2)], "dim string, study string, acc int")
    out = A.group_hidden(df, ["dim"], "study", n=A.n_distinct("acc"))
    assert rows(out) == [("x", 1), ("x", 1)]


def test_windows(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), "ADD", 1), (1, D(2024, 1, 3), "EDIT", 2),
                                (1, D(2023, 1, 1), "DEL_ASSIGNMENT", 3), (2, D(2024, 1, 1), "ADD", 4),
                                (2, D(2024, 1, 1), "EDIT", 5)], "k int, t timestamp_ntz, a string, id int")
    assert rows(W.latest(df, "k", "t", tie=["id"]), "id") == [(2,), (4,)]
    assert rows(W.latest_priority(df, "k", F.col("a") == "DEL_ASSIGNMENT", "t", tie=["id"]), "id") == [(3,), (4,)]
    assert rows(W.keep_latest(df, ["k"], "t"), "id") == [(2,), (4,), (5,)]   # ties kept
    assert rows(W.first_row(df, "k", "t", tie=["id"]), "id") == [(3,), (4,)]


def test_second_newest(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", 5), ("b", 2), ("c", 7)], "k string, v int")
    assert rows(W.second_newest(df, "v", ["k"]), "k", "newest", "previous") == S([
        ("a", 3, 3), ("b", 5, 2), ("c", 7, None)])
    assert rows(W.second_newest(df.where("k = 'zz'"), "v")) == [(None, None)]


def test_keep_first_uses_row_json_without_id(spark):
    df = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("", "z", 3), ("", "z", 4), ("", "w", 5)],
                               "id string, v string, seq int")
    assert rows(W.keep_first(df, "id", "seq"), "seq") == [(1,), (3,), (5,)]


def test_filters_and_setops(spark):
    df = spark.createDataFrame([(1, "", 5, "X"), (2, "a", 10000, None), (3, None, 50, "DEL")],
                               "id int, s string, m int, act string")
    assert rows(Fl.non_empty(df, "s"), "id") == [(2,)]
    assert rows(Fl.in_range(df, "m", 1, 9999), "id") == [(1,), (3,)]
    flagged = df.withColumn("f", F.lit(1))
    assert rows(Fl.drop_flagged(flagged, "f", "act", "DEL"), "id") == []
    assert rows(Fl.drop_flagged(df.withColumn("f", F.lit(0)), "f", "act", "DEL"), "id") == [(1,), (2,)]
    out, obs = Fl.drop_null_key(df, "s")
    assert out.count() == 2 and obs.get["dropped"] == 1
    assert rows(Fl.stamp_batch_max(df, "m", "mx"), "mx") == [(10000,)] * 3
    assert rows(U.rewrite_where(df, F.col("m") > 10, lambda x: x.withColumn("m", F.lit(0))), "id", "m") == [
        (1, 5), (2, 0), (3, 0)]
    a = spark.createDataFrame([("x",), ("y",), ("y",)], "k string")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    assert rows(U.id_minus(a, b, "k")) == [("x",)]
    assert rows(U.id_union(a, b, "k")) == [("x",), ("y",), ("z",)]


def test_min_json_counts_absent_as_empty(spark):
    df = spark.createDataFrame([(1, '{"a": {"n": "1"}}'), (1, '{"a": {}}'), (2, '{"a": {"n": "0"}}')], "k int, j string")
    assert rows(df.groupBy("k").agg(A.min_json("j", "a", "n").alias("m"))) == [(1, ""), (2, "0")]


def test_interval_winner_matches_brute_force(spark):
    rnd = random.Random(11)
    base = d(2024, 1, 1)
    periods = []
    for _ in range(60):
        k = rnd.randint(0, 3)
        s = base + dt.timedelta(days=rnd.randint(0, 300))
        e = None if rnd.random() < 0.2 else s + dt.timedelta(days=rnd.randint(0, 90))
        periods.append((k, s, e, rnd.choice("ABCDE")))
    facts = [(i, rnd.randint(0, 4), base + dt.timedelta(days=rnd.randint(-10, 420))) for i in range(400)]
    got = {r["id"]: r["period_name"] for r in J.interval_winner(
        spark.createDataFrame(facts, "id int, p int, at date"),
        spark.createDataFrame(periods, "p int, start_date date, end_date date, name string"), "p", "at").collect()}
    for i, k, t in facts:
        cover = [(-(s - base).days, n) for kk, s, e, n in set(periods)
                 if kk == k and s <= t <= (e or d(2099, 12, 31))]
        assert got[i] == (min(cover)[1] if cover else None), (i, k, t)


def test_health_roll_up(spark):
    df = spark.createDataFrame([("a", True, 1), ("b", False, 0), ("c", False, 1)], "t string, crit boolean, f int")
    out = A.health(df, F.col("crit"), n_fresh=F.col("f") == 1)
    assert rows(out) == [(1, 3, 2)]


def test_audit_counts_null_keys_of_any_type(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, None), (None, None)], "k long, s string")
    row = A.dup_audit(df, ["k", "s"]).first()
    assert (row.total_rows, row.distinct_keys, row.duplicates) == (5, 3, 2)


def test_nearest_by_time_compares_whole_seconds(spark):
    left = spark.createDataFrame([("k", "2024-01-01 00:00:10.5")], "k string, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    right = spark.createDataFrame([("k", "2024-01-01 00:00:08.2", 1), ("k", "2024-01-01 00:00:08.7", 2)],
                                  "k string, e string, id long").withColumn("e", F.col("e").cast("timestamp_ntz"))
    row = J.nearest_by_time(left, right, "k", "t", "e", "id").first()
    assert (row.near_id, row.near_dist_s) == (1, 2) and row.t.microsecond == 500000


def test_resolve_takes_the_smallest_name(spark):
    df = spark.createDataFrame([(1,), (2,)], "uid long")
    names = spark.createDataFrame([(1, "b"), (1, "a")], "id long, name string")
    assert rows(J.resolve(df, names, "uid", "id", "name", "who"), "uid", "who") == [(1, "a"), (2, "2")]


def test_session_keeps_what_was_set(spark):
    from martforge.session import get_session
    before = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "7m")
    try:
        assert get_session().conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == "7m"
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", before or "32m")

"""Operators that must hold for hot keys: against brute force, with their plans."""

import datetime as dt
import html
import html.entities
import os
import random

import pytest
from pyspark.sql import functions as F

from martforge import functions as X
from martforge.operators import aggregates as A
from martforge.operators import joins as J
from martforge.operators import windows as W
from martforge.sources import readers as S

DAY = dt.timedelta(days=1)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nodes_cover_each_day_once(spark):
    rng = random.Random(3)
    spans = [(a, a + n) for n in (0, 1, 2, 3, 4, 15, 16, 17, 63, 365, 4000, 36524) for a in (0, 1, 3, 1068576, rng.randrange(2 ** 21))]
    spans += [(0, 4 ** 11 - 1), (1, 4 ** 11 - 2), (5, 4)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(spans)], "i int, a int, b int")
    found = {i: [] for i in range(len(spans))}
    for r in df.select("i", F.explode(J._nodes(F.col("a"), F.col("b"))).alias("d")).select("i", "d.*").collect():
        found[r.i].append((r.at << 2 * r.level, (r.at + 1) << 2 * r.level))
    for i, (a, b) in enumerate(spans):
        runs = sorted(found[i])
        assert len(runs) <= 6 * 11
        ends = [a, *(hi for _, hi in runs)]
        assert [lo for lo, _ in runs] == ends[:-1] and ends[-1] == max(a, b + 1)


def test_interval_winner_of_a_patient_with_many_periods(spark):
    """10,000 nested and overlapping periods of one key; no join of periods with each other or with facts' dates."""
    rng = random.Random(9)
    base = dt.date(1990, 1, 1)
    periods = []
    for i in range(10_000):
        s = base + DAY * rng.randrange(9000)
        periods.append((7, s, None if rng.random() < 0.01 else s + DAY * rng.choice([-1, 0, 1, 30, 400, 9000]), rng.choice("ABC")))
    facts = [(i, 7, base + DAY * rng.randrange(-50, 20000)) for i in range(3000)] + [(-1, 7, None), (-2, None, base), (-3, 8, base)]
    out = J.interval_winner(spark.createDataFrame(facts, "id int, p int, at date"),
                            spark.createDataFrame(periods, "p int, start_date date, end_date date, name string"), "p", "at")
    got = {r["id"]: r["period_name"] for r in out.collect()}
    order = sorted({(-s.toordinal(), n, s, e or dt.date(2099, 12, 31)) for _, s, e, n in periods})
    for i, p, t in facts:
        want = next((n for _, n, s, e in order if s <= t <= e), None) if p == 7 and t else None
        assert got[i] == want, (i, t)
    text = plan(out)
    assert "Window" not in text and text.count("Join") == 2  # nodes by equality, then back to the facts
    assert "<=" not in text.split("Join LeftOuter")[1].split("\n")[0]


@pytest.mark.parametrize("seed", range(4))
def test_second_newest_brute_force(spark, seed):
    rng = random.Random(seed)
    data = [(rng.randrange(5), rng.choice([None, *range(rng.choice([2, 50]))])) for _ in range(400)] + [(9, None), (10, 4), (11, 4), (11, 4)]
    df = spark.createDataFrame(data, "k int, v long").repartition(7)
    got = {r.k: (r.newest, r.previous, r.n) for r in W.second_newest(df, "v", ["k"], n=A.n_rows()).collect()}
    for k in {k for k, _ in data}:
        own = sorted((v for kk, v in data if kk == k and v is not None), reverse=True)
        assert got[k] == (*(own + [None, None])[:2], sum(kk == k for kk, _ in data))
    for keys in ((), ("k",)):
        text = W.second_newest(df, "v", keys, n=A.n_rows())._jdf.queryExecution().executedPlan().toString()
        # two rows a key leave a task
        assert "Join" not in text and ("WindowGroupLimit" in text if keys else "TakeOrderedAndProject" in text or "Limit" in text)


def test_freshness_top_two(spark, tmp):
    from martforge.plans.operational import freshness_report
    day = dt.date(2024, 3, 5)
    at = lambda d, h: dt.datetime(2024, 3, d, h)
    for name, times in (("a", [at(5, 1), at(5, 9), at(5, 9)]), ("b", [at(3, 1)])):
        spark.createDataFrame([(t,) for t in times], "t timestamp_ntz").write.parquet(os.path.join(tmp, name))
    checks = [(n, "critical", n, spark.read.parquet(os.path.join(tmp, n)), "t") for n in "ab"]
    out = freshness_report(checks, day, at(5, 12), "board")
    rows = {r.table_name: r for r in out.collect()}
    assert (rows["a"].row_count, rows["a"].last_data_datetime, rows["a"].previous_data_datetime) == (3, at(5, 9), at(5, 9))
    assert rows["b"].row_count == 1 and rows["b"].previous_data_datetime == dt.datetime(1971, 1, 1)
    assert plan(out).count("Join") == 1  # with the one-row roll-up


def test_freshness_looks_at_each_table_its_own_way(spark):
    from martforge.plans.operational import freshness_report, source_checks
    day = dt.date(2024, 3, 5)
    at = lambda d, h=1: dt.datetime(2024, 3, d, h)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    exams = frame([(1, at(5)), (2, at(4)), (3, at(3))], "accession_number long, conduct_date timestamp_ntz")
    results = frame([(1,), (1,), (2,), (3,), (9,), (None,)], "accession_number long")
    trauma = frame([(at(2),), (at(1),)], "assignment_signed_date timestamp_ntz")
    undescribed = frame([(at(3),)], "create_date timestamp_ntz")
    pins = frame([(None, at(1)), (at(4), at(2)), (at(3), at(3)), (None, at(6))], "task_pin_end_date timestamp_ntz, task_pin_send_date timestamp_ntz")
    out = freshness_report(source_checks(exams, results, trauma, undescribed, pins, day), day, at(5, 12), "board")
    got = {r.table_name: (r.row_count, r.last_data_datetime, r.previous_data_datetime) for r in out.collect()}
    never = dt.datetime(1971, 1, 1)
    assert got == {"examinations": (2, at(5), at(4)), "results": (3, at(5), at(5)), "trauma": (1, at(2), never),
                   "undescribed": (0, never, never), "pin_tasks": (2, at(2), at(1))}
    assert len(out.columns) == 13 and {(r.overall_status, r.dashboard_name, r.fresh_tables_details) for r in out.collect()} == {
        ("ПРИГОДЕН", "board", "Критических таблиц: 2 из 2")}


def test_chains_equal_the_plain_chain(spark):
    rng = random.Random(5)
    data = [(0 if rng.random() < 0.6 else rng.randrange(9), rng.choice([None, *range(60)]), rng.choice(["new", "run", "", None]))
            for _ in range(3000)] + [(50, 1, None), (None, 2, "x")]
    df = spark.createDataFrame(data, "k int, t int, s string").repartition(5)
    got = A.chains(df, "k", "t", "s", n=(A.n_rows(), F.sum), low=(F.min("t"), F.min))
    want = df.groupBy("k").agg(A.chain("t", "s").alias("chain"), A.n_rows().alias("n"), F.min("t").alias("low"))
    key = lambda r: (r.k is not None, r.k)
    assert sorted(got.select("k", "chain", "n", "low").collect(), key=key) == sorted(want.collect(), key=key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = df.repartitionByRange("k", "t", "s").withColumn("run", F.spark_partition_id())
        runs = spread.where("k = 0").groupBy("run").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(runs) > 1  # the hot key lies in several tasks


def test_newest_file_is_the_only_one_read(spark, tmp):
    for i, ids in enumerate((["A1"], ["A2", "A3"], ["A4"])):
        file = os.path.join(tmp, f"l{i}.csv")
        with open(file, "w") as f:
            f.write("\n".join(ids) + "\n")
        os.utime(file, (1_700_000_000 + (i % 2) * 100,) * 2)
    with open(os.path.join(tmp, "later.txt"), "w") as f:
        f.write("no")
    got = S.read_newest_ids(spark, tmp)
    assert [os.path.basename(p) for p in got.inputFiles()] == ["l1.csv"]
    assert sorted(r.raw_id for r in got.collect()) == ["A2", "A3"]
    assert sorted(r.length for r in S.file_index(spark, tmp).collect()) == [3, 3, 6]
    os.makedirs(os.path.join(tmp, "none"))
    assert S.read_newest_ids(spark, os.path.join(tmp, "none")).count() == 0


def test_character_references_equal_the_standard_decoder(spark):
    names = [f"&{n}" for n in html.entities.html5] + [f"&{n.rstrip(';')}" for n in html.entities.html5]
    names += [f"&{n}x;" for n in html.entities.html5 if not n.endswith(";")]
    numbers = [f"&#{c};" for c in [*range(0, 0x120), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD,
                                   0xFFFE, 0xFFFF, 0x10000, 0x1F600, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10 ** 30]]
    numbers += ["&#x41;", "&#X41", "&#x1F600;z", "&#000065;", "&#x000000000041;", "&#;", "&#x;", "&#xg", "&# 1", "&#12a"]
    rng = random.Random(8)
    mixed = ["".join(rng.choices(["&amp;", "&lt", "&", ";", "amp;", "&notit;", "x", " ", "&#38;", "\n", "é&eacute", "&AMP", "&ngE;"], k=9))
             for _ in range(300)]
    texts = [*names, *numbers, *mixed, "", "plain", "&", "&&amp;&", "a & b &amp;lt;", "&" + "a" * 60 + ";", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", X.unescape_html("t").alias("u")).collect()}
    bad = [(t, got[i], html.unescape(t)) for i, t in enumerate(texts) if t is not None and got[i] != html.unescape(t)]
    assert not bad, bad[:5]
    assert got[len(texts) - 1] is None

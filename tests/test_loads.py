"""Load policies of the marts, refresh of dependents, streams with keyed state."""

import datetime as dt
import os
from graphlib import CycleError

import pytest
from pyspark.sql import functions as F

from martforge.plans import catalog as C
from martforge.plans import loads as L
from martforge.sinks.versioned import VersionedTable
from martforge.streaming import jobs as R

SF = "/root/testdata/sf0.001"
D = dt.datetime


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ---- marts ---------------------------------------------------------------------

def test_every_policy_names_columns_of_its_mart(spark):
    for name, policy in L.POLICIES.items():
        columns = C.QUERIES[name](spark, SF).columns
        added = {"loaded_at", "load_date"}
        assert {c for c in (policy.column, *policy.keys) if c} <= {*columns, *added}, name


def test_window_mart_loads_twice_without_change(spark, tmp):
    table = VersionedTable(spark, os.path.join(tmp, "m"))
    mart = C.QUERIES["oncology_counts"](spark, SF).withColumn("conduct_date", F.trunc("conduct_date", "MM"))
    lo, hi = dt.date(1990, 1, 1), dt.date(2010, 12, 31)
    assert table.replace_window(mart, "conduct_date", lo, hi) == 1
    assert table.replace_window(mart.where("year(conduct_date) >= 1996"), "conduct_date", dt.date(1996, 1, 1), hi) == 2
    assert same(table.read(), mart)
    assert {r.value for r in table.metrics().where("metric = 'rows' AND version = 1").collect()} == {mart.count()}


def test_snapshot_mart_keeps_three_days(spark, tmp):
    table = VersionedTable(spark, os.path.join(tmp, "q"))
    queue = C.QUERIES["undescribed_queue"](spark, SF)
    narrow = queue.drop("llo_benefit_status")
    days = [dt.date(2024, 5, d) for d in (1, 2, 5)]
    for day, df in zip(days, (narrow, narrow, queue)):
        L.load("undescribed_queue", df, table, day)
    got = table.read()
    assert {r.load_date for r in got.select("load_date").distinct().collect()} == {days[1], days[2]}
    assert same(got.where(F.col("load_date") == days[2]).drop("load_date").select(queue.columns), queue)
    assert got.where(F.col("load_date") == days[1]).where("llo_benefit_status <> ''").count() == 0


def test_ai_use_load_records_its_dropped_rows(spark, tmp):
    t, cfg, names = C._ai_inputs(spark, SF)
    tariffs = spark.createDataFrame(C.MODEL_TARIFFS, "model_id long, tariff_current double, tariff_possible double")
    by_model, by_study = (VersionedTable(spark, os.path.join(tmp, n)) for n in ("bm", "bs"))
    args = (t.results, t.reports, t.ai_log, cfg, names, tariffs, C.AI_FROM, C.AI_TO, by_model, by_study, C.AI_EXCLUDED_CODES, C.AI_MIN_START)
    for day in (1, 2, 2):
        L.load_ai_use(*args, loaded_at=D(2024, 1, day))
    assert same(by_model.read().drop("loaded_at"), C.QUERIES["ai_use_by_model"](spark, SF))
    assert same(by_study.read().drop("loaded_at"), C.QUERIES["ai_use_by_study"](spark, SF))
    missing = C.QUERIES["ai_use_series"](spark, SF).where("study_uid IS NULL").count()
    figures = [r.value for r in by_model.metrics().where("metric = 'dropped'").collect()]
    assert figures == [missing] * 3
    assert by_study.manifest()["inputs"] == {"ai_use_by_model": "3"}


# ---- K8 ------------------------------------------------------------------------

def test_refresh_runs_stale_marts_in_order(spark, tmp):
    """A diamond a -> (b, c) -> d and a leaf e of its own source."""
    src = {n: os.path.join(tmp, n) for n in ("s1", "s2")}
    for path in src.values():
        spark.range(3).write.parquet(path)
    tables = {n: VersionedTable(spark, os.path.join(tmp, f"t-{n}")) for n in "abcde"}
    rows = lambda *names: sum((tables[n].read().count() for n in names), 0)
    ran, broken = [], set()

    def job(name, *inputs):
        def run(table, versions):
            if name in broken:
                raise RuntimeError(name)
            ran.append(name)
            marts = [i for i in inputs if i in tables]
            n = rows(*marts) if marts else spark.read.parquet(src[inputs[0]]).count()
            table.overwrite(spark.range(n + 1).toDF("id"), inputs=dict(versions))
        return L.Job(inputs, run)

    jobs = {"d": job("d", "b", "c"), "c": job("c", "a"), "b": job("b", "a"), "a": job("a", "s1"), "e": job("e", "s2")}

    def refresh():
        ran.clear()
        assert L.refresh(spark, jobs, tables, src) == ran
        return list(ran)

    first = refresh()
    assert sorted(first) == list("abcde") and first.index("a") < min(first.index("b"), first.index("c")) and first.index("d") > max(
        first.index("b"), first.index("c"))
    assert refresh() == [] and rows("d") == 11
    spark.range(5).write.mode("append").parquet(src["s2"])
    assert refresh() == ["e"]
    spark.range(5).write.mode("append").parquet(src["s1"])
    broken.add("c")
    with pytest.raises(RuntimeError):
        L.refresh(spark, jobs, tables, src)
    before = tables["d"].version()
    broken.clear()
    rest = refresh()
    assert "a" not in rest and rest[-1] == "d" and "c" in rest and tables["d"].version() == before + 1
    assert refresh() == [] and rows("d") == 2 * 10 + 1
    with pytest.raises(CycleError):
        L.refresh(spark, {"a": job("a", "b"), "b": job("b", "a")}, tables, {})


# ---- R1, R2 --------------------------------------------------------------------

def logical(query):
    return query._jsq.explainInternal(True) if hasattr(query._jsq, "explainInternal") else ""


def write_ids(folder, name, *ids):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(ids) + "\n")


def test_ids_are_looked_up_in_state_not_in_the_target(spark, tmp):
    src, dst, ck = (os.path.join(tmp, n) for n in ("in", "out", "ck"))
    write_ids(src, "a.csv", "A111111", "111111", "A222222")
    R.stream_ids(spark, src, dst, ck).awaitTermination()
    write_ids(src, "b.csv", "A222222", "A333333")
    query = R.stream_ids(spark, src, dst, ck)
    query.awaitTermination()
    progress = query.lastProgress
    assert progress.stateOperators[0].numRowsTotal == 3 and len(progress.sources) == 1
    assert dst not in query._jsq.explainInternal(True).replace(f"path={dst}", "").split("== Physical Plan ==")[-1]
    assert sorted(r.accession for r in spark.read.parquet(dst).collect()) == ["A111111", "A222222", "A333333"]
    # the last batch is replayed after a crash before its commit: nothing is added twice
    last = max(int(n) for n in os.listdir(os.path.join(ck, "commits")) if n.isdigit())
    for n in (f"{last}", f".{last}.crc"):
        if os.path.exists(os.path.join(ck, "commits", n)):
            os.remove(os.path.join(ck, "commits", n))
    R.stream_ids(spark, src, dst, ck).awaitTermination()
    assert sorted(r.accession for r in spark.read.parquet(dst).collect()) == ["A111111", "A222222", "A333333"]
    with pytest.raises(ValueError):
        R.stream_ids(spark, src, dst, os.path.join(tmp, "other"))


def test_ids_known_elsewhere_are_left_out(spark, tmp):
    src, dst, ck = (os.path.join(tmp, n) for n in ("in", "out", "ck"))
    write_ids(src, "a.csv", "A111111", "A222222")
    seen = []
    known = spark.createDataFrame([("A111111",)], "accession string")
    R.stream_ids(spark, src, dst, ck, known=known, run_post_batch=seen.append).awaitTermination()
    assert [r.accession for r in spark.read.parquet(dst).collect()] == ["A222222"]
    for _ in range(100):
        if seen:
            break
        import time
        time.sleep(0.1)
    assert seen == [0]


def test_retained_log_keeps_late_rows_of_its_days(spark, tmp):
    src, ck = os.path.join(tmp, "in"), os.path.join(tmp, "ck")
    log = VersionedTable(spark, os.path.join(tmp, "log"))
    schema = "entity string, loaded timestamp"

    def arrive(*days):
        spark.createDataFrame([(e, D(2024, 3, 1) + dt.timedelta(days=d)) for e, d in days], schema).coalesce(1).write.mode("append").parquet(src)

    def run(day):
        R.stream_retained_log(spark, src, log, ck, spark.read.parquet(src).schema, dt.date(2024, 3, 1) + dt.timedelta(days=day)).awaitTermination()
        return sorted((r.entity, (r.loaded - D(2024, 3, 1)).days) for r in log.read().collect())

    arrive(("a", 0), ("a", 0), ("b", 1), ("old", -16))
    assert run(1) == [("a", 0), ("b", 1)]
    arrive(("a", 0), ("late", -13), ("a", 10))           # a repeat, and a late row inside the span
    assert run(2) == [("a", 0), ("a", 10), ("b", 1), ("late", -13)]
    arrive(("c", 11), ("a", 0))
    assert run(15) == [("a", 0), ("a", 10), ("b", 1), ("c", 11)]  # day -13 is over
    arrive(("late", 0), ("d", 20), ("b", 1))
    assert run(16) == [("a", 10), ("b", 1), ("c", 11), ("d", 20)]  # day 0 too
    assert run(16) == [("a", 10), ("b", 1), ("c", 11), ("d", 20)]

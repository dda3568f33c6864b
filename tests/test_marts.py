"""T4: mart rules on hand-built reference-shaped rows."""

import datetime as dt

from pyspark.sql import functions as F

from martforge.plans import ai_use as AI
from martforge.plans import conclusions as C
from martforge.plans import overdue as OV
from martforge.plans import registry as RG
from martforge.plans.operational import active_benefits

D = dt.datetime
SERIES_COLS = ["modality", "study_uid", "accession_number", "doctor_id", "diagnostic_code", "describe_start",
               "conclusion_time", "has_ai", "norma_value", "model_id", "series_iuid", "service_name",
               "ai_interaction", "first_ai_open", "mins_to_first_ai", "ai_before_conclusion",
               "active_in_window", "view_in_window", "enlarge_in_window", "passive_in_window",
               "outside_ai_interaction", "outside_active_cnt", "outside_view_cnt", "outside_passive_cnt",
               "has_action_outside", "methods_used"] + [f"cnt_{n}" for n, _ in AI.PROC_COUNTERS] + \
              [f"outside_{n}" for n, _ in AI.PROC_COUNTERS]
SCHEMA = ("modality string, study_uid string, accession_number long, doctor_id long, diagnostic_code long, "
          "describe_start timestamp_ntz, conclusion_time timestamp_ntz, has_ai int, norma_value string, "
          "model_id long, series_iuid string, service_name string, ai_interaction string, "
          "first_ai_open timestamp_ntz, mins_to_first_ai long, ai_before_conclusion int, "
          "active_in_window long, view_in_window long, enlarge_in_window long, passive_in_window long, "
          "outside_ai_interaction string, outside_active_cnt long, outside_view_cnt long, "
          "outside_passive_cnt long, has_action_outside int, methods_used string, "
          + ", ".join(f"{c} long" for c in SERIES_COLS[26:]))


def series_row(study, model, series, first, counts, outside_passive, methods, norma="1.0"):
    start, concl = D(2024, 1, 1, 10, 0, 0), D(2024, 1, 1, 10, 30, 0)
    zeros = [0] * 12
    return (("CT", study, 1, 7, 44, start, concl, 1, norma, model, series, "m", "active", first,
             None, 0) + tuple(counts) + ("none", 0, 0, outside_passive, 0, methods) + tuple(zeros))


def test_merge_multi_series_and_roll_up(spark):
    rows = [
        # one model, two series: counters summed, NULLs count as 0, earliest first open
        series_row("s1", 1003, "b", D(2024, 1, 1, 10, 1, 31), (1, None, 0, 0), 0, "SCROLL"),
        series_row("s1", 1003, "a", D(2024, 1, 1, 10, 3, 0), (0, 0, 0, 2), 1, "AUTO_LOAD, SCROLL"),
        # single series keeps its row (NULL counter stays NULL)
        series_row("s1", 1004, "c", None, (None, 0, 0, 0), 0, None),
        # the NULL model is a group of its own
        series_row("s2", None, None, None, (None, None, None, None), 0, None, norma=None),
    ]
    series = spark.createDataFrame(rows, SCHEMA)
    tariffs = spark.createDataFrame([(1003, 1.5, 2.0)], "model_id long, tariff_current double, tariff_possible double")
    by_model = AI.ai_use_by_model(series, tariffs, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    got = {(r["study_uid"], r["model_id"]): r for r in by_model.collect()}
    m = got[("s1", 1003)]
    assert (m["active_in_window"], m["view_in_window"], m["passive_in_window"]) == (1, 0, 2)
    assert m["series_iuid"] == "a, b" and m["methods_used"] == "AUTO_LOAD, SCROLL"
    assert m["first_ai_open"] == D(2024, 1, 1, 10, 1, 31)
    assert m["mins_to_first_ai"] == 2.0          # 91 s -> 1.52 min -> half-even 2
    assert m["ai_interaction"] == "active" and m["outside_ai_interaction"] == "passive"
    assert m["tariff_current"] == 1.5 and m["norma_value"] == "1"
    single = got[("s1", 1004)]
    assert single["active_in_window"] is None and single["tariff_current"] is None
    assert got[("s2", None)]["norma_value"] is None
    # The study roll-up sums over models (NULL as 0)
    by_study = {r["study_uid"]: r for r in AI.ai_use_by_study(by_model).collect()}
    s1 = by_study["s1"]
    assert (s1["active_in_window"], s1["passive_in_window"]) == (1, 2)
    assert s1["ai_interaction"] == "active" and s1["methods_used"] == "AUTO_LOAD, SCROLL"
    assert by_study["s2"]["active_in_window"] == 0 and by_study["s2"]["ai_interaction"] == "no_ai"
    # total counters are preserved by the merge
    total = lambda df, c: sum((r[c] or 0) for r in df.collect())
    for c in AI.COUNT_COLS:
        assert total(series, c) == total(by_model, c) == total(AI.ai_use_by_study(by_model), c)


def test_ai_use_load_cuts_lineage_and_is_idempotent(spark, tmp):
    import os

    from martforge.plans import catalog as C

    sf = "/root/testdata/sf0.001"
    t, cfg, names = C._ai_inputs(spark, sf)
    tariffs = spark.createDataFrame(C.MODEL_TARIFFS, "model_id long, tariff_current double, tariff_possible double")
    bm, bs = os.path.join(tmp, "by_model"), os.path.join(tmp, "by_study")
    args = (t.results, t.reports, t.ai_log, cfg, names, tariffs, C.AI_FROM, C.AI_TO, bm, bs,
            C.AI_EXCLUDED_CODES, C.AI_MIN_START)
    AI.load_ai_use(*args, loaded_at=D(2024, 1, 1))
    AI.load_ai_use(*args, loaded_at=D(2024, 1, 2))      # a rerun replaces, never duplicates
    stored_model = spark.read.parquet(bm)
    stored_study = spark.read.parquet(bs)
    assert stored_model.count() == C.QUERIES["ai_use_by_model"](spark, sf).count()
    assert stored_study.select("study_uid").distinct().count() == stored_study.count()
    assert {r[0] for r in stored_study.select("loaded_at").distinct().collect()} == {D(2024, 1, 2)}
    want = C.QUERIES["ai_use_by_study"](spark, sf)
    assert stored_study.drop("loaded_at").exceptAll(want).count() == 0


RESULT = ("accession_number long, study_uid string, line_no int, emp_id long, emp_fio string, describe_unit_id string, "
          "diagnostic_code long, diagnostic_name string, type_code int, payment_source string, device_type string, "
          "doc_created timestamp_ntz, conduct_date timestamp_ntz, describe_start timestamp_ntz, conduct_mo_name string, "
          "conduct_mu_name string, conduct_district_name string, patient_gender string, assignment_status string")
REPORT = "app_source string, raw_data string, computed_data string"
LOADED = D(2024, 7, 3, 3)


def result(accession, created, status="Выполнено", mo="a", kind=1):
    return (accession, str(accession), 1, 5, "врач", "u", 44, "снимок", kind, "ОМС", "O", created,
            created - dt.timedelta(hours=2), created - dt.timedelta(minutes=10), mo, None, "c", "Ж", status)


def test_describe_time_counts_finished_assignments_only(spark):
    at = D(2024, 7, 1, 10)
    rows = [result(1, at), result(2, at, "В работе"), result(3, at, None), result(4, at)]
    got = C.describe_time_daily(spark.createDataFrame(rows, RESULT), spark.createDataFrame([], REPORT),
                                dt.date(2024, 7, 2), 5, loaded_at=LOADED).collect()
    assert [(r.n_studies, r.avg_time, r.diagnostic_name, r.load_datetime) for r in got] == [(2, "0:10:00", "снимок", LOADED)]


def test_distinct_conclusions_show_local_time_and_filter_by_three_hours(spark):
    # in 2012 the local clock was four hours ahead: the day shown is the next one, the filter's day is not
    rows = [result(1, D(2012, 6, 1, 20, 30)), result(2, D(2012, 6, 1, 21, 30))]
    got = C.distinct_conclusions(spark.createDataFrame(rows, RESULT), None, dt.date(2012, 6, 1), 0, loaded_at=LOADED).collect()
    assert [(r.accession_number, r.doc_date, r.assignment_result_doc_created_date_plus_3h) for r in got] == [
        (1, dt.date(2012, 6, 2), D(2012, 6, 2, 0, 30))]


def test_unit_summary_keeps_organisations_apart(spark):
    at = D(2024, 7, 1, 10)
    exams = spark.createDataFrame([], "accession_number long, patient_age long")
    rows = [result(1, at), result(2, at), result(3, at, mo="b"), result(4, at, mo=None)]
    got = C.unit_summary(spark.createDataFrame(rows, RESULT), exams, spark.createDataFrame([], REPORT),
                         dt.date(2024, 7, 2), 5, loaded_at=LOADED).collect()
    assert {(r.conduct_mo_name, r.cnt) for r in got} == {("a", 2), ("b", 1), (None, 1)}


def test_benefits_need_code_patient_and_record_active(spark):
    rows = [("940", "11", "4"), ("941", "11", "4"), ("999", "11", "4"), ("940", "12", "4"), ("940", "11", "3"),
            ("940", None, "4"), ("940", "11", None), (None, "11", "4")]
    got = active_benefits(spark.createDataFrame(rows, "benefit_code string, patient_status_id string, status_llo_id string"))
    assert sorted(map(tuple, got.collect())) == [("940", "11", "4"), ("941", "11", "4")]


def test_overdue_line_takes_the_closest_event_of_its_accession(spark):
    at = D(2024, 7, 1, 10)  # 13:00 local
    lines = [(1, 1, at, "p1", 7), (1, 2, at + dt.timedelta(hours=5), "p1", 8)]
    rows = [result(a, t)[:2] + (n,) + result(a, t)[3:12] + (t - dt.timedelta(days=2),) + result(a, t)[13:] + (p, j)
            for a, n, t, p, j in lines]
    results = spark.createDataFrame(rows, RESULT + ", patient_key string, job_id long")
    # job 7's only event is far away; job 8's event starts RUNNING 10 minutes after line 1, not line 2
    events = spark.createDataFrame([(70, "p1", 7), (80, "p1", 8), (90, "p2", 8)], "event_id long, patient_id string, job_id long")
    changes = spark.createDataFrame(
        [(70, D(2024, 7, 1, 2), "RUNNING"), (80, D(2024, 7, 1, 10, 10), "RUNNING"), (80, D(2024, 7, 1, 11), "DEFERRED"),
         (90, at, "RUNNING")], "event_id long, change_time timestamp_ntz, status string")
    pins = spark.createDataFrame([], "accession_number long, task_pin_end_date timestamp_ntz")
    got = OV.overdue_monitoring(results, pins, events, changes, dt.date(2024, 7, 3), 10, loaded_at=LOADED).collect()
    assert [(r.event_id, r.assignment_result_doc_created_date, r.status_chain, r.cnt_deferred) for r in got] == [
        ("80", D(2024, 7, 1, 13), "RUNNING -> DEFERRED", 1)]


def test_registry_keeps_the_requests_own_documents(spark):
    html = "".join(f'<a href="{u}">' for u in (
        "https://files.test/docs/5/a.pdf?x=1&amp;y=2", "https://files.test/docs/5/a.pdf?x=1&amp;y=2",
        "https://files.test/docs/55/b.pdf", "https://other.test/docs/5/c.pdf", "https://files.test/docs/5/d.pdf"))
    zips = "<span class='z'>one &amp; <b>two</b></span><SPAN></SPAN><span>three</span>"
    row = lambda seq, code, request, docs: (
        seq, code, request, "<b>1</b>", "s", None, "o", "r", "t", 3, "2ч", " новая ", zips, docs, html)
    rows = spark.createDataFrame(
        [row(1, "A", "5", "x"), row(2, "A", "6", "x"), row(3, "B", "5", ""), row(4, "C", None, "x")],
        "seq long, code string, request_id string, created_at string, medservice_name string, source_name string, "
        "organization_fmt string, responsible_name string, work_type_name string, load_rate long, sla_time string, "
        "status_text string, orthanc_html string, doc_list string, detail_html string")
    dental = spark.createDataFrame([("B",), (None,)], "id string")
    got = {r.id: r for r in RG.web_registry(rows, dental, "https://files.test/", loaded_at=LOADED).collect()}
    first, own = "https://files.test/docs/5/a.pdf?x=1&y=2", "https://files.test/docs/5/d.pdf"
    assert got["A"].documents_pdf == f"{first}; {own}" and got["A"].documents_dicom == "one & two; three"
    assert got["B"].documents_pdf == "" and (got["B"].stomatology, got["A"].stomatology) == ("Да", "Нет")
    assert got["C"].documents_pdf == f"{first}; https://files.test/docs/55/b.pdf; {own}"
    assert len(got) == 3 and got["A"].load_date == "2024-07-03 03:00:00" and got["A"].source == ""


def test_ai_use_of_one_unit(spark):
    """The unit bound to M10 and M13 keeps exactly the studies that it described; the window reaches the scan."""
    from martforge.plans import catalog as C
    t, cfg, names = C._ai_inputs(spark, "/root/testdata/sf0.001")
    units = [r[0] for r in t.results.select("describe_unit_id").distinct().orderBy("describe_unit_id").limit(2).collect()]
    for unit in units:
        own = t.results.where(F.col("describe_unit_id") == unit)
        args = (C.AI_FROM, C.AI_TO, C.AI_EXCLUDED_CODES, C.AI_MIN_START)
        got = AI.ai_use_series(t.results, t.reports, t.ai_log, cfg, names, *args, unit_id=unit)
        want = AI.ai_use_series(own, t.reports, t.ai_log, cfg, names, *args)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []
        use = AI.model_usage_daily(t.results, t.ai_log, cfg, C.AI_FROM, C.AI_TO, unit_id=unit)
        assert sorted(use.collect()) == sorted(AI.model_usage_daily(own, t.ai_log, cfg, C.AI_FROM, C.AI_TO).collect())
    plan = use._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in plan

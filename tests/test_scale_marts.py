"""Wide rows are dealt as few times as their mart needs: exchanges of the plans without broadcast joins."""

import pytest

from martforge.plans import catalog as C
from martforge.plans import load_queries as LQ

SF = "/root/testdata/sf0.001"
PLAIN = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture()
def plain(spark):
    old = {k: spark.conf.get(k) for k in PLAIN}
    for k, v in PLAIN.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def exchanges(df):
    """(text, names of the columns) of each shuffle in the plan of ``df``."""
    def walk(node):
        if node.nodeName() == "Exchange":
            found.append((node.simpleString(1000), {a.split("#")[0] for a in node.output().mkString("|").split("|")}))
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))
    found = []
    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.mark.parametrize("name", ["ai_use_series", "ai_use_by_model", "ai_use_by_study"])
def test_ai_use_is_dealt_by_study_alone(plain, name):
    by = [text.split("(", 1)[1] for text, _ in exchanges(C.QUERIES[name](plain, SF))]
    assert by and not [t for t in by if t.startswith("modality") or "model_id" in t.split(")")[0]]
    # reports are grouped by study and series first; base, base for the log, log and reports lie by study
    assert len(by) <= 6


def test_benefit_cohort_deals_lines_once_before_it_knows_the_benefit(plain):
    lines = [c for _, c in exchanges(C.QUERIES["benefit_cohort"](plain, SF)) if "diagnostic_name" in c]
    assert len([c for c in lines if "llo_benefit_status" not in c]) == 1


def test_overdue_lines_are_dealt_for_their_pick_and_its_event(plain):
    assert len([c for _, c in exchanges(C.QUERIES["overdue_monitoring"](plain, SF)) if "diagnostic_name" in c]) == 2


def test_unit_summary_deals_lines_by_accession_and_by_group(plain):
    assert len([c for _, c in exchanges(C.QUERIES["unit_summary"](plain, SF)) if "conduct_mo_name" in c]) == 2


def test_typed_reports_parses_before_it_orders(spark):
    plan = LQ.q_typed_reports(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "get_json_object" not in plan and "ready" in plan


def test_benefit_cohort_looks_benefits_up_before_the_lines_are_dealt(plain):
    """The lookup's wide tree of days is stored away, and the routes' pre-filter deals no line a second time."""
    found = [c for _, c in exchanges(C.QUERIES["benefit_cohort"](plain, SF))]
    assert not [c for c in found if "level" in c]
    assert len([c for c in found if "line_no" in c and "llo_benefit_status" not in c]) == 1


def test_benefit_cohort_with_units_that_repeat(spark):
    """One row per accession: its first line, with the smallest name of either unit, a name before none."""
    import datetime as dt

    from martforge.plans import operational as OP
    at = dt.datetime(2001, 5, 5, 10)
    results = spark.createDataFrame(
        [(1, "s1", n, e, "u1", 9, n, "p", "CT", at, at, at, "name", "Z", "mo", "mu") for n, e in ((2, 1), (1, 2), (1, 1))]
        + [(2, "s2", 1, 1, "none", 9, 1, "p", "CT", at, at, at, "name", "Z", "mo", "mu")],
        "accession_number long, study_uid string, line_no long, emp_id long, describe_unit_id string, diagnostic_code long, "
        "type_code long, payment_source string, device_type string, doc_created timestamp_ntz, conduct_date timestamp_ntz, "
        "describe_start timestamp_ntz, diagnostic_name string, diag_code string, conduct_mo_name string, conduct_mu_name string")
    exams = spark.createDataFrame([(1, 40, 7, "u2"), (2, 50, 7, "u1")],
                                  "accession_number long, patient_age long, patient_id long, assignment_mu_id string")
    units = spark.createDataFrame([("u1", "b"), ("u1", None), ("u1", "a"), ("u2", "d"), ("u2", "c")], "unit_id string, unit_name string")
    benefits = spark.createDataFrame([(7, dt.date(2001, 1, 1), None, "held", "940", "11", "4")],
                                     "patient_id long, start_date date, end_date date, benefit_name string, benefit_code string, "
                                     "patient_status_id string, status_llo_id string")
    reports = spark.createDataFrame([], "report_key long, app_source string, raw_data string, computed_data string")
    pins = spark.createDataFrame([], "accession_number long, task_pin_status string, task_pin_end_date timestamp_ntz, pin_id long")
    routes = spark.createDataFrame([(1, "job b"), (1, "job a"), (3, "job c")], "eris_id long, assignment_doctor_job_name string")
    out = OP.benefit_cohort(results, exams, reports, units, benefits, pins, dt.date(2001, 1, 1), dt.date(2002, 1, 1),
                            routes=routes, loaded_at=at).collect()
    got = {r.accession_number: (r.assessment_result_type_code, r.lpu_short_name_by_lpu_id, r.lpu_short_name_by_assignment_mu_id,
                                r.llo_benefit_status, r.assignment_doctor_job_name) for r in out}
    assert len(out) == 2 and got == {1: (1, "a", "c", "held", "job a"), 2: (1, None, "a", "held", None)}

"""Undescribed-study queue (M8): examinations not yet done, enriched with the
latest describing doctor, pin state, trauma membership, the latest queue
status (DEL_ASSIGNMENT first), the doctor of the latest task list and the
benefit held on the conduct day; devices seen in trauma routes recently are
excluded by (device, procedure) pair, and trauma / withdrawn rows dropped.

Deviation: when a doctor job maps to several employee names, the smallest
name is used (the reference takes whichever row its final dedupe meets).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.time import ntz, open_end
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.operators import windows as W
from martforge.plans.operational import BENEFIT_CODES, IN_PIN, NOT_IN_PIN, active_benefits

# The mart's columns that come from the examination as they are, in the mart's order.
EXAMINATION = [
    "assignment_conduct_id", "conduct_date", "conduct_doc_id", "conduct_doc_cct", "conduct_doc_author_job_execution_id",
    "conduct_doc_author_id", "conduct_doc_author_fio", "conduct_mu_id", "conduct_mo_id", "conduct_mu_name",
    "conduct_mo_name", "district_short_name", "assignment_id", "assignment_status", "assignment_mu_id",
    "assignment_mo_id", "assignment_mu_name", "assignment_mo_name", "research_id", "research_name",
    "research_subtype_id", "research_subtype_name", "research_type_id", "research_type", "research_kind_id",
    "research_kind", "device_type", "body_part", "diagnosis_code", "patient_id", "patient_birth_date", "patient_age",
    "patient_gender", "technician_job_execution_id", "technician_id", "technician_fio", "payment_source",
    "accession_number", "ae_title", "equipment_result_date", "study_uid", "url", "is_contrast", "dose_msv",
    "dose_micro_sv", "model_name",
]
TRAUMA, NOT_TRAUMA = "Травма", "Не травма"
DEL_ASSIGNMENT = "DEL_ASSIGNMENT"
# Procedures that are never excluded by the trauma-device rule.
TRAUMA_EXEMPT_RESEARCH_IDS = (33, 427, 34)


def staff_names(doctors: DataFrame, employees: DataFrame, since: dt.date) -> DataFrame:
    """doctor_id -> employee name through the temporal overlap of the doctor
    job's end with the employee record's validity (J12)."""
    mei = (employees.where(F.col("edate") >= F.lit(since))
           .groupBy("medical_employee_id", "medical_employee_fio_obf", "cur")
           .agg(F.min("sdate").alias("mei_sdate"), F.max("edate").alias("mei_edate")))
    dd = doctors.where(F.col("edate") >= F.lit(since)).select(
        "doctor_id", "medical_employee_id", open_end("edate").alias("doc_edate"))
    both = J.overlap(dd, mei, "medical_employee_id", "doc_edate", "mei_sdate", "mei_edate")
    return both.groupBy("doctor_id").agg(F.min("medical_employee_fio_obf").alias("fio"))


def undescribed_queue(examinations: DataFrame, results: DataFrame, pin_tasks: DataFrame, trauma: DataFrame,
                      undescribed: DataFrame, task_lists: DataFrame, doctors: DataFrame, employees: DataFrame,
                      benefits: DataFrame, since_date: dt.date, as_of: dt.date, done_status: str,
                      trauma_days: int = 14, exempt=TRAUMA_EXEMPT_RESEARCH_IDS,
                      staff_since: dt.date = dt.date(2023, 1, 1), benefit_codes=BENEFIT_CODES, *,
                      loaded_at: dt.datetime) -> DataFrame:
    """M8: one row per undescribed accession, the 59 columns of the mart."""
    described = W.latest(results.where(F.col("accession_number").isNotNull()), "accession_number", "doc_created",
                         tie=["emp_id", "line_no", "diagnostic_code"]) \
        .select("accession_number", F.col("emp_fio").alias("eris_result_fio"))
    active = pin_tasks.where(F.col("task_pin_end_date").isNull() & F.col("accession_number").isNotNull())
    last_pin = W.latest(pin_tasks.where(F.col("task_pin_end_date").isNotNull() & F.col("accession_number").isNotNull()),
                        "accession_number", "task_pin_end_date", tie=["task_pin_status", "pin_id"]) \
        .select("accession_number", "task_pin_status", "task_pin_end_date")
    status = W.latest_priority(undescribed.where(F.col("accession_number").isNotNull()), "accession_number",
                               F.col("action") == DEL_ASSIGNMENT, "create_date",
                               tie=["status", "reading_type_code", "action", "cito"]) \
        .select("accession_number", F.col("status").alias("undescr_status"),
                F.col("reading_type_code").alias("undescr_reading_type"),
                F.col("action").alias("undescr_action"), F.col("cito").alias("undescr_cito"))
    # latest task list per accession through the assignment -> accession bridge
    bridge = examinations.select("assignment_id", "accession_number")
    tasks = J.bridge(task_lists, bridge, "assignment_id", "accession_number") \
        .where(F.col("accession_number").isNotNull())
    latest_task = W.limit_by(tasks, "accession_number",
                             [F.col("personal_task_list_updated").desc_nulls_last(), "job_execution_id"])
    task_fio = latest_task.join(staff_names(doctors, employees, staff_since),
                                F.col("job_execution_id") == F.col("doctor_id"), "left") \
        .select("accession_number", F.col("fio").alias("task_list_fio"))
    # (device, procedure) pairs seen in trauma routes in the last days
    recent = trauma.where(F.to_date("assignment_signed_date") >= F.lit(as_of - dt.timedelta(days=trauma_days)))
    pairs = (recent.where(F.col("ae_title").isNotNull()).select("accession_number", "ae_title")
             .join(examinations.select("accession_number", "research_id"), "accession_number")
             .where(F.col("research_id").isNotNull() & ~F.col("research_id").isin(list(exempt)))
             .select("ae_title", "research_id").distinct())

    e = examinations.where((F.to_date("conduct_date") >= F.lit(since_date)) & F.col("ae_title").isNotNull()
                           & F.col("accession_number").isNotNull() & (F.col("assignment_status") != done_status))
    e = J.anti_pair(e, pairs, "ae_title", "research_id")
    e = e.join(described, "accession_number", "left")
    e = J.membership(e, active, "accession_number", "pin_status", IN_PIN, NOT_IN_PIN)
    e = e.join(last_pin, "accession_number", "left")
    e = J.membership(e, trauma.where(F.col("accession_number").isNotNull()), "accession_number",
                     "is_trauma_exam", TRAUMA, NOT_TRAUMA)
    e = e.join(status, "accession_number", "left").join(task_fio, "accession_number", "left")
    e = J.interval_winner(e.withColumn("conduct_day", F.to_date("conduct_date")),
                          active_benefits(benefits, benefit_codes),
                          "patient_id", "conduct_day", start="start_date", end="end_date",
                          name="benefit_name", out="llo_benefit_status")
    e = W.first_row(e, "accession_number", "conduct_date",
                    tie=["eris_result_fio", "task_list_fio", "undescr_status"])
    e = Fl.drop_flagged(e, "is_trauma_exam", "undescr_action", DEL_ASSIGNMENT, TRAUMA)
    out = e.select(*EXAMINATION, "eris_result_fio", "pin_status", "task_pin_end_date", "task_pin_status",
                   "is_trauma_exam", "undescr_status", "undescr_reading_type", "undescr_action", "undescr_cito",
                   "task_list_fio", "llo_benefit_status")
    # batch-wide load stamp: the newest conduct time of the extract, on every row (F16)
    return Fl.stamp(Fl.stamp_batch_max(out, "conduct_date", "meta_load_date"), load_datetime=ntz(loaded_at))

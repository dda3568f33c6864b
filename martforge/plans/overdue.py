"""Overdue monitoring (M6): conclusions documented 24 h or more after the
examination (or after the pin that released it), each with the clinical
event whose first RUNNING status is closest to the document time, and that
event's status chain. An accession's events are those of the patient and
doctor job of any of its overdue lines, and each line competes for all of them.

The reference pairs every result row with every event of its accession and
keeps the closest pair. Here a line's accession and document time meet the
distinct (patient, job) pairs of its accession that have an event - one or two
in practice - and the closest event comes from
:func:`martforge.operators.joins.nearest_by_time` (bucketed as-of search). The
whole lines are dealt once, by accession, for the join with their event and the
final pick, an aggregate (``min_by`` over an ordering struct).

Deviation: the status chain and the DEFERRED count are per event (its own
status changes); the reference repeats them once per joined result line.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions.time import ntz
from martforge.functions import hhmmss, hours_floor, plus_hours, secs, sla_bucket, to_local
from martforge.operators import aggregates as A
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.session import stored
from martforge.sources.readers import in_window

RUNNING, DEFERRED = "RUNNING", "DEFERRED"
EVENT_PAD_DAYS = 14
SHOWN = ["patient_key", "emp_id", "emp_fio", "payment_source", "device_type", "diagnostic_code", "diagnostic_name",
         "type_code", "conduct_mo_name", "conduct_mu_name", "describe_unit_id", "conduct_date", "effective_start_date",
         "max_pin_date", "doc_local", "hours_overdue"]
BASE_TIE = ["line_no", "emp_id", "diagnostic_code", "payment_source", "device_type", "conduct_date"]


def event_stats(changes: DataFrame) -> DataFrame:
    """Per event: status chain by time (then status), DEFERRED count, first and
    last RUNNING time shifted +3 h (A8, A10)."""
    st, t = F.col("status"), F.col("change_time")
    return changes.groupBy("event_id").agg(
        A.chain("change_time", "status").alias("status_chain"),
        A.count_where(st == DEFERRED).alias("cnt_deferred"),
        plus_hours(A.min_where(t, st == RUNNING), 3).alias("first_running"),
        plus_hours(A.max_where(t, st == RUNNING), 3).alias("last_running"))


def overdue_monitoring(results: DataFrame, pin_tasks: DataFrame, clinical_events: DataFrame,
                       status_changes: DataFrame, as_of: dt.date, days: int,
                       unit_id: str | None = None, bucket_seconds: int = 6 * 3600, *,
                       loaded_at: dt.datetime) -> DataFrame:
    pins = (Fl.non_empty(pin_tasks, "accession_number").groupBy("accession_number")
            .agg(to_local(F.max("task_pin_end_date")).alias("max_pin_date")))
    t2 = Fl.non_empty(results, "accession_number")
    if unit_id is not None:
        t2 = t2.where(F.col("describe_unit_id") == unit_id)
    t2 = in_window(t2, "doc_created", as_of, days, local=True)
    b = t2.join(pins, "accession_number", "left")
    start = F.coalesce(F.col("max_pin_date"), to_local("conduct_date"))
    doc = to_local("doc_created")
    b = (b.withColumns({"effective_start_date": start, "doc_local": doc,
                        "hours_overdue": hours_floor(start, doc)})
         .where(F.col("hours_overdue") >= 24)
         .withColumn("key_p", F.col("patient_key").cast("string"))
         .withColumn("key_j", F.col("job_id").cast("string")))
    # the overdue lines, read by their accession's keys, by the search and by the pick
    b = stored(b.select("accession_number", "key_p", "key_j", *dict.fromkeys([*SHOWN, *BASE_TIE])), "overdue-lines")

    # events with a status change in the padded window (J9 semi pre-filter)
    lo = dt.datetime.combine(as_of - dt.timedelta(days=days + EVENT_PAD_DAYS), dt.time())
    hi = dt.datetime.combine(as_of, dt.time(23, 59, 59))
    ch = status_changes.where(F.col("change_time").between(ntz(lo),
                                                           ntz(hi)))
    ev = J.semi(clinical_events, ch.select("event_id").distinct(), "event_id")
    ev = ev.select(F.col("patient_id").cast("string").alias("key_p"), F.col("job_id").cast("string").alias("key_j"),
                   "event_id").join(event_stats(ch), "event_id")
    ev = stored(ev, "overdue-events")  # three readers below

    keys = ["key_p", "key_j"]
    # the search knows of a line its accession and document time, and only of lines whose pair has an event at all
    owners = J.semi(b.select("accession_number", F.struct(*keys).alias("_pair")).distinct(),
                    ev.select(F.struct(*keys).alias("_pair")).distinct(), "_pair")
    owners = owners.select(F.col("accession_number").alias("_acc"), "_pair.*").where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    times = b.select(F.col("accession_number").alias("_acc"), "doc_local").distinct()
    asked = times.join(owners, "_acc")
    # distance 0: events without a RUNNING status (smallest id per key)
    zero = ev.where(F.col("first_running").isNull()).groupBy(*keys).agg(F.min("event_id").alias("zero_id"))
    # otherwise the event whose first RUNNING is nearest to the document time
    near = J.nearest_by_time(asked, ev.where(F.col("first_running").isNotNull()), keys, "doc_local", "first_running",
                             "event_id", bucket_seconds, carried=["_acc"])
    pick = F.least(F.when(F.col("zero_id").isNotNull(), F.struct(F.lit(0).cast("long").alias("d"),
                                                                  F.col("zero_id").alias("id"))),
                   F.when(F.col("near_id").isNotNull(), F.struct(F.col("near_dist_s").alias("d"),
                                                                  F.col("near_id").alias("id"))))
    near = near.join(zero, keys, "left").withColumn("_pick", pick)
    near = near.groupBy("_acc", F.col("doc_local").alias("_doc")).agg(F.min("_pick").alias("_pick"))
    near = near.where(F.col("_pick").isNotNull())
    # lines lie by accession for the join and for the pick: the document time is compared, not dealt by
    c = b.drop(*keys).join(near, (b["accession_number"] == near["_acc"]) & J.same_within(b["doc_local"], near["_doc"]), "left")
    c = c.withColumns({"_no_event": F.when(F.col("_pick").isNull(), 1).otherwise(0), "_d": F.col("_pick.d"),
                       "_eid": F.col("_pick.id")})
    order = F.struct("_no_event", "_d", "_eid", *BASE_TIE)
    w = c.groupBy("accession_number").agg(F.min_by(F.struct(*SHOWN, "_eid"), order).alias("w")).select("accession_number", "w.*")
    stats = ev.select("event_id", "status_chain", "cnt_deferred", "first_running", "last_running").distinct()
    w = w.join(stats, w["_eid"] == stats["event_id"], "left")
    span = secs("first_running", "last_running")
    return w.select(
        "accession_number", F.col("patient_key").alias("patient_id"),
        F.col("emp_id").cast("string").alias("assignment_result_emp_id"),
        F.col("emp_fio").alias("assignment_result_emp_fio"), "payment_source", "device_type",
        F.col("diagnostic_code").cast("string").alias("diagnostic_code"), "diagnostic_name",
        F.col("type_code").alias("assessment_result_type_code"), "conduct_mo_name", "conduct_mu_name",
        F.col("describe_unit_id").alias("assignment_describe_mu_id"),
        to_local("conduct_date").alias("conduct_date"), "effective_start_date",
        F.when(F.col("max_pin_date").isNotNull(), 1).otherwise(0).alias("has_pin"),
        F.col("doc_local").alias("assignment_result_doc_created_date"), "hours_overdue",
        sla_bucket("hours_overdue").alias("time_interval"),
        F.col("_eid").cast("string").alias("event_id"), "first_running", "last_running",
        F.when(F.col("first_running").isNotNull() & F.col("last_running").isNotNull(), hhmmss(span))
         .alias("deferred_time_hhmmss"),
        "status_chain", F.coalesce(F.col("cnt_deferred"), F.lit(0)).alias("cnt_deferred"),
        ntz(loaded_at).alias("load_datetime"))

"""AI-use marts: per study x series (M10), per study x model with tariffs
(M11), per study (M12), daily model usage (M13) and the duplicate audit /
keep-latest repair used after their loads (M20).

All modalities run in one pass: the modality configuration is a small,
bounded dimension (device type -> AI-log modalities) joined by broadcast,
instead of one query per modality glued with UNION ALL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.functions import (flag_text, minute_boundaries,
                                 minutes_elapsed, parse_ts, plus_hours, split_pick_int)
from martforge.functions.time import ntz
from martforge.operators import aggregates as A
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.session import stored
from martforge.sources.readers import in_window

# The pad of the AI-use window and the log scan buffer (days).
WINDOW_PAD_MINUTES = 5
LOG_DAYS_BEFORE, LOG_DAYS_AFTER = 7, 30

# Access methods and procedures that count as active / viewing /
# enlarging / passive use of an AI result.
ACTIVE_METHODS = ("MANUAL_LOAD", "SCROLL")
PASSIVE_METHODS = ("AUTO_LOAD", "AUTO_GRID")
VIEW_PROCS = ("AI_VIEW_START", "AI_VIEW_END")
OUTSIDE_VIEW_PROCS = ("AI_VIEW_START", "AI_VIEW_END", "AI_VIEW_ENLARGE")
ENLARGE_PROC = "AI_VIEW_ENLARGE"
# Per-procedure counters (column suffix, procedure).
PROC_COUNTERS = (
    ("auto_load", "AI_AUTO_LOAD"),
    ("auto_grid", "AI_AUTO_GRID"),
    ("manual_load", "AI_MANUAL_LOAD"),
    ("view_start", "AI_VIEW_START"),
    ("view_end", "AI_VIEW_END"),
    ("enlarge", "AI_VIEW_ENLARGE"),
)

# counter name -> (inside window?, column, accepted values)
COUNTERS: list[tuple[str, bool | None, str | None, tuple]] = [
    ("active_in_window", True, "access_method", ACTIVE_METHODS),
    ("view_in_window", True, "procedure_name", VIEW_PROCS),
    ("enlarge_in_window", True, "procedure_name", (ENLARGE_PROC,)),
    ("passive_in_window", True, "access_method", PASSIVE_METHODS),
    ("outside_active_cnt", False, "access_method", ACTIVE_METHODS),
    ("outside_view_cnt", False, "procedure_name", OUTSIDE_VIEW_PROCS),
    ("outside_passive_cnt", False, "access_method", PASSIVE_METHODS),
    ("actions_outside", False, None, ()),
] + [(f"cnt_{n}", True, "procedure_name", (p,)) for n, p in PROC_COUNTERS] \
  + [(f"outside_{n}", False, "procedure_name", (p,)) for n, p in PROC_COUNTERS]

COUNT_COLS = [n for n, *_ in COUNTERS if n != "actions_outside"]


def modality_config(spark: SparkSession, config: dict) -> DataFrame:
    """(device_type, modality, log_modality) rows from {device: (label, [log modalities])}."""
    rows = [(d, label, m) for d, (label, mods) in config.items() for m in mods]
    return spark.createDataFrame(rows, "device_type string, modality string, log_modality string")


def base_studies(results: DataFrame, cfg: DataFrame, date_from: dt.date, date_to: dt.date,
                 excluded_codes=(), min_describe_start: dt.datetime | None = None,
                 unit_id: str | None = None) -> DataFrame:
    """One row per (modality, study) described by ``unit_id`` (S12; None: by any unit): values at the earliest describe start (A5),
    first describe start and first conclusion; excluded procedures and early
    starts are dropped after the aggregate (F4)."""
    devices = F.broadcast(cfg.select("device_type", "modality").distinct())
    r = in_window(results, "doc_created", date_to, (date_to - date_from).days)
    r = (r if unit_id is None else r.where(F.col("describe_unit_id") == unit_id)).join(devices, "device_type")
    t = "describe_start"
    b = (r.groupBy("modality", "study_uid")
         .agg(A.value_at_first("accession_number", t, tie="accession_number").alias("accession_number"),
              A.value_at_first("emp_id", t, tie="emp_id").alias("doctor_id"),
              F.min(t).alias("describe_start"),
              F.min("doc_created").alias("conclusion_time"),
              A.value_at_first("diagnostic_code", t, tie="diagnostic_code").alias("diagnostic_code")))
    b = Fl.having_not_in(b, "diagnostic_code", excluded_codes) if excluded_codes else b
    if min_describe_start is not None:
        b = b.where(F.col("describe_start") >= ntz(min_describe_start))
    return b


def ai_results(reports: DataFrame, app_source: str = "CDS") -> DataFrame:
    """One row per (study, series) with the AI verdict and model id."""
    from martforge.plans.reports import report_fields
    r = report_fields(reports, app_source, "study_iuid", "norma", "series_iuid", "raw_model_id", "computed_model_id", "ready_text")
    model = F.when(F.col("raw_is_null"), F.col("computed_model_id")).otherwise(F.col("raw_model_id"))
    # the condition is projected once, not re-evaluated inside each aggregate
    r = r.withColumn("_ok", parse_ts("ready_text").isNotNull() & (F.trim("norma") != ""))
    ok = F.col("_ok")
    return (r.groupBy(F.col("study_iuid").alias("study_uid"), "series_iuid")
            .agg(F.min(F.when(ok, F.col("norma"))).alias("norma_value"),
                 F.min(F.when(ok, model)).alias("model_id"), F.bool_or(ok).alias("_ok"))
            .where("_ok").drop("_ok"))


def _counter(inside: Column, spec) -> Column:
    name, in_win, col, values = spec
    cond = inside if in_win else ~inside
    if col is not None:
        cond = cond & F.col(col).isin(list(values))
    return A.count_where(cond).alias(name)


def ai_actions(ai_log: DataFrame, base: DataFrame, cfg: DataFrame, date_from: dt.date,
               date_to: dt.date) -> DataFrame:
    """J13 + A7/A8/A9: log events of each base study's modality, classed as
    inside ``[describe_start - 5 min, conclusion]`` or outside; 20 counters,
    first open inside the window and the distinct access methods, in one
    aggregate per (modality, study, series)."""
    mods = F.broadcast(cfg.select("modality", F.col("log_modality").alias("modality_log")))
    log = in_window(ai_log, "opened_at", date_to, (date_to - date_from).days, pad_before=LOG_DAYS_BEFORE,
                    pad_after=LOG_DAYS_AFTER)
    b = base.select("modality", F.col("study_uid").alias("study_iuid"), "describe_start", "conclusion_time")
    # events meet their study by its id alone, and only then the modalities of their viewer
    j = (log.withColumnRenamed("modality", "modality_log").join(F.broadcast(mods.select("modality_log")), "modality_log", "left_semi")
         .join(b, "study_iuid").join(mods, ["modality", "modality_log"])
         .withColumn("ts_msk", plus_hours("opened_at", 3)))
    lo = F.col("describe_start") - F.make_interval(mins=F.lit(WINDOW_PAD_MINUTES))
    inside = (F.col("ts_msk") >= lo) & (F.col("ts_msk") <= F.col("conclusion_time"))
    return (j.groupBy("modality", "study_iuid", "series_iuid")
            .agg(A.min_where("ts_msk", inside).alias("first_ai_open"),
                 *[_counter(inside, s) for s in COUNTERS],
                 A.join_distinct("access_method", ", ").alias("methods_used")))


def _interaction(active: Column, any_: Column, none_label: str = "no_ai") -> Column:
    return F.when(any_ == 0, F.lit(none_label)).when(active > 0, F.lit("active")).otherwise(F.lit("passive"))


def _sum0(*cols: str) -> Column:
    out = F.lit(0)
    for c in cols:
        out = out + F.coalesce(F.col(c), F.lit(0))
    return out


def ai_use_series(results: DataFrame, reports: DataFrame, ai_log: DataFrame, cfg: DataFrame,
                  model_names: DataFrame, date_from: dt.date, date_to: dt.date,
                  excluded_codes=(), min_describe_start: dt.datetime | None = None,
                  unit_id: str | None = None) -> DataFrame:
    """One row per (modality, study, AI series), of the studies that ``unit_id`` described if it is given.

    The log joins on (study, series) with plain equality (J7): a study
    without AI has no series and deliberately gets no log activity.

    Base, reports and log are dealt by the study alone, once each: every join and aggregate here, and those of M11 and
    M12 after it, finds its rows together and deals none again. A study has a row per modality and series.
    """
    base = stored(base_studies(results, cfg, date_from, date_to, excluded_codes, min_describe_start, unit_id),
                  "ai-base")  # two readers below
    r = ai_results(reports).withColumn("_has_r", F.lit(1))
    acts = ai_actions(ai_log, base, cfg, date_from, date_to)
    j = base.join(r, "study_uid", "left")
    j = J.left_strict(j, acts.withColumnRenamed("study_iuid", "study_uid")
                      .withColumn("_has_log", F.lit(True)), ["modality", "study_uid", "series_iuid"], within="study_uid")
    # a line per registered model
    names = F.broadcast(model_names.select(F.col("model_id").alias("_mn_id"), F.col("service_name").alias("_mn_name")))
    j = j.join(names, F.col("model_id") == F.col("_mn_id"), "left")
    no_log = F.col("_has_log").isNull()
    in_any = _sum0("active_in_window", "view_in_window", "enlarge_in_window", "passive_in_window")
    in_active = _sum0("active_in_window", "view_in_window", "enlarge_in_window")
    first = F.col("first_ai_open")
    return j.select(
        "modality", "study_uid", "accession_number", "doctor_id", "diagnostic_code", "describe_start",
        "conclusion_time",
        F.when(F.col("_has_r").isNotNull(), 1).otherwise(0).alias("has_ai"),
        "norma_value", "model_id", "series_iuid",
        F.coalesce(F.col("_mn_name"), F.lit("unknown")).alias("service_name"),
        F.when(no_log, F.lit("no_ai")).otherwise(_interaction(in_active, in_any)).alias("ai_interaction"),
        first.alias("first_ai_open"),
        F.when(first.isNotNull(), minute_boundaries("describe_start", first)).alias("mins_to_first_ai"),
        F.when(first.isNotNull() & (first < F.col("conclusion_time")), 1).otherwise(0).alias("ai_before_conclusion"),
        "active_in_window", "view_in_window", "enlarge_in_window", "passive_in_window",
        F.when(no_log, F.lit("none"))
         .when(_sum0("outside_active_cnt", "outside_view_cnt") > 0, F.lit("active"))
         .when(F.col("outside_passive_cnt") > 0, F.lit("passive"))
         .otherwise(F.lit("none")).alias("outside_ai_interaction"),
        "outside_active_cnt", "outside_view_cnt", "outside_passive_cnt",
        F.when(F.col("actions_outside") > 0, 1).otherwise(0).alias("has_action_outside"),
        "methods_used",
        *[f"cnt_{n}" for n, _ in PROC_COUNTERS], *[f"outside_{n}" for n, _ in PROC_COUNTERS])


# ---- M11 / M12 ----------------------------------------------------------------

CONST_COLS = ["modality", "accession_number", "doctor_id", "diagnostic_code", "describe_start",
              "conclusion_time", "has_ai", "norma_value", "service_name"]


def _derived() -> dict[str, Column]:
    """Derived classes from (possibly summed) counters and first open."""
    first = F.col("first_ai_open")
    in_any = _sum0("active_in_window", "view_in_window", "enlarge_in_window", "passive_in_window")
    in_active = _sum0("active_in_window", "view_in_window", "enlarge_in_window")
    return {
        "mins_to_first_ai": F.when(first.isNotNull(), minutes_elapsed("describe_start", first)),
        "ai_before_conclusion": F.when(first.isNotNull() & F.col("conclusion_time").isNotNull()
                                       & (first < F.col("conclusion_time")), 1).otherwise(0),
        "ai_interaction": _interaction(in_active, in_any),
        "outside_ai_interaction": F.when(_sum0("outside_active_cnt", "outside_view_cnt") > 0, F.lit("active"))
                                   .when(F.coalesce(F.col("outside_passive_cnt"), F.lit(0)) > 0, F.lit("passive"))
                                   .otherwise(F.lit("none")),
    }


def ai_use_by_model(series: DataFrame, tariffs: DataFrame, period_from: dt.date,
                    period_to: dt.date) -> DataFrame:
    """One row per (study, model) with tariffs (A16 merge rule).

    Groups with a single series keep their row as is (NULL counters stay
    NULL); groups with several series are merged: counters summed with NULL
    as 0, earliest first open, any outside action, sorted series list, union
    of access methods, derived classes recomputed with half-even minutes.
    A NULL model is a group of its own. One aggregate, no self-join.
    """
    s = series.where(F.col("study_uid").isNotNull())
    g = s.groupBy("study_uid", "model_id").agg(
        F.count(F.lit(1)).alias("_n"),
        *[A.any_det(c).alias(c) for c in CONST_COLS],
        # one sum per counter: for a one-row group it is the value itself
        # (NULL stays NULL), for a merged group NULL counts as 0 below
        *[F.sum(c).alias(f"_sum_{c}") for c in COUNT_COLS],
        F.min("first_ai_open").alias("first_ai_open"),
        F.max("has_action_outside").alias("has_action_outside"),
        F.nullif(F.array_join(F.array_sort(F.collect_list("series_iuid")), ", "), F.lit("")).alias("_m_series"),
        F.min("series_iuid").alias("_one_series"),
        A.union_lists("methods_used").alias("_m_methods"),
        F.min("methods_used").alias("_one_methods"),
        *[F.min(c).alias(f"_one_{c}") for c in ("mins_to_first_ai", "ai_before_conclusion",
                                                 "ai_interaction", "outside_ai_interaction")])
    multi = F.col("_n") > 1
    g = g.withColumns({c: F.when(multi, F.coalesce(F.col(f"_sum_{c}"), F.lit(0))).otherwise(F.col(f"_sum_{c}"))
                       for c in COUNT_COLS})
    g = g.withColumns({"series_iuid": F.when(multi, F.col("_m_series")).otherwise(F.col("_one_series")),
                       "methods_used": F.when(multi, F.col("_m_methods")).otherwise(F.col("_one_methods"))})
    g = g.withColumns({c: F.when(multi, e).otherwise(F.col(f"_one_{c}")) for c, e in _derived().items()})
    g = g.withColumn("mins_to_first_ai", F.col("mins_to_first_ai").cast("double"))
    tf = F.broadcast(tariffs.select(F.col("model_id").alias("_t_id"), "tariff_current", "tariff_possible"))  # a line per model
    g = g.join(tf, F.col("model_id") == F.col("_t_id"), "left")
    return g.select(
        "modality", "study_uid", "accession_number", "doctor_id", "diagnostic_code", "describe_start",
        "conclusion_time", F.coalesce(F.col("has_ai"), F.lit(0)).alias("has_ai"),
        flag_text("norma_value").alias("norma_value"), "model_id", "series_iuid", "service_name",
        "tariff_current", "tariff_possible", "ai_interaction", "first_ai_open", "mins_to_first_ai",
        "ai_before_conclusion", *COUNT_COLS[:4], "outside_ai_interaction", *COUNT_COLS[4:7],
        F.coalesce(F.col("has_action_outside"), F.lit(0)).alias("has_action_outside"), "methods_used",
        *COUNT_COLS[7:],
        F.lit(period_from).alias("period_from"), F.lit(period_to).alias("period_to"))


def ai_use_by_study(by_model: DataFrame) -> DataFrame:
    """Roll the per-model rows up to one row per study (A17): counters
    summed (NULL as 0), any AI, earliest first open, union of methods,
    derived classes recomputed."""
    consts = ["modality", "accession_number", "doctor_id", "diagnostic_code", "describe_start",
              "conclusion_time", "norma_value", "period_from", "period_to"]
    g = by_model.groupBy("study_uid").agg(
        *[A.any_det(c).alias(c) for c in consts],
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNT_COLS],
        F.max("has_ai").alias("has_ai"),
        A.any_det("model_id").alias("model_id"),
        A.any_det("service_name").alias("service_name"),
        F.min("first_ai_open").alias("first_ai_open"),
        F.max("has_action_outside").alias("has_action_outside"),
        A.union_lists("methods_used").alias("methods_used"))
    g = g.withColumns(_derived()).withColumn("mins_to_first_ai", F.col("mins_to_first_ai").cast("double"))
    return g.select("modality", "study_uid", "accession_number", "doctor_id", "diagnostic_code",
                    "describe_start", "conclusion_time", "has_ai", "norma_value", "model_id",
                    "service_name", "ai_interaction", "first_ai_open", "mins_to_first_ai",
                    "ai_before_conclusion", *COUNT_COLS[:4], "outside_ai_interaction", *COUNT_COLS[4:7],
                    "has_action_outside", "methods_used", *COUNT_COLS[7:], "period_from", "period_to")


# ---- M13 daily model usage ----------------------------------------------------

def model_usage_daily(results: DataFrame, ai_log: DataFrame, cfg: DataFrame, date_from: dt.date,
                      date_to: dt.date, pad_days: int = 10, lo: int = 1, hi: int = 9999,
                      unit_id: str | None = None) -> DataFrame:
    """AI-log events per modality x local day x model x procedure x method, on studies that ``unit_id``
    described if it is given (S12).

    Studies come from results documented within the window padded by
    ``pad_days`` (S6; DISTINCT, semi-join so no fan-out). The model id is the
    second-to-last part of the series UID (X19); device UIDs whose part is
    not a plausible model id are dropped (F5).
    """
    devices = F.broadcast(cfg.select("device_type", "modality").distinct())
    days = (date_to - date_from).days
    described = in_window(results, "doc_created", date_to, days, pad_before=pad_days, pad_after=pad_days)
    described = described if unit_id is None else described.where(F.col("describe_unit_id") == unit_id)
    studies = (described.join(devices, "device_type").select("modality", F.col("study_uid").alias("study_iuid")).distinct())
    mods = F.broadcast(cfg.select("modality", F.col("log_modality").alias("modality_log")))
    log = (in_window(ai_log, "opened_at", date_to, days)
           .withColumnRenamed("modality", "modality_log").join(mods, "modality_log")
           .join(studies, ["modality", "study_iuid"], "left_semi")
           .withColumn("model_id", split_pick_int(F.coalesce(F.col("series_iuid"), F.lit("")), r"\.", -2)))
    log = Fl.in_range(log, "model_id", lo, hi)
    return (log.groupBy("modality", F.to_date(plus_hours("opened_at", 3)).alias("date"), "model_id",
                        "procedure_name", "access_method")
            .agg(A.n_rows().alias("event_count")))


# ---- M20 duplicate audit / keep latest -----------------------------------------

def duplicate_audit(df: DataFrame, keys, by=None) -> DataFrame:
    """Rows, distinct keys (NULL counted as a value) and duplicates."""
    return A.dup_audit(df, keys, by)


def keep_latest_version(df: DataFrame, keys, loaded_at: str) -> DataFrame:
    """Newest load per key survives; equal stamps all survive."""
    from martforge.operators.windows import keep_latest
    return keep_latest(df, keys, loaded_at)


# ---- E3: the AI-use load, end to end ----------------------------------------------

def load_ai_use(results: DataFrame, reports: DataFrame, ai_log: DataFrame, cfg: DataFrame,
                model_names: DataFrame, tariffs: DataFrame, date_from: dt.date, date_to: dt.date,
                by_model_path: str, by_study_path: str, excluded_codes=(),
                min_describe_start: dt.datetime | None = None, *, loaded_at: dt.datetime) -> int:
    """Build M10 -> M11, upsert M11 (keep the newest load per study x model,
    K4), then build M12 from this load's rows of the *written* M11 and upsert it per study.
    ``loaded_at`` names the load; a rerun with the same stamp replaces it.

    Reading M12's input back from storage cuts the lineage: M12 never
    recomputes the M10/M11 plan, and a lost executor during M12 only
    recomputes from the stored M11 files. Returns the number of targets written.
    """
    from martforge.sinks.policies import upsert_latest
    stamp = F.lit(loaded_at.isoformat(" ")).cast("timestamp_ntz")
    series = ai_use_series(results, reports, ai_log, cfg, model_names, date_from, date_to,
                           excluded_codes, min_describe_start)
    by_model = ai_use_by_model(series, tariffs, date_from, date_to).withColumn("loaded_at", stamp)
    upsert_latest(by_model, by_model_path, ["study_uid", "model_id"], "loaded_at")
    stored = by_model.sparkSession.read.parquet(by_model_path).where(F.col("loaded_at") == stamp)
    by_study = ai_use_by_study(stored.drop("loaded_at")).withColumn("loaded_at", stamp)
    upsert_latest(by_study, by_study_path, ["study_uid"], "loaded_at")
    return 2

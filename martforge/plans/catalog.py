"""Registered queries over the driver tables and their DuckDB SQL twins.

Every query reads whole driver tables through the role projections in
:mod:`martforge.plans.bindings`; windows are chosen to span the full date
range of the data, so nothing is cut to keep a check cheap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.plans import conclusions as C
from martforge.plans.bindings import Tables, with_roles

# The driver's dates run 1995-01-01 .. 2001-11-04 (orders/lineitem) and
# January 2024 (events). These windows cover all of them.
AS_OF = dt.date(2002, 1, 1)
DAYS = 2700
LO = (AS_OF - dt.timedelta(days=DAYS)).isoformat()
HI = AS_OF.isoformat()
LOADED_AT = dt.datetime(2002, 1, 1, 3, 0, 0)
LOADED = "TIMESTAMP '2002-01-01 03:00:00'"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- DuckDB fragments (oracle side only) ------------------------------------

def LOCAL(x: str) -> str:
    return f"timezone('Europe/Moscow', timezone('UTC', {x}))"


def LOCAL_DATE(x: str) -> str:
    return f"CAST({LOCAL(x)} AS DATE)"


def JTEXT(x: str, *keys: str) -> str:
    out = x
    for k in keys:
        out = f"json_extract_string({out}, '$.{k}')"
    return f"coalesce({out}, '')"


AGE_GROUP = ("CASE WHEN {a} >= 18 THEN 'Взрослые' WHEN {a} IS NOT NULL AND {a} < 18 THEN 'Дети' "
             "ELSE 'Не указано' END")

AI_NORMA_SQL = f"""ai AS (
  SELECT {JTEXT('raw_data', 'studyIUID')} AS study_uid,
         min({JTEXT('raw_data', 'aiResult', 'norma')}) AS norma_value
  FROM reports
  WHERE app_source = 'CDS'
    AND TRY_CAST({JTEXT('computed_data', 'pumStudyReadyForAiTime')} AS TIMESTAMP) IS NOT NULL
    AND {JTEXT('raw_data', 'studyIUID')} != ''
  GROUP BY 1)"""


# ---- M2 unit summary ----------------------------------------------------------

@register("unit_summary", with_roles("results", "examinations", "reports") + f""",
ie AS (SELECT accession_number, min(patient_age) AS patient_age FROM examinations
       WHERE accession_number IS NOT NULL GROUP BY accession_number),
{AI_NORMA_SQL},
t2 AS (SELECT * FROM results WHERE accession_number IS NOT NULL
       AND {LOCAL_DATE('doc_created')} BETWEEN DATE '{LO}' AND DATE '{HI}'
       AND conduct_date IS NOT NULL)
SELECT {LOCAL_DATE('t2.conduct_date')} AS conduct_date, payment_source, device_type,
       type_code AS assessment_result_type_code, conduct_mo_name, conduct_mu_name,
       describe_unit_id AS assignment_describe_mu_id,
       ai.norma_value, {AGE_GROUP.format(a='ie.patient_age')} AS age_group,
       count(DISTINCT t2.accession_number) AS cnt, {LOADED} AS load_datetime
FROM t2 LEFT JOIN ie USING (accession_number) LEFT JOIN ai ON t2.study_uid = ai.study_uid
GROUP BY ALL""")
def q_unit_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return C.unit_summary(t.results, t.examinations, t.reports, AS_OF, DAYS, loaded_at=LOADED_AT)


# ---- M3 describe time daily ---------------------------------------------------

@register("describe_time_daily", with_roles("results", "reports") + f""",
{AI_NORMA_SQL},
t2 AS (SELECT * FROM results WHERE describe_start IS NOT NULL AND doc_created IS NOT NULL
       AND accession_number IS NOT NULL AND assignment_status = 'Выполнено'
       AND doc_created >= TIMESTAMP '{LO} 00:00:00'),
studies AS (
  SELECT * FROM (
    SELECT accession_number, diagnostic_code, ai.norma_value, min(diagnostic_name) AS diagnostic_name,
           min(device_type) AS modality,
           min(describe_start) AS describe_start, min(doc_created) AS describe_end
    FROM t2 LEFT JOIN ai ON t2.study_uid = ai.study_uid
    GROUP BY accession_number, diagnostic_code, ai.norma_value) s
  WHERE describe_end >= describe_start AND date_diff('second', describe_start, describe_end) <= 21600),
agg AS (
  SELECT CAST(describe_end AS DATE) AS report_date, diagnostic_code, diagnostic_name, modality, norma_value,
         count(*) AS n_studies, avg(date_diff('second', describe_start, describe_end)) AS avg_seconds
  FROM studies GROUP BY ALL)
SELECT report_date, diagnostic_code, diagnostic_name, modality, norma_value, n_studies, avg_seconds,
       printf('%d:%02d:%02d', r // 3600, (r % 3600) // 60, r % 60) AS avg_time, {LOADED} AS load_datetime
FROM (SELECT *, CAST(round_even(avg_seconds, 0) AS BIGINT) AS r FROM agg) x""")
def q_describe_time_daily(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return C.describe_time_daily(t.results, t.reports, AS_OF, DAYS, loaded_at=LOADED_AT)


# ---- M4 distinct conclusions ------------------------------------------------

@register("distinct_conclusions", with_roles("results") + f"""
SELECT DISTINCT accession_number, study_uid,
       {LOCAL_DATE('doc_created')} AS doc_date,
       {LOCAL('doc_created')} AS assignment_result_doc_created_date_plus_3h,
       emp_fio AS assignment_result_emp_fio, payment_source, device_type, diagnostic_name,
       type_code AS assessment_result_type_code,
       conduct_mo_name, conduct_mu_name, conduct_district_name, patient_gender,
       describe_unit_id AS assignment_describe_mu_id,
       CAST(emp_id AS VARCHAR) AS assignment_result_emp_id,
       {LOCAL('conduct_date')} AS conduct_datetime,
       {LOCAL_DATE('conduct_date')} AS conduct_date_only, {LOADED} AS load_datetime
FROM results
WHERE accession_number IS NOT NULL AND type_code = 1 AND conduct_date IS NOT NULL
  AND CAST(doc_created + INTERVAL 3 HOUR AS DATE) BETWEEN DATE '{LO}' AND DATE '{HI}'""")
def q_distinct_conclusions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return C.distinct_conclusions(t.results, t.examinations, AS_OF, DAYS, loaded_at=LOADED_AT)


# ---- M1 conclusions summary ------------------------------------------------

TARIFF_BOUNDARY = dt.date(1998, 6, 1)
DEFECTS_SINCE = dt.datetime(1990, 1, 1)


# Coefficients before and from the boundary, written out here so that the twin can disagree.
TWIN_BEFORE = (
    ("КТ с КУ 1 зона", 30.41), ("КТ с КУ 2 и более зон", 49.75), ("КТ 1 зона", 11.58), ("КТ 2 и более зон", 11.58),
    ("МРТ 1 зона", 15.06), ("МРТ 2 и более зон", 15.06), ("МРТ с КУ 1 зона", 34.71),
    ("МРТ с КУ 2 и более зон", 60.25), ("ММГ", 3.67), ("РГ", 3.67), ("ФЛГ", 1.0), ("Денс", 2.15))
TWIN_FROM = (
    ("КТ с КУ 1 зона", 35.71), ("КТ с КУ 2 зоны", 43.01), ("КТ с КУ 3 зоны", 50.30), ("КТ 1 зона", 14.59),
    ("КТ 2 зоны", 21.88), ("КТ 3 зоны", 29.17), ("КТ 4 зоны", 36.47), ("МРТ 1 зона", 17.22), ("МРТ 2 зоны", 25.86),
    ("МРТ 3 зоны", 34.44), ("МРТ с КУ 1 зона", 39.92), ("МРТ с КУ 2 зоны", 48.50), ("МРТ с КУ 3 зоны", 57.14),
    ("ММГ", 3.67), ("РГ", 3.67), ("ФЛГ", 1.0), ("Денс", 2.15))


def _coef_values() -> str:
    periods = [(TWIN_BEFORE, "1900-01-01", TARIFF_BOUNDARY), (TWIN_FROM, TARIFF_BOUNDARY, "2999-12-31")]
    rows = [f"('{s}', CAST({c} AS DECIMAL(18,2)), DATE '{a}', DATE '{b}')" for v, a, b in periods for s, c in v]
    return "coefs(service_type, coef, valid_from, valid_to) AS (VALUES " + ", ".join(rows) + ")"


def _fix60(x: str) -> str:
    return f"regexp_replace({x}, ':(60)(\\.\\d+)?', ':59.000')"


ZONED = "('КТ', 'КТ с КУ', 'МРТ', 'МРТ с КУ')"

CONCLUSIONS_SUMMARY_SQL = with_roles("results", "examinations", "reports", "pin_tasks", "trauma",
                                     "procedures") + f""",
ie AS (SELECT accession_number, min(patient_age) AS patient_age FROM examinations
       WHERE accession_number IS NOT NULL GROUP BY accession_number),
{AI_NORMA_SQL},
t2 AS (SELECT * FROM (
         SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY doc_created, diagnostic_code,
                   line_no, emp_id, payment_source, device_type, conduct_date) AS rn
         FROM results WHERE accession_number IS NOT NULL AND type_code != 3
           AND {LOCAL_DATE('doc_created')} BETWEEN DATE '{LO}' AND DATE '{HI}') x WHERE rn = 1),
rep AS (
  SELECT CASE WHEN raw_data = 'null' THEN {JTEXT('computed_data', 'studyUid')}
              ELSE {JTEXT('raw_data', 'studyIUID')} END AS study_uid,
         CASE WHEN raw_data = 'null' THEN TRY_CAST(json_extract_string(computed_data, '$.modelId') AS BIGINT)
              ELSE TRY_CAST(json_extract_string(json_extract_string(raw_data, '$.aiResult'), '$.modelId') AS BIGINT)
         END AS model_id,
         TRY_CAST({_fix60(JTEXT('computed_data', 'pumStudyReadyForAiTime'))} AS TIMESTAMP) AS ready,
         greatest(TRY_CAST({_fix60(JTEXT('computed_data', 'pumReportSentTime'))} AS TIMESTAMP),
                  TRY_CAST({_fix60(JTEXT('computed_data', 'pumReportLatestDicomInstanceTime'))} AS TIMESTAMP)) AS done,
         (raw_data = 'null' OR {JTEXT('raw_data', 'aiResult', 'error')} != '') AS bad
  FROM reports
  WHERE app_source = 'CDS'
    AND TRY_CAST({JTEXT('computed_data', 'pumStudyReadyForAiTime')} AS TIMESTAMP) >= TIMESTAMP '{DEFECTS_SINCE}'),
lvl1 AS (SELECT study_uid, model_id, bool_or(bad) AS defect_b,
                date_diff('second', min(ready), max(done)) / 60.0 AS minutes
         FROM rep GROUP BY study_uid, model_id),
defects AS (SELECT DISTINCT study_uid, 1 AS has_defect_ab FROM lvl1
            WHERE minutes >= CASE WHEN model_id IN (1150, 1099, 1181, 1186, 1187, 1182, 1190, 1185, 1253)
                                  THEN 3.0 ELSE 6.5 END OR defect_b),
tr AS (SELECT DISTINCT accession_number FROM trauma WHERE accession_number IS NOT NULL),
pins AS (SELECT accession_number, {LOCAL('max(task_pin_end_date)')} AS max_pin_end FROM pin_tasks
         WHERE accession_number IS NOT NULL GROUP BY accession_number),
pz AS (SELECT *, zones AS nz FROM procedures),
dim AS (
  SELECT diagnostic_code,
         CASE WHEN family IN {ZONED} THEN family || CASE WHEN zones = 1 THEN ' 1 зона' ELSE ' 2 и более зон' END
              ELSE family END AS service_type,
         zones AS anatomical_areas, DATE '1900-01-01' AS valid_from, DATE '{TARIFF_BOUNDARY}' AS valid_to
  FROM pz
  UNION ALL
  SELECT diagnostic_code,
         CASE WHEN family IN {ZONED} THEN family || CASE WHEN nz = 1 THEN ' 1 зона' ELSE ' ' || CAST(nz AS VARCHAR) || ' зоны' END
              ELSE family END,
         coalesce(nz, zones), DATE '{TARIFF_BOUNDARY}', DATE '2999-12-31'
  FROM pz),
{_coef_values()},
j AS (
  SELECT t2.*, ie.patient_age, ai.norma_value, d.has_defect_ab,
         CASE WHEN tr.accession_number IS NOT NULL THEN 1 ELSE 0 END AS trauma_after_orthopedist_flag,
         pins.max_pin_end, dim.service_type, dim.anatomical_areas, coefs.coef,
         {LOCAL_DATE('t2.doc_created')} AS doc_day
  FROM t2
  LEFT JOIN ie ON t2.accession_number = ie.accession_number
  LEFT JOIN ai ON t2.study_uid = ai.study_uid
  LEFT JOIN defects d ON t2.study_uid = d.study_uid
  LEFT JOIN tr ON t2.accession_number = tr.accession_number
  LEFT JOIN pins ON t2.accession_number = pins.accession_number
  LEFT JOIN dim ON dim.diagnostic_code = t2.diagnostic_code
       AND dim.valid_from <= {LOCAL_DATE('t2.doc_created')} AND {LOCAL_DATE('t2.doc_created')} < dim.valid_to
  LEFT JOIN coefs ON coefs.service_type = dim.service_type
       AND coefs.valid_from <= {LOCAL_DATE('t2.doc_created')} AND {LOCAL_DATE('t2.doc_created')} < coefs.valid_to),
k AS (
  SELECT *, CASE WHEN diagnostic_code IN (33, 34, 427) AND norma_value = '1' THEN CAST(0.3 AS DECIMAL(18,2))
                 ELSE coalesce(coef, CAST(1.0 AS DECIMAL(18,2))) END AS c,
         CAST(trunc(date_diff('second', coalesce(max_pin_end, {LOCAL('conduct_date')}), {LOCAL('doc_created')}) / 3600) AS BIGINT) AS h
  FROM j)
SELECT doc_day AS doc_date, CAST(emp_id AS VARCHAR) AS assignment_result_emp_id,
       emp_fio AS assignment_result_emp_fio, payment_source, device_type, diagnostic_name,
       conduct_mo_name, conduct_mu_name, conduct_district_name, patient_gender,
       type_code AS assessment_result_type_code, describe_unit_id AS assignment_describe_mu_id,
       service_type, anatomical_areas, norma_value, has_defect_ab,
       {AGE_GROUP.format(a='patient_age')} AS age_group,
       CASE WHEN max_pin_end IS NOT NULL THEN 1 ELSE 0 END AS has_task_pin_record,
       trauma_after_orthopedist_flag,
       CASE WHEN h < 24 THEN 'Менее 24 часов' WHEN h < 48 THEN 'Более 24 часов' ELSE 'Более 48 часов' END AS time_interval,
       CAST(sum(c) AS DOUBLE) AS total_coefficient, count(DISTINCT accession_number) AS cnt,
       CAST(0 AS DOUBLE) AS tarif, {LOADED} AS load_datetime
FROM k GROUP BY ALL"""


@register("conclusions_summary", CONCLUSIONS_SUMMARY_SQL)
def q_conclusions_summary(spark, sf_dir):
    from martforge.dims.tariffs import code_dimension, coefficient_table
    t = Tables(spark, sf_dir)
    dim = code_dimension(t.procedures, boundary=TARIFF_BOUNDARY)
    return C.conclusions_summary(t.results, t.examinations, t.reports, t.pin_tasks, t.trauma, dim,
                                 coefficient_table(spark, TARIFF_BOUNDARY), AS_OF, DAYS,
                                 TARIFF_BOUNDARY, DEFECTS_SINCE, loaded_at=LOADED_AT)


# ---- M10-M13, M20 AI use ----------------------------------------------------

from martforge.plans import ai_use as AI  # noqa: E402

# Driver binding of the modality configuration: device type -> (label, log modalities).
AI_MODALITIES = {"O": ("CT", ("CT", "ASMT")), "F": ("MR", ("MR", "ASMT"))}
AI_EXCLUDED_CODES = (1, 2, 3)
AI_MIN_START = dt.datetime(1990, 1, 1)
AI_FROM, AI_TO = AS_OF - dt.timedelta(days=DAYS), AS_OF
# Invented model names and tariffs (the reference's files are not published).
MODEL_NAMES = [(1095, "chest triage"), (1096, "mammography screening")]
MODEL_TARIFFS = [(1095, 12.5, 20.0), (1096, 7.25, 9.75)]


def _ai_inputs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cfg = AI.modality_config(spark, AI_MODALITIES)
    names = spark.createDataFrame(MODEL_NAMES, "model_id long, service_name string")
    return t, cfg, names


def _ai_series(spark, sf_dir):
    t, cfg, names = _ai_inputs(spark, sf_dir)
    return AI.ai_use_series(t.results, t.reports, t.ai_log, cfg, names, AI_FROM, AI_TO,
                            AI_EXCLUDED_CODES, AI_MIN_START)


def _ai_by_model(spark, sf_dir):
    tariffs = spark.createDataFrame(MODEL_TARIFFS, "model_id long, tariff_current double, tariff_possible double")
    return AI.ai_use_by_model(_ai_series(spark, sf_dir), tariffs, AI_FROM, AI_TO)


def _cfg_values() -> str:
    rows = [f"('{d}', '{label}', '{m}')" for d, (label, mods) in AI_MODALITIES.items() for m in mods]
    return "cfg(device_type, modality, log_modality) AS (VALUES " + ", ".join(rows) + ")"


def _counter_sql(spec) -> str:
    name, in_win, col, values = spec
    cond = "inside" if in_win else "NOT inside"
    if col is not None:
        cond += f" AND {col} IN (" + ", ".join(f"'{v}'" for v in values) + ")"
    return f"count(*) FILTER (WHERE {cond}) AS {name}"


def _sum0_sql(*cols) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def _interaction_sql(active, any_) -> str:
    return f"CASE WHEN {any_} = 0 THEN 'no_ai' WHEN {active} > 0 THEN 'active' ELSE 'passive' END"


IN_ANY = _sum0_sql("active_in_window", "view_in_window", "enlarge_in_window", "passive_in_window")
IN_ACTIVE = _sum0_sql("active_in_window", "view_in_window", "enlarge_in_window")
OUT_ACTIVE = _sum0_sql("outside_active_cnt", "outside_view_cnt")
_PROC = [f"cnt_{n}" for n, _ in AI.PROC_COUNTERS] + [f"outside_{n}" for n, _ in AI.PROC_COUNTERS]
_AF, _AT = AI_FROM.isoformat(), AI_TO.isoformat()

#: The unit whose studies the unit-bound keys show (S12); a parameter, as in the loads of one unit.
AI_UNIT = "1"


def _series_ctes(of_unit: str = "") -> str:
    return with_roles("results", "reports", "ai_log") + f""",
{_cfg_values()},
base0 AS (
  SELECT c.modality, r.study_uid,
    arg_min(accession_number, (describe_start, accession_number)) FILTER (WHERE accession_number IS NOT NULL AND describe_start IS NOT NULL) AS accession_number,
    arg_min(emp_id, (describe_start, emp_id)) FILTER (WHERE emp_id IS NOT NULL AND describe_start IS NOT NULL) AS doctor_id,
    min(describe_start) AS describe_start, min(doc_created) AS conclusion_time,
    arg_min(diagnostic_code, (describe_start, diagnostic_code)) FILTER (WHERE diagnostic_code IS NOT NULL AND describe_start IS NOT NULL) AS diagnostic_code
  FROM results r JOIN (SELECT DISTINCT device_type, modality FROM cfg) c ON r.device_type = c.device_type
  WHERE CAST(doc_created AS DATE) BETWEEN DATE '{_AF}' AND DATE '{_AT}' {of_unit}
  GROUP BY c.modality, r.study_uid),
base AS (SELECT * FROM base0 WHERE diagnostic_code NOT IN {AI_EXCLUDED_CODES}
         AND describe_start >= TIMESTAMP '{AI_MIN_START}'),
airs AS (
  SELECT {JTEXT('raw_data', 'studyIUID')} AS study_uid, {JTEXT('raw_data', 'aiResult', 'seriesIUID')} AS series_iuid,
         min({JTEXT('raw_data', 'aiResult', 'norma')}) AS norma_value,
         min(CASE WHEN raw_data = 'null' THEN TRY_CAST(json_extract_string(computed_data, '$.modelId') AS BIGINT)
                  ELSE TRY_CAST(json_extract_string(json_extract_string(raw_data, '$.aiResult'), '$.modelId') AS BIGINT) END) AS model_id
  FROM reports
  WHERE app_source = 'CDS' AND TRY_CAST({JTEXT('computed_data', 'pumStudyReadyForAiTime')} AS TIMESTAMP) IS NOT NULL
    AND trim({JTEXT('raw_data', 'aiResult', 'norma')}) != ''
  GROUP BY 1, 2),
logj AS (
  SELECT c.modality, l.study_iuid, l.series_iuid, l.access_method, l.procedure_name,
         l.opened_at + INTERVAL 3 HOUR AS ts_msk, b.describe_start, b.conclusion_time,
         (l.opened_at + INTERVAL 3 HOUR >= b.describe_start - INTERVAL 5 MINUTE
          AND l.opened_at + INTERVAL 3 HOUR <= b.conclusion_time) AS inside
  FROM ai_log l JOIN cfg c ON l.modality = c.log_modality
  JOIN base b ON b.modality = c.modality AND b.study_uid = l.study_iuid
  WHERE CAST(l.opened_at AS DATE) BETWEEN DATE '{_AF}' - INTERVAL 7 DAY AND DATE '{_AT}' + INTERVAL 30 DAY),
acts AS (
  SELECT modality, study_iuid, series_iuid, min(ts_msk) FILTER (WHERE inside) AS first_ai_open,
         {", ".join(_counter_sql(s) for s in AI.COUNTERS)},
         array_to_string(list_sort(list_distinct(list(access_method))), ', ') AS methods_used
  FROM logj GROUP BY 1, 2, 3),
series AS (
  SELECT b.modality, b.study_uid, b.accession_number, b.doctor_id, b.diagnostic_code, b.describe_start,
         b.conclusion_time, CASE WHEN r.study_uid IS NOT NULL THEN 1 ELSE 0 END AS has_ai,
         r.norma_value, r.model_id, r.series_iuid, coalesce(mn.service_name, 'unknown') AS service_name,
         CASE WHEN a.study_iuid IS NULL THEN 'no_ai' ELSE {_interaction_sql(IN_ACTIVE, IN_ANY)} END AS ai_interaction,
         a.first_ai_open,
         CASE WHEN a.first_ai_open IS NOT NULL THEN
              CAST(date_diff('second', date_trunc('minute', b.describe_start), date_trunc('minute', a.first_ai_open)) / 60 AS BIGINT) END AS mins_to_first_ai,
         CASE WHEN a.first_ai_open IS NOT NULL AND a.first_ai_open < b.conclusion_time THEN 1 ELSE 0 END AS ai_before_conclusion,
         a.active_in_window, a.view_in_window, a.enlarge_in_window, a.passive_in_window,
         CASE WHEN a.study_iuid IS NULL THEN 'none' WHEN {OUT_ACTIVE} > 0 THEN 'active'
              WHEN a.outside_passive_cnt > 0 THEN 'passive' ELSE 'none' END AS outside_ai_interaction,
         a.outside_active_cnt, a.outside_view_cnt, a.outside_passive_cnt,
         CASE WHEN a.actions_outside > 0 THEN 1 ELSE 0 END AS has_action_outside, a.methods_used,
         {", ".join("a." + c for c in _PROC)}
  FROM base b LEFT JOIN airs r ON b.study_uid = r.study_uid
  LEFT JOIN acts a ON a.modality = b.modality AND a.study_iuid = b.study_uid AND a.series_iuid = r.series_iuid
  LEFT JOIN (VALUES {", ".join(f"({i}, '{n}')" for i, n in MODEL_NAMES)}) mn(model_id, service_name)
       ON mn.model_id = r.model_id)"""


AI_SERIES_CTES = _series_ctes()


@register("ai_use_series", AI_SERIES_CTES + "\nSELECT * FROM series")
def q_ai_use_series(spark, sf_dir):
    return _ai_series(spark, sf_dir)


@register("ai_use_series_unit", _series_ctes(f"AND describe_unit_id = '{AI_UNIT}'") + "\nSELECT * FROM series")
def q_ai_use_series_unit(spark, sf_dir):
    t, cfg, names = _ai_inputs(spark, sf_dir)
    return AI.ai_use_series(t.results, t.reports, t.ai_log, cfg, names, AI_FROM, AI_TO, AI_EXCLUDED_CODES,
                            AI_MIN_START, unit_id=AI_UNIT)


def _merged_union(col: str) -> str:
    """Union of comma lists across a group: trimmed, distinct, sorted, NULL if empty."""
    return (f"nullif(array_to_string(list_sort(list_distinct(list_filter(list_transform("
            f"flatten(list(string_split(coalesce({col}, ''), ','))), lambda x: trim(x)), lambda x: x != ''))), ', '), '')")


_CNT = AI.COUNT_COLS
AI_BY_MODEL_CTES = AI_SERIES_CTES + f""",
g AS (
  SELECT study_uid, model_id, count(*) AS n,
         {", ".join(f"min({c}) AS {c}" for c in AI.CONST_COLS)},
         {", ".join(f"min({c}) AS one_{c}, CAST(coalesce(sum({c}), 0) AS BIGINT) AS sum_{c}" for c in _CNT)},
         min(first_ai_open) AS first_ai_open, max(has_action_outside) AS has_action_outside,
         nullif(array_to_string(list_sort(list(series_iuid)), ', '), '') AS m_series, min(series_iuid) AS one_series,
         {_merged_union('methods_used')} AS m_methods, min(methods_used) AS one_methods,
         min(mins_to_first_ai) AS one_mins, min(ai_before_conclusion) AS one_before,
         min(ai_interaction) AS one_inter, min(outside_ai_interaction) AS one_out
  FROM series WHERE study_uid IS NOT NULL GROUP BY study_uid, model_id),
g2 AS (
  SELECT *, {", ".join(f"CASE WHEN n > 1 THEN sum_{c} ELSE one_{c} END AS v_{c}" for c in _CNT)} FROM g),
by_model AS (
  SELECT modality, study_uid, accession_number, doctor_id, diagnostic_code, describe_start, conclusion_time,
         coalesce(has_ai, 0) AS has_ai,
         CAST(CAST(TRY_CAST(CAST(norma_value AS VARCHAR) AS DOUBLE) AS INTEGER) AS VARCHAR) AS norma_value,
         g2.model_id, CASE WHEN n > 1 THEN m_series ELSE one_series END AS series_iuid, service_name,
         t.tariff_current, t.tariff_possible,
         CASE WHEN n > 1 THEN {_interaction_sql(_sum0_sql(*("v_" + c for c in _CNT[:3])), _sum0_sql(*("v_" + c for c in _CNT[:4])))}
              ELSE one_inter END AS ai_interaction,
         first_ai_open,
         CAST(CASE WHEN n > 1 THEN (CASE WHEN first_ai_open IS NOT NULL THEN
              CAST(round_even(date_diff('second', describe_start, first_ai_open) / 60.0, 0) AS BIGINT) END)
              ELSE one_mins END AS DOUBLE) AS mins_to_first_ai,
         CASE WHEN n > 1 THEN (CASE WHEN first_ai_open IS NOT NULL AND conclusion_time IS NOT NULL
              AND first_ai_open < conclusion_time THEN 1 ELSE 0 END) ELSE one_before END AS ai_before_conclusion,
         {", ".join(f"v_{c} AS {c}" for c in _CNT[:4])},
         CASE WHEN n > 1 THEN (CASE WHEN {_sum0_sql("v_outside_active_cnt", "v_outside_view_cnt")} > 0 THEN 'active'
              WHEN coalesce(v_outside_passive_cnt, 0) > 0 THEN 'passive' ELSE 'none' END) ELSE one_out END
              AS outside_ai_interaction,
         {", ".join(f"v_{c} AS {c}" for c in _CNT[4:7])},
         coalesce(has_action_outside, 0) AS has_action_outside,
         CASE WHEN n > 1 THEN m_methods ELSE one_methods END AS methods_used,
         {", ".join(f"v_{c} AS {c}" for c in _CNT[7:])},
         DATE '{_AF}' AS period_from, DATE '{_AT}' AS period_to
  FROM g2 LEFT JOIN (VALUES {", ".join(f"({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for i, a, b in MODEL_TARIFFS)})
       t(model_id, tariff_current, tariff_possible) ON t.model_id = g2.model_id)"""


@register("ai_use_by_model", AI_BY_MODEL_CTES + "\nSELECT * FROM by_model")
def q_ai_use_by_model(spark, sf_dir):
    return _ai_by_model(spark, sf_dir)


@register("ai_use_by_study", AI_BY_MODEL_CTES + f""",
st AS (
  SELECT study_uid, {", ".join(f"min({c}) AS {c}" for c in ("modality", "accession_number", "doctor_id",
         "diagnostic_code", "describe_start", "conclusion_time", "norma_value", "period_from", "period_to"))},
         {", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in _CNT)},
         max(has_ai) AS has_ai, min(model_id) AS model_id, min(service_name) AS service_name,
         min(first_ai_open) AS first_ai_open, max(has_action_outside) AS has_action_outside,
         {_merged_union('methods_used')} AS methods_used
  FROM by_model GROUP BY study_uid)
SELECT modality, study_uid, accession_number, doctor_id, diagnostic_code, describe_start, conclusion_time,
       has_ai, norma_value, model_id, service_name,
       {_interaction_sql(IN_ACTIVE, IN_ANY)} AS ai_interaction, first_ai_open,
       CAST(CASE WHEN first_ai_open IS NOT NULL THEN
            CAST(round_even(date_diff('second', describe_start, first_ai_open) / 60.0, 0) AS BIGINT) END AS DOUBLE) AS mins_to_first_ai,
       CASE WHEN first_ai_open IS NOT NULL AND conclusion_time IS NOT NULL AND first_ai_open < conclusion_time
            THEN 1 ELSE 0 END AS ai_before_conclusion,
       {", ".join(_CNT[:4])},
       CASE WHEN {OUT_ACTIVE} > 0 THEN 'active' WHEN coalesce(outside_passive_cnt, 0) > 0 THEN 'passive'
            ELSE 'none' END AS outside_ai_interaction,
       {", ".join(_CNT[4:7])}, has_action_outside, methods_used, {", ".join(_CNT[7:])}, period_from, period_to
FROM st""")
def q_ai_use_by_study(spark, sf_dir):
    return AI.ai_use_by_study(_ai_by_model(spark, sf_dir))


def _usage_sql(of_unit: str = "") -> str:
    return with_roles("results", "ai_log") + f""",
{_cfg_values()},
studies AS (
  SELECT DISTINCT c.modality, r.study_uid AS study_iuid
  FROM results r JOIN (SELECT DISTINCT device_type, modality FROM cfg) c ON r.device_type = c.device_type
  WHERE CAST(doc_created AS DATE) BETWEEN DATE '{_AF}' - INTERVAL 10 DAY AND DATE '{_AT}' + INTERVAL 10 DAY {of_unit}),
lg AS (
  SELECT c.modality, l.*,
         TRY_CAST(CASE WHEN len(string_split(coalesce(series_iuid, ''), '.')) >= 2
                       THEN string_split(coalesce(series_iuid, ''), '.')[-2] END AS BIGINT) AS model_id
  FROM ai_log l JOIN cfg c ON l.modality = c.log_modality
  WHERE CAST(opened_at AS DATE) BETWEEN DATE '{_AF}' AND DATE '{_AT}'
    AND EXISTS (SELECT 1 FROM studies s WHERE s.modality = c.modality AND s.study_iuid = l.study_iuid))
SELECT modality, CAST(opened_at + INTERVAL 3 HOUR AS DATE) AS date, model_id, procedure_name, access_method,
       count(*) AS event_count
FROM lg WHERE model_id BETWEEN 1 AND 9999 GROUP BY ALL"""


@register("model_usage_daily", _usage_sql())
def q_model_usage_daily(spark, sf_dir):
    t, cfg, _ = _ai_inputs(spark, sf_dir)
    return AI.model_usage_daily(t.results, t.ai_log, cfg, AI_FROM, AI_TO)


@register("model_usage_unit", _usage_sql(f"AND describe_unit_id = '{AI_UNIT}'"))
def q_model_usage_unit(spark, sf_dir):
    t, cfg, _ = _ai_inputs(spark, sf_dir)
    return AI.model_usage_daily(t.results, t.ai_log, cfg, AI_FROM, AI_TO, unit_id=AI_UNIT)


# ---- M5, M7, M9, M14, M15 -----------------------------------------------------------

from martforge.plans import operational as OP  # noqa: E402

ONCO_SUBSTR, ONCO_NAMES = "URGENT", ("2-HIGH",)


@register("oncology_counts", with_roles("examinations", "results") + f""",
descr AS (SELECT DISTINCT study_uid FROM results)
SELECT {LOCAL_DATE('e.conduct_date')} AS conduct_date, e.research_kind, e.assignment_status, e.research_id,
       e.ae_title, coalesce(e.payment_source, 'ОМС') AS payment_source,
       CASE WHEN e.patient_age >= 18 THEN 'Взрослые' ELSE 'Дети' END AS patient_age_group,
       CASE WHEN d.study_uid IS NOT NULL THEN 'Описано' END AS described,
       count(DISTINCT e.accession_number) AS count_accession
FROM examinations e LEFT JOIN descr d ON e.study_uid = d.study_uid
WHERE e.ae_title IS NOT NULL AND (e.research_kind LIKE '%{ONCO_SUBSTR}%' OR e.research_kind IN ('2-HIGH'))
  AND {LOCAL_DATE('e.conduct_date')} >= DATE '{LO}'
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, d.study_uid""")
def q_oncology_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return OP.oncology_counts(t.examinations, t.results, "research_kind", ONCO_SUBSTR, ONCO_NAMES,
                              dt.date.fromisoformat(LO),
                              ["research_kind", "assignment_status", "research_id", "ae_title"])


@register("benefit_cohort", with_roles("results", "examinations", "reports", "units", "benefits",
                                       "pin_tasks", "routes") + f""",
ie AS (SELECT accession_number, min(patient_age) AS patient_age, min(patient_id) AS patient_id,
              min(assignment_mu_id) AS assignment_mu_id
       FROM examinations WHERE accession_number IS NOT NULL GROUP BY accession_number),
{AI_NORMA_SQL},
per AS (SELECT DISTINCT patient_id, start_date, coalesce(end_date, DATE '2099-12-31') AS end_date, benefit_name
        FROM benefits WHERE benefit_code IN ('940', '941') AND patient_status_id = '11' AND status_llo_id IN ('4')
          AND patient_id IS NOT NULL),
ap AS (SELECT DISTINCT accession_number FROM pin_tasks WHERE task_pin_end_date IS NULL AND accession_number IS NOT NULL),
lp AS (SELECT accession_number, task_pin_status, task_pin_end_date FROM (
         SELECT *, row_number() OVER (PARTITION BY accession_number
                   ORDER BY task_pin_end_date DESC, task_pin_status, pin_id) AS rn
         FROM pin_tasks WHERE task_pin_end_date IS NOT NULL AND accession_number IS NOT NULL) x WHERE rn = 1),
base AS (
  SELECT t2.*, u.unit_name, ie.patient_age, ie.patient_id, ie.assignment_mu_id, ua.unit_name AS assignment_unit_name,
         ai.norma_value,
         CASE WHEN ap.accession_number IS NOT NULL THEN 'находится в ПИНе' ELSE 'не в ПИНе' END AS pin_status,
         lp.task_pin_status, lp.task_pin_end_date, {LOCAL('t2.conduct_date')} AS conduct_local,
         (SELECT arg_min(p.benefit_name, (-(p.start_date - DATE '1970-01-01'), p.benefit_name)) FROM per p
           WHERE p.patient_id = ie.patient_id AND CAST(t2.conduct_date AS DATE) BETWEEN p.start_date AND p.end_date)
           AS llo_benefit_status
  FROM results t2
  LEFT JOIN units u ON u.unit_id = t2.describe_unit_id
  LEFT JOIN ie ON t2.accession_number = ie.accession_number
  LEFT JOIN units ua ON ua.unit_id = ie.assignment_mu_id
  LEFT JOIN ai ON t2.study_uid = ai.study_uid
  LEFT JOIN ap ON t2.accession_number = ap.accession_number
  LEFT JOIN lp ON t2.accession_number = lp.accession_number
  WHERE t2.accession_number IS NOT NULL
    AND t2.conduct_date >= TIMESTAMP '{LO} 00:00:00' AND t2.conduct_date < TIMESTAMP '{HI} 00:00:00'),
f AS (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY conduct_local, doc_created, line_no,
                emp_id, diagnostic_code, payment_source, device_type) AS rn
      FROM base WHERE llo_benefit_status IS NOT NULL),
rd AS (SELECT eris_id, min(assignment_doctor_job_name) AS assignment_doctor_job_name FROM routes
       WHERE eris_id IN (SELECT accession_number FROM f) GROUP BY eris_id)
SELECT conduct_local AS conduct_date, {LOCAL('doc_created')} AS describe_date, accession_number, patient_id,
       payment_source, device_type, diagnostic_name, type_code AS assessment_result_type_code,
       conduct_mo_name, conduct_mu_name, diag_code, {LOADED} AS load_datetime,
       {LOCAL('describe_start')} AS assignment_describe_start_date,
       describe_unit_id AS assignment_describe_mu_id, unit_name AS lpu_short_name_by_lpu_id, assignment_mu_id,
       assignment_unit_name AS lpu_short_name_by_assignment_mu_id, norma_value,
       {AGE_GROUP.format(a='patient_age')} AS age_group, pin_status, task_pin_end_date, task_pin_status,
       llo_benefit_status, rd.assignment_doctor_job_name
FROM f LEFT JOIN rd ON rd.eris_id = f.accession_number WHERE rn = 1""")
def q_benefit_cohort(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return OP.benefit_cohort(t.results, t.examinations, t.reports, t.units, t.benefits, t.pin_tasks,
                             dt.date.fromisoformat(LO), AS_OF, routes=t.routes, loaded_at=LOADED_AT)


@register("equipment_studies", with_roles("inpatient_orders", "inpatient_exams", "facilities") + f"""
SELECT coalesce(CAST(o.run_dt AS DATE), DATE '1900-01-01') AS date_dt,
       coalesce(o.run_dt, TIMESTAMP '1900-01-01 00:00:00') AS date_time,
       coalesce(o.facility_id, '') AS facility_id, coalesce(f.short_name, '') AS facility_short_name,
       coalesce(o.device_type, '') AS device_type, coalesce(o.ae_title, '') AS ae_title,
       coalesce(o.naz_code, '') AS procedure_code, coalesce(o.naz_name, '') AS procedure_name,
       coalesce(i.patient_id, '') AS patient_id, coalesce(CAST(o.accession_number AS VARCHAR), '') AS naz_accession_number,
       coalesce(o.studyuid, '') AS study_uid, coalesce(i.pay_type_name, '') AS pay_type_name,
       coalesce(i.sign_emp_id, '') AS sign_emp_id
FROM inpatient_orders o
LEFT JOIN inpatient_exams i ON o.naz_id = i.naz_id
LEFT JOIN facilities f ON o.facility_id = f.id
WHERE o.studyuid IS NOT NULL AND o.run_dt >= TIMESTAMP '{LO} 00:00:00'""")
def q_equipment_studies(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return OP.equipment_studies(t.inpatient_orders, t.inpatient_exams, t.facilities,
                                dt.datetime.fromisoformat(LO))


FRESH_AS_OF = dt.date(2001, 11, 4)
FRESH_CHECK_TS = dt.datetime(2001, 11, 4, 9, 30)
FRESH_DASHBOARD = "undescribed studies"
# The driver's days run over years: the look-backs are widened to span each table.
FRESH_BACK = {"examinations": DAYS, "results": DAYS + 10, "trauma": 3 * DAYS, "undescribed": DAYS + 400, "pin_tasks": DAYS}


def _fresh_sql() -> str:
    floor = {k: f"DATE '{FRESH_AS_OF}' - INTERVAL {v} DAY" for k, v in FRESH_BACK.items()}
    checks = [
        ("examinations", "critical", "Данные о проведённых исследованиях", "examinations", "conduct_date",
         f"CAST(conduct_date AS DATE) >= {floor['examinations']}"),
        ("results", "critical", "Описания рентгенологов",
         "results LEFT JOIN examinations ON results.accession_number = examinations.accession_number", "examinations.conduct_date",
         f"CAST(examinations.conduct_date AS DATE) >= {floor['results']}"),
        ("trauma", "auxiliary", "Травматологические направления", "trauma", "assignment_signed_date",
         f"CAST(assignment_signed_date AS DATE) >= {floor['trauma']}"),
        ("undescribed", "auxiliary", "Неописанные исследования", "undescribed", "create_date",
         f"CAST(create_date AS DATE) >= {floor['undescribed']}"),
        ("pin_tasks", "auxiliary", "Задачи в ПИНе", "pin_tasks", "task_pin_send_date",
         f"(task_pin_end_date IS NULL OR CAST(task_pin_end_date AS DATE) >= {floor['pin_tasks']}) "
         f"AND CAST(task_pin_send_date AS DATE) <= DATE '{FRESH_AS_OF}'"),
    ]
    parts = []
    for name, kind, desc, source, col, cond in checks:
        parts.append(f"""SELECT '{name}' AS table_name, '{kind}' AS table_type, '{desc}' AS description,
  count(*) AS row_count, coalesce(max({col}), TIMESTAMP '1971-01-01 00:00:00') AS last_data_datetime,
  coalesce((SELECT {col} FROM {source} WHERE {cond} ORDER BY {col} DESC LIMIT 1 OFFSET 1),
           TIMESTAMP '1971-01-01 00:00:00') AS previous_data_datetime
FROM {source} WHERE {cond}""")
    fmt = "strftime(last_data_datetime, '%d.%m.%Y %H:%M:%S')"
    return with_roles("examinations", "results", "trauma", "undescribed", "pin_tasks") + ",\nchecks AS (" + "\nUNION ALL\n".join(parts) + f"""),
st AS (
  SELECT *, CAST(last_data_datetime AS DATE) AS last_data_date,
    CASE WHEN last_data_datetime >= TIMESTAMP '{FRESH_AS_OF} 00:00:00' THEN 'Данные за текущий день (' || {fmt} || ')'
         WHEN last_data_datetime >= TIMESTAMP '{FRESH_AS_OF - dt.timedelta(days=1)} 00:00:00' THEN 'Данные за предыдущий день (' || {fmt} || ')'
         WHEN row_count > 0 THEN 'Данные старше 2 дней (последние: ' || {fmt} || ')'
         ELSE 'Нет данных за последние 2 дня' END AS table_status,
    CASE WHEN table_type = 'critical' AND (CAST(last_data_datetime AS DATE) < DATE '{FRESH_AS_OF}' OR row_count = 0)
         THEN 1 ELSE 0 END AS critical_issue
  FROM checks),
ds AS (SELECT max(critical_issue) AS h,
              sum(CASE WHEN CAST(last_data_datetime AS DATE) = DATE '{FRESH_AS_OF}' THEN 1 ELSE 0 END) AS today_n,
              sum(CASE WHEN table_type = 'critical' THEN 1 ELSE 0 END) AS crit_n FROM st)
SELECT TIMESTAMP '{FRESH_CHECK_TS}' AS check_timestamp, table_name, table_type, description, row_count,
       last_data_datetime, previous_data_datetime, last_data_date, table_status,
       CASE WHEN h = 1 THEN 'НЕ ПРИГОДЕН' ELSE 'ПРИГОДЕН' END AS overall_status,
       'Критических таблиц: ' || CAST(today_n AS VARCHAR) || ' из ' || CAST(crit_n AS VARCHAR) AS fresh_tables_details,
       date_diff('second', last_data_datetime, TIMESTAMP '{FRESH_CHECK_TS}') AS data_latency_seconds,
       '{FRESH_DASHBOARD}' AS dashboard_name
FROM st CROSS JOIN ds"""


@register("freshness_report", _fresh_sql())
def q_freshness_report(spark, sf_dir):
    t = Tables(spark, sf_dir)
    checks = OP.source_checks(t.examinations, t.results, t.trauma, t.undescribed, t.pin_tasks, FRESH_AS_OF, FRESH_BACK)
    return OP.freshness_report(checks, FRESH_AS_OF, FRESH_CHECK_TS, FRESH_DASHBOARD)


REFRESH_ENTITIES = ("click", "purchase", "signup")
REFRESH_AS_OF = dt.datetime(2024, 2, 1)


@register("refresh_log", with_roles("etl_events") + f"""
SELECT DISTINCT entity, loaded FROM etl_events
WHERE entity IN {REFRESH_ENTITIES} AND loaded >= TIMESTAMP '{REFRESH_AS_OF}' - INTERVAL 45 DAY""")
def q_refresh_log(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return OP.refresh_log(t.etl_events, REFRESH_ENTITIES, REFRESH_AS_OF, 45)


# ---- M16-M19 text, id sync, guide, registry ------------------------------------

from martforge.plans import registry as RG  # noqa: E402

# Fixed values of the twins: white space, the character references that the pages hold (the ampersand last), status codes.
PY_WS = r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
HTML_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"),
                 ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&laquo;", "\u00ab"),
                 ("&raquo;", "\u00bb"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"), ("&hellip;", "\u2026"),
                 ("&amp;", "&"))
STATUS_CODES = {"новая": "new", "назначен ответственный": "responsible_assigned", "назначена": "responsible_assigned",
                "в работе": "work", "отправлено на доработку": "rework", "на доработке": "rework"}


def _ws(x: str, repl: str = " ") -> str:
    return f"regexp_replace({x}, '{PY_WS}', '{repl}', 'g')"


def _strip_html_sql(x: str) -> str:
    return f"trim({_ws(f'regexp_replace(coalesce({x}, {chr(39)}{chr(39)}), {chr(39)}<[^>]+>{chr(39)}, {chr(39)} {chr(39)}, {chr(39)}g{chr(39)})')})"


def _unescape_sql(x: str) -> str:
    out = x
    for ent, ch in HTML_ENTITIES:
        out = f"replace({out}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return out


def _tag_texts_sql(x: str, tag: str) -> str:
    found = f"regexp_extract_all(coalesce({x}, ''), '(?is)<{tag}[^>]*>(.*?)</{tag}>', 1)"
    return (f"array_to_string(list_filter(list_transform({found}, lambda t: {_strip_html_sql(_unescape_sql('t'))}), "
            f"lambda t: t != ''), '; ')")


@register("clean_comments", f"""
SELECT doc_id, CASE WHEN text IS NULL OR text = '' THEN text
                    ELSE trim({_ws("replace(text, '\"', '')")}) END AS text,
       lang, source, n_chars
FROM documents""")
def q_clean_comments(spark, sf_dir):
    return RG.mirror_clean(Tables(spark, sf_dir).documents, ["text"])


_NORM = f"replace(replace({_ws('raw_id', '')}, 'А', 'A'), 'а', 'A')"


@register("accession_sync", with_roles("id_lists", "stored_ids") + f""",
n AS (SELECT CASE WHEN regexp_matches(s, '^[0-9]') THEN 'A' || s ELSE s END AS s FROM (SELECT {_NORM} AS s FROM id_lists) x),
v AS (SELECT DISTINCT upper(s) AS accession FROM n WHERE regexp_matches(s, '^[A-Za-z][0-9]{{5,}}$'))
SELECT accession FROM v WHERE accession NOT IN (SELECT accession FROM stored_ids WHERE accession IS NOT NULL)""")
def q_accession_sync(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return RG.new_accessions(t.id_lists, t.stored_ids)


GUIDE_STAGES = [("HOUSEHOLD", "Домохозяйства"), ("MACHINERY", "Оборудование"),
                ("FURNITURE", "Мебель"), ("AUTOMOBILE", "Транспорт")]


@register("dismissed_guide", with_roles("crm_items", "crm_users") + f""",
users AS (SELECT ID, coalesce(nullif(trim(concat_ws(' ', nullif(LAST_NAME, ''), nullif(NAME, ''),
                 nullif(SECOND_NAME, ''))), ''), CAST(ID AS VARCHAR)) AS full_name FROM crm_users),
stages(STATUS_ID, NAME) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in GUIDE_STAGES)})
SELECT coalesce(TRY_CAST(CAST(i.id AS VARCHAR) AS BIGINT), 0) AS bx_id,
       coalesce(trim(coalesce(u0.full_name, CAST(i.employee AS VARCHAR))), '') AS employee_name,
       coalesce(trim(coalesce(u1.full_name, CAST(i.created_by AS VARCHAR))), '') AS created_by,
       coalesce(trim(coalesce(u2.full_name, CAST(i.assigned_by_id AS VARCHAR))), '') AS assigned_to,
       coalesce(trim(coalesce(s.NAME, i.stage_id)), '') AS stage,
       coalesce(array_to_string(list_filter(i.kpe_document, lambda x: x IS NOT NULL), '; '), '') AS kpe_document,
       CASE WHEN i.kpe_size IS NULL THEN '' WHEN i.kpe_size THEN 'Да' ELSE 'Нет' END AS kpe_size,
       coalesce(array_to_string(list_filter(i.voting_status_9, lambda x: x IS NOT NULL), '; '), '') AS voting_status_9,
       coalesce(trim(coalesce(u3.full_name, CAST(i.commission_member_9 AS VARCHAR))), '') AS commission_member_9,
       coalesce(trim(i.department_parus), '') AS department_parus,
       coalesce(trim(i.additional_info), '') AS additional_info,
       CASE WHEN i.reregistration IS NULL THEN '' WHEN i.reregistration THEN 'Да' ELSE 'Нет' END AS reregistration,
       coalesce(trim(i.labor_code_article), '') AS labor_code_article,
       coalesce(trim(i.dismissal_reason), '') AS dismissal_reason, {LOADED} AS load_datetime,
       coalesce(trim(CAST(i.descriptions_count AS VARCHAR)), '') AS descriptions_count,
       coalesce(CAST(TRY_CAST(trim(i.dismissal_date) AS TIMESTAMP) AS DATE), DATE '1900-01-01') AS dismissal_date
FROM crm_items i
LEFT JOIN users u0 ON u0.ID = i.employee
LEFT JOIN users u1 ON u1.ID = i.created_by
LEFT JOIN users u3 ON u3.ID = i.commission_member_9
LEFT JOIN users u2 ON u2.ID = i.assigned_by_id
LEFT JOIN stages s ON s.STATUS_ID = i.stage_id""")
def q_dismissed_guide(spark, sf_dir):
    t = Tables(spark, sf_dir)
    stages = spark.createDataFrame(GUIDE_STAGES, "STATUS_ID string, NAME string")
    return RG.dismissed_guide(t.crm_items, t.crm_users, stages, loaded_at=LOADED_AT)


_STATUS_CASE = ("CASE lower(st) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_CODES.items())
                + " ELSE st END")
_LINKS = "regexp_extract_all(coalesce(detail_html, ''), 'https://files\\.test/[^\"''<>\\\\\\s]+')"


@register("web_registry", with_roles("registry_rows", "dentistry") + f""",
r AS (
  SELECT seq, {_strip_html_sql('code')} AS id, {_strip_html_sql('created_at')} AS date_time,
         {_strip_html_sql('medservice_name')} AS specialization, {_strip_html_sql('source_name')} AS source,
         {_strip_html_sql('organization_fmt')} AS med_organization, {_strip_html_sql('responsible_name')} AS responsible,
         {_strip_html_sql('work_type_name')} AS type_zayavki, load_rate AS norma_zagruzki,
         {_strip_html_sql('sla_time')} AS sla, trim({_strip_html_sql('status_text')}) AS st,
         {_tag_texts_sql('orthanc_html', 'span')} AS documents_dicom,
         CASE WHEN doc_list IS NULL OR doc_list = '' THEN []
              ELSE list_filter(list_transform({_LINKS}, lambda u: {_unescape_sql('u')}),
                   lambda u: request_id IS NULL OR contains(u, '/docs/' || request_id || '/')) END AS urls
  FROM registry_rows),
k AS (
  SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(id, ''), md5(concat_ws('|', id, date_time, specialization,
         source, med_organization, responsible, type_zayavki, norma_zagruzki, sla, st, documents_dicom,
         array_to_string(urls, ' ')))) ORDER BY seq) AS rn
  FROM r)
SELECT id, date_time, specialization, source, med_organization, responsible, type_zayavki, norma_zagruzki, sla,
       {_STATUS_CASE} AS status, documents_dicom,
       array_to_string(list_filter(urls, lambda u, i: list_position(urls, u) = i), '; ') AS documents_pdf,
       '2002-01-01 03:00:00' AS load_date,
       CASE WHEN id IN (SELECT d.id FROM dentistry d WHERE d.id != '') THEN 'Да' ELSE 'Нет' END AS stomatology
FROM k WHERE rn = 1""")
def q_web_registry(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return RG.web_registry(t.registry_rows, t.dentistry, "https://files.test/", loaded_at=LOADED_AT)


# ---- M20 and operator-level keys -------------------------------------------------

from martforge.plans import checks as CK  # noqa: E402


@register("duplicate_audit", with_roles("results") + """
SELECT payment_source, count(*) AS total_rows,
       count(DISTINCT (coalesce(CAST(accession_number AS VARCHAR), chr(0)), coalesce(CAST(line_no AS VARCHAR), chr(0)))) AS distinct_keys,
       count(*) - count(DISTINCT (coalesce(CAST(accession_number AS VARCHAR), chr(0)), coalesce(CAST(line_no AS VARCHAR), chr(0)))) AS duplicates
FROM results GROUP BY payment_source""")
def q_duplicate_audit(spark, sf_dir):
    r = Tables(spark, sf_dir).results.select(
        "payment_source", F.col("accession_number").cast("string").alias("a"), F.col("line_no").cast("string").alias("l"))
    return AI.duplicate_audit(r, ["a", "l"], by=["payment_source"])


@register("keep_latest_ties", with_roles("results") + """
SELECT accession_number, line_no, diagnostic_code, doc_created FROM (
  SELECT *, rank() OVER (PARTITION BY accession_number ORDER BY doc_created DESC NULLS LAST) AS rk FROM results) x
WHERE rk = 1""")
def q_keep_latest_ties(spark, sf_dir):
    r = Tables(spark, sf_dir).results.select("accession_number", "line_no", "diagnostic_code", "doc_created")
    return AI.keep_latest_version(r, ["accession_number"], "doc_created")


@register("status_chain", """
SELECT conv_id, array_to_string(list_transform(list_sort(list({'t': turn, 's': role})), lambda e: e.s), ' -> ') AS status_chain,
       count(*) FILTER (WHERE role = 'assistant') AS cnt_assistant,
       min(turn) FILTER (WHERE role = 'user') AS first_user, max(turn) FILTER (WHERE role = 'user') AS last_user,
       count(*) AS n_changes
FROM conversations GROUP BY conv_id""")
def q_status_chain(spark, sf_dir):
    return CK.status_chains(Tables(spark, sf_dir).conversations, "conv_id", "turn", "role")


@register("value_at_first", """
SELECT user_id, arg_min(event_type, (ts, event_id)) FILTER (WHERE event_type IS NOT NULL AND ts IS NOT NULL) AS first_value,
       min(ts) AS first_time, array_to_string(list_sort(list_distinct(list(event_type))), ', ') AS all_values
FROM events GROUP BY user_id""")
def q_value_at_first(spark, sf_dir):
    return CK.first_values(Tables(spark, sf_dir).events, "user_id", "ts", "event_type", "event_id")


@register("time_arithmetic", f"""
WITH x AS (SELECT event_id, ts AS a, ts + INTERVAL 1 MICROSECOND * ((event_id * 7919) % 400000000 - 100000000) AS b
           FROM events),
y AS (SELECT event_id, a, b, date_diff('second', a, b) AS s FROM x)
SELECT event_id, s AS seconds, CAST(trunc(s / 3600) AS BIGINT) AS hours,
       CAST(trunc(date_diff('second', date_trunc('minute', a), date_trunc('minute', b)) / 60) AS BIGINT) AS minute_boundaries,
       CAST(round_even(s / 60.0, 0) AS BIGINT) AS minutes_elapsed, s / 60.0 AS minutes_float,
       printf('%02d:%02d:%02d', abs(s) // 3600, (abs(s) % 3600) // 60, abs(s) % 60) AS hhmmss,
       printf('%d:%02d:%02d', r // 3600, (r % 3600) // 60, r % 60) AS hms
FROM (SELECT *, CAST(round_even(abs(s) / 7.0, 0) AS BIGINT) AS r FROM y) z""")
def q_time_arithmetic(spark, sf_dir):
    e = Tables(spark, sf_dir).events.selectExpr(
        "event_id", "ts AS a", "ts + INTERVAL 1 MICROSECOND * ((event_id * 7919) % 400000000 - 100000000) AS b")
    return CK.time_arithmetic(e, "event_id", "a", "b")


_PARSE_KEYS = ("pumStudyReadyForAiTime", "pumReportSentTime", "pumReportLatestDicomInstanceTime")


def _parsed_sql() -> str:
    cols = []
    for k in _PARSE_KEYS:
        raw = JTEXT("computed_data", k)
        fixed = _fix60(raw)
        cols += [f"TRY_CAST({raw} AS TIMESTAMP) AS {k}_raw",
                 f"TRY_CAST({fixed} AS TIMESTAMP) AS {k}_ts",
                 f"coalesce(least(greatest(TRY_CAST({fixed} AS TIMESTAMP), TIMESTAMP '1971-01-01 00:00:00'), "
                 f"TIMESTAMP '2099-12-31 23:59:59'), TIMESTAMP '1971-01-01 00:00:00') AS {k}_clamped",
                 f"coalesce(CAST(TRY_CAST({fixed} AS TIMESTAMP) AS DATE), DATE '1900-01-01') AS {k}_date"]
    return with_roles("reports") + "SELECT report_key, " + ", ".join(cols) + " FROM reports"


@register("best_effort_parse", _parsed_sql())
def q_best_effort_parse(spark, sf_dir):
    return CK.parsed_times(Tables(spark, sf_dir).reports, ["report_key"], _PARSE_KEYS)


# ---- M6 overdue monitoring ----------------------------------------------------------

from martforge.plans import overdue as OV  # noqa: E402


@register("overdue_monitoring", with_roles("results", "pin_tasks", "clinical_events", "status_changes") + f""",
pins AS (SELECT accession_number, {LOCAL('max(task_pin_end_date)')} AS max_pin_date FROM pin_tasks
         WHERE accession_number IS NOT NULL GROUP BY accession_number),
b0 AS (SELECT r.*, p.max_pin_date, coalesce(p.max_pin_date, {LOCAL('r.conduct_date')}) AS effective_start_date,
              {LOCAL('r.doc_created')} AS doc_local
       FROM results r LEFT JOIN pins p ON r.accession_number = p.accession_number
       WHERE r.accession_number IS NOT NULL AND {LOCAL_DATE('r.doc_created')} BETWEEN DATE '{LO}' AND DATE '{HI}'),
b AS (SELECT *, CAST(trunc(date_diff('second', effective_start_date, doc_local) / 3600) AS BIGINT) AS hours_overdue
      FROM b0),
b2 AS (SELECT * FROM b WHERE hours_overdue >= 24),
ch AS (SELECT * FROM status_changes WHERE change_time BETWEEN TIMESTAMP '{LO}' - INTERVAL 14 DAY
                                           AND TIMESTAMP '{HI} 23:59:59'),
ce AS (SELECT CAST(patient_id AS VARCHAR) AS p, CAST(job_id AS VARCHAR) AS j, event_id FROM clinical_events
       WHERE event_id IN (SELECT DISTINCT event_id FROM ch)),
st AS (SELECT event_id,
              array_to_string(list_transform(list_sort(list({{'t': change_time, 's': status}})), lambda e: e.s), ' -> ') AS status_chain,
              count(*) FILTER (WHERE status = 'DEFERRED') AS cnt_deferred,
              min(change_time) FILTER (WHERE status = 'RUNNING') + INTERVAL 3 HOUR AS first_running,
              max(change_time) FILTER (WHERE status = 'RUNNING') + INTERVAL 3 HOUR AS last_running
       FROM ch GROUP BY event_id),
ae AS (SELECT DISTINCT b2.accession_number, ce.event_id FROM b2
       JOIN ce ON ce.p = CAST(b2.patient_key AS VARCHAR) AND ce.j = CAST(b2.job_id AS VARCHAR)),
pairs AS (
  SELECT b2.*, ae.event_id AS eid, st.status_chain, st.cnt_deferred, st.first_running, st.last_running
  FROM b2 LEFT JOIN ae ON ae.accession_number = b2.accession_number LEFT JOIN st ON st.event_id = ae.event_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY
           CASE WHEN eid IS NULL THEN 1 ELSE 0 END,
           CASE WHEN first_running IS NOT NULL THEN abs(date_diff('second', first_running, doc_local)) ELSE 0 END,
           eid, line_no, emp_id, diagnostic_code, payment_source, device_type, conduct_date) AS rn
  FROM pairs)
SELECT accession_number, patient_key AS patient_id, CAST(emp_id AS VARCHAR) AS assignment_result_emp_id,
       emp_fio AS assignment_result_emp_fio, diagnostic_name, conduct_mo_name, conduct_mu_name,
       {LOADED} AS load_datetime,
       payment_source, device_type, CAST(diagnostic_code AS VARCHAR) AS diagnostic_code,
       type_code AS assessment_result_type_code, describe_unit_id AS assignment_describe_mu_id,
       {LOCAL('conduct_date')} AS conduct_date, effective_start_date,
       CASE WHEN max_pin_date IS NOT NULL THEN 1 ELSE 0 END AS has_pin,
       doc_local AS assignment_result_doc_created_date, hours_overdue,
       CASE WHEN hours_overdue < 24 THEN 'Менее 24 часов' WHEN hours_overdue < 48 THEN 'Более 24 часов'
            ELSE 'Более 48 часов' END AS time_interval,
       CAST(eid AS VARCHAR) AS event_id, first_running, last_running,
       CASE WHEN first_running IS NOT NULL AND last_running IS NOT NULL THEN
            printf('%02d:%02d:%02d', date_diff('second', first_running, last_running) // 3600,
                   (date_diff('second', first_running, last_running) % 3600) // 60,
                   date_diff('second', first_running, last_running) % 60) END AS deferred_time_hhmmss,
       status_chain, coalesce(cnt_deferred, 0) AS cnt_deferred
FROM ranked WHERE rn = 1""")
def q_overdue_monitoring(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return OV.overdue_monitoring(t.results, t.pin_tasks, t.clinical_events, t.status_changes, AS_OF, DAYS, loaded_at=LOADED_AT)


# ---- M8 undescribed queue ------------------------------------------------------

from martforge.plans import queue as QU  # noqa: E402

QUEUE_AS_OF = dt.date(2001, 11, 4)
QUEUE_EXEMPT = (3,)


@register("undescribed_queue", with_roles("queue_examinations", "results", "pin_tasks", "trauma", "undescribed",
                                          "task_lists", "doctors", "employees", "benefits") + f""",
ear AS (SELECT accession_number, emp_fio AS eris_result_fio FROM (
          SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY doc_created DESC NULLS LAST,
                    emp_id, line_no, diagnostic_code) AS rn
          FROM results WHERE accession_number IS NOT NULL) x WHERE rn = 1),
ap AS (SELECT DISTINCT accession_number FROM pin_tasks WHERE task_pin_end_date IS NULL AND accession_number IS NOT NULL),
lp AS (SELECT accession_number, task_pin_status, task_pin_end_date FROM (
         SELECT *, row_number() OVER (PARTITION BY accession_number
                   ORDER BY task_pin_end_date DESC, task_pin_status, pin_id) AS rn
         FROM pin_tasks WHERE task_pin_end_date IS NOT NULL AND accession_number IS NOT NULL) x WHERE rn = 1),
tex AS (SELECT DISTINCT accession_number FROM trauma WHERE accession_number IS NOT NULL),
us AS (SELECT accession_number, status, reading_type_code, action, cito FROM (
         SELECT *, row_number() OVER (PARTITION BY accession_number
                   ORDER BY CASE WHEN action = 'DEL_ASSIGNMENT' THEN 0 ELSE 1 END, create_date DESC NULLS LAST,
                            status, reading_type_code, action, cito) AS rn
         FROM undescribed WHERE accession_number IS NOT NULL) x WHERE rn = 1),
mei AS (SELECT medical_employee_id, medical_employee_fio_obf, cur, min(sdate) AS mei_sdate, max(edate) AS mei_edate
        FROM employees WHERE edate >= DATE '2023-01-01' GROUP BY medical_employee_id, medical_employee_fio_obf, cur),
dd AS (SELECT doctor_id, medical_employee_id,
              CASE WHEN edate IS NULL OR edate = DATE '2299-12-31' THEN DATE '2099-12-31' ELSE edate END AS doc_edate
       FROM doctors WHERE edate >= DATE '2023-01-01'),
grm AS (SELECT dd.doctor_id, min(mei.medical_employee_fio_obf) AS fio FROM dd JOIN mei
          ON dd.medical_employee_id = mei.medical_employee_id AND dd.doc_edate BETWEEN mei.mei_sdate AND mei.mei_edate
        GROUP BY dd.doctor_id),
br AS (SELECT DISTINCT assignment_id, accession_number FROM queue_examinations WHERE assignment_id IS NOT NULL),
lt AS (SELECT accession_number, job_execution_id FROM (
         SELECT tl.*, br.accession_number, row_number() OVER (PARTITION BY br.accession_number
                   ORDER BY tl.personal_task_list_updated DESC NULLS LAST, tl.job_execution_id) AS rn
         FROM task_lists tl LEFT JOIN br ON tl.assignment_id = br.assignment_id
         WHERE br.accession_number IS NOT NULL) x WHERE rn = 1),
ltf AS (SELECT lt.accession_number, grm.fio AS task_list_fio FROM lt LEFT JOIN grm ON lt.job_execution_id = grm.doctor_id),
per AS (SELECT DISTINCT patient_id, start_date, coalesce(end_date, DATE '2099-12-31') AS end_date, benefit_name
        FROM benefits WHERE benefit_code IN ('940', '941') AND patient_status_id = '11' AND status_llo_id IN ('4')
          AND patient_id IS NOT NULL),
pairs AS (SELECT DISTINCT t.ae_title, e.research_id FROM trauma t JOIN queue_examinations e ON t.accession_number = e.accession_number
          WHERE t.ae_title IS NOT NULL AND e.research_id IS NOT NULL AND e.research_id NOT IN ({', '.join(map(str, QUEUE_EXEMPT))})
            AND CAST(t.assignment_signed_date AS DATE) >= DATE '{QUEUE_AS_OF}' - INTERVAL 14 DAY),
e AS (
  SELECT e.*, ear.eris_result_fio,
         CASE WHEN ap.accession_number IS NOT NULL THEN 'находится в ПИНе' ELSE 'не в ПИНе' END AS pin_status,
         lp.task_pin_end_date, lp.task_pin_status,
         CASE WHEN tex.accession_number IS NOT NULL THEN 'Травма' ELSE 'Не травма' END AS is_trauma_exam,
         us.status AS undescr_status, us.reading_type_code AS undescr_reading_type, us.action AS undescr_action,
         us.cito AS undescr_cito, ltf.task_list_fio,
         (SELECT arg_min(p.benefit_name, (-(p.start_date - DATE '1970-01-01'), p.benefit_name)) FROM per p
           WHERE p.patient_id = e.patient_id AND CAST(e.conduct_date AS DATE) BETWEEN p.start_date AND p.end_date)
           AS llo_benefit_status
  FROM queue_examinations e
  LEFT JOIN ear ON e.accession_number = ear.accession_number
  LEFT JOIN ap ON e.accession_number = ap.accession_number
  LEFT JOIN lp ON e.accession_number = lp.accession_number
  LEFT JOIN tex ON e.accession_number = tex.accession_number
  LEFT JOIN us ON e.accession_number = us.accession_number
  LEFT JOIN ltf ON e.accession_number = ltf.accession_number
  WHERE CAST(e.conduct_date AS DATE) >= DATE '{LO}' AND e.ae_title IS NOT NULL AND e.accession_number IS NOT NULL
    AND e.assignment_status != 'F'
    AND NOT EXISTS (SELECT 1 FROM pairs p WHERE p.ae_title = e.ae_title AND p.research_id = e.research_id)),
q AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY conduct_date,
                     eris_result_fio, task_list_fio, undescr_status) AS rn FROM e) x
      WHERE rn = 1 AND is_trauma_exam != 'Травма' AND (undescr_action IS NULL OR undescr_action != 'DEL_ASSIGNMENT'))
SELECT assignment_conduct_id, conduct_date, conduct_doc_id, conduct_doc_cct, conduct_doc_author_job_execution_id, conduct_doc_author_id,
       conduct_doc_author_fio, conduct_mu_id, conduct_mo_id, conduct_mu_name, conduct_mo_name, district_short_name, assignment_id,
       assignment_status, assignment_mu_id, assignment_mo_id, assignment_mu_name, assignment_mo_name, research_id, research_name,
       research_subtype_id, research_subtype_name, research_type_id, research_type, research_kind_id, research_kind, device_type,
       body_part, diagnosis_code, patient_id, patient_birth_date, patient_age, patient_gender, technician_job_execution_id,
       technician_id, technician_fio, payment_source, accession_number, ae_title, equipment_result_date, study_uid, url, is_contrast,
       dose_msv, dose_micro_sv, model_name, eris_result_fio, pin_status, task_pin_end_date, task_pin_status, is_trauma_exam,
       undescr_status, undescr_reading_type, undescr_action, undescr_cito, task_list_fio, llo_benefit_status,
       max(conduct_date) OVER () AS meta_load_date, {LOADED} AS load_datetime
FROM q""")
def q_undescribed_queue(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return QU.undescribed_queue(t.queue_examinations, t.results, t.pin_tasks, t.trauma, t.undescribed, t.task_lists,
                                t.doctors, t.employees, t.benefits, dt.date.fromisoformat(LO), QUEUE_AS_OF, "F",
                                exempt=QUEUE_EXEMPT, loaded_at=LOADED_AT)


# ---- load policies and streaming, run end to end into scratch storage ----------------

import uuid  # noqa: E402

from martforge.session import scratch_path  # noqa: E402
from martforge.sinks import policies as K  # noqa: E402
from martforge.streaming import jobs as R  # noqa: E402


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


@register("window_replace", ORACLE["unit_summary"])
def q_window_replace(spark, sf_dir):
    """K1 twice (full window, then a reload of the later months) and read the
    target back. The demo target spans seven years, so it is partitioned by
    conduct month rather than by day (about 80 folders instead of 2,500)."""
    path = _scratch(spark, "unit_summary")
    lo, hi = dt.date(1994, 1, 1), AS_OF

    def extract():
        return q_unit_summary(spark, sf_dir).withColumn("conduct_month", F.trunc("conduct_date", "MM"))
    K.replace_window(extract(), path, "conduct_month", lo, hi)
    sub_lo = dt.date(1999, 1, 1)
    K.replace_window(extract().where(F.col("conduct_month") >= F.lit(sub_lo)), path, "conduct_month", sub_lo, hi)
    return spark.read.parquet(path).drop("conduct_month")


@register("insert_unseen", with_roles("id_lists", "stored_ids") + f""",
n AS (SELECT CASE WHEN regexp_matches(s, '^[0-9]') THEN 'A' || s ELSE s END AS s FROM (SELECT {_NORM} AS s FROM id_lists) x),
v AS (SELECT DISTINCT upper(s) AS accession FROM n WHERE regexp_matches(s, '^[A-Za-z][0-9]{{5,}}$'))
SELECT accession FROM stored_ids
UNION ALL
SELECT accession FROM v WHERE accession NOT IN (SELECT accession FROM stored_ids WHERE accession IS NOT NULL)""")
def q_insert_unseen(spark, sf_dir):
    """K5: the store starts as the stored ids; the new normalised ids are inserted twice
    (the second insert adds nothing)."""
    t = Tables(spark, sf_dir)
    path = _scratch(spark, "ids")
    t.stored_ids.write.parquet(path)
    new = t.id_lists.select(RG.norm_accession("raw_id").alias("accession")).where(F.col("accession").isNotNull())
    K.insert_unseen(new, path, "accession")
    K.insert_unseen(new, path, "accession")
    return spark.read.parquet(path)


@register("schema_evolve", with_roles("examinations") + """
SELECT accession_number, conduct_date, '' AS research_kind, 0 AS patient_age FROM examinations
UNION ALL
SELECT accession_number, conduct_date, research_kind, patient_age FROM examinations WHERE accession_number IS NOT NULL""")
def q_schema_evolve(spark, sf_dir):
    """K6: stored rows lack two columns that the new extract has; defaults fill them."""
    e = Tables(spark, sf_dir).examinations
    old = e.select("accession_number", "conduct_date")
    new = e.where(F.col("accession_number").isNotNull()).select("accession_number", "conduct_date",
                                                                "research_kind", "patient_age")
    return K.align_schema(old, new)


@register("stream_event_dedupe", with_roles("etl_events") + "SELECT DISTINCT entity, loaded FROM etl_events")
def q_stream_event_dedupe(spark, sf_dir):
    """R2: the event log arrives twice as files; the stream keeps one row per (entity, loaded)."""
    src, dst, ck = (_scratch(spark, n) for n in ("ev-src", "ev-log", "ev-ck"))
    ev = Tables(spark, sf_dir).etl_events.select("entity", F.col("loaded").cast("timestamp").alias("loaded"))
    ev.write.parquet(src)
    ev.write.mode("append").parquet(src)
    R.stream_event_log(spark, src, dst, ck, ev.schema, max_files=1).awaitTermination()
    return spark.read.parquet(dst).select("entity", F.col("loaded").cast("timestamp_ntz").alias("loaded"))


@register("stream_id_sync", ORACLE["accession_sync"].replace(
    "SELECT accession FROM v WHERE accession NOT IN (SELECT accession FROM stored_ids WHERE accession IS NOT NULL)",
    "SELECT accession FROM v"))
def q_stream_id_sync(spark, sf_dir):
    """Raw id files arrive in a folder; the stream normalises and stores each id once."""
    src, dst, ck = (_scratch(spark, n) for n in ("ids-src", "ids-dst", "ids-ck"))
    Tables(spark, sf_dir).id_lists.repartition(8).write.option("header", False).csv(src)
    R.stream_ids(spark, src, dst, ck, glob="*.csv", max_files=2).awaitTermination()
    return spark.read.parquet(dst)


from martforge.plans import load_queries  # noqa: E402,F401  (registers its queries)

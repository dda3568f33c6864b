"""Driver tables -> reference-shaped role tables.

The marts are written against the reference's vocabulary (examinations,
assignment results, AI reports, AI viewer log, ...). The driver data is a
TPC-H-like star schema, so each role is a *projection* of one driver table:
renames plus row-wise derivations, never a filter, never a join. Each
expression is plain SQL valid in Spark SQL and in DuckDB, so the DuckDB
oracle reads the very same role rows (as CTEs) while the mart logic on each
side is written independently.

Projection happens before anything else, so column pruning reaches the
parquet scan: a mart that needs three role columns reads three (or fewer)
driver columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Series UID of an AI model run: '1.2.643.<study>.<model>.1'; some lines carry a
# device's own UID instead (no model part, a bare number, or a timestamp part).
SERIES_UID = (
    "CASE WHEN l_linenumber = 5 THEN concat('1.2.840.', CAST(l_orderkey AS STRING)) "
    "WHEN l_linenumber = 6 THEN CAST(l_orderkey AS STRING) "
    "WHEN l_linenumber = 7 THEN concat('1.2.', CAST(20240101000000 + l_orderkey AS STRING), '.1') "
    "ELSE concat('1.2.643.', CAST(l_orderkey AS STRING), '.', CAST(1095 + l_suppkey % 5 AS STRING), '.1') END")

# role -> (driver table, [(column, expression)])
ROLES: dict[str, tuple[str, list[tuple[str, str]]]] = {
    # One row per accession (examination).
    "examinations": ("orders", [
        ("accession_number", "o_orderkey"),
        ("study_uid", "CAST(o_orderkey AS STRING)"),
        ("conduct_date", "o_orderdate"),
        ("patient_id", "o_custkey"),
        ("assignment_status", "o_orderstatus"),
        ("research_kind", "o_orderpriority"),
        ("payment_source", "NULLIF(o_orderstatus, 'P')"),
        ("patient_age", "CAST(floor(o_totalprice / 10000) AS BIGINT)"),
        ("research_id", "CAST(floor(o_totalprice / 50000) AS BIGINT)"),
        ("ae_title", "concat('AE', CAST(o_custkey % 40 AS STRING))"),
        ("assignment_id", "o_orderkey"),
        ("assignment_mu_id", "CAST(o_custkey % 1000 AS STRING)"),
    ]),
    # The same examinations with everything that the undescribed-study queue shows of them.
    "queue_examinations": ("orders", [
        ("assignment_conduct_id", "o_orderkey * 3 + 1"),
        ("conduct_date", "o_orderdate"),
        ("conduct_doc_id", "o_orderkey * 2"),
        ("conduct_doc_cct", "o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 90)"),
        ("conduct_doc_author_job_execution_id", "o_custkey % 500"),
        ("conduct_doc_author_id", "o_custkey % 300"),
        ("conduct_doc_author_fio", "concat('лаборант ', CAST(o_custkey % 300 AS STRING))"),
        ("conduct_mu_id", "CAST(o_custkey % 1000 AS STRING)"),
        ("conduct_mo_id", "CAST(o_custkey % 90 AS STRING)"),
        ("conduct_mu_name", "concat('МУ ', CAST(o_custkey % 1000 AS STRING))"),
        ("conduct_mo_name", "concat('МО ', CAST(o_custkey % 90 AS STRING))"),
        ("district_short_name", "CASE WHEN o_custkey % 13 = 0 THEN NULL ELSE concat('округ ', CAST(o_custkey % 12 AS STRING)) END"),
        ("assignment_id", "o_orderkey"),
        ("assignment_status", "o_orderstatus"),
        ("assignment_mu_id", "CAST(o_custkey % 700 AS STRING)"),
        ("assignment_mo_id", "CAST(o_custkey % 70 AS STRING)"),
        ("assignment_mu_name", "concat('МУ ', CAST(o_custkey % 700 AS STRING))"),
        ("assignment_mo_name", "concat('МО ', CAST(o_custkey % 70 AS STRING))"),
        ("research_id", "CAST(floor(o_totalprice / 50000) AS BIGINT)"),
        ("research_name", "concat('исследование ', CAST(CAST(floor(o_totalprice / 50000) AS BIGINT) AS STRING))"),
        ("research_subtype_id", "o_orderkey % 17"),
        ("research_subtype_name", "concat('подтип ', CAST(o_orderkey % 17 AS STRING))"),
        ("research_type_id", "o_orderkey % 6"),
        ("research_type", "concat('тип ', CAST(o_orderkey % 6 AS STRING))"),
        ("research_kind_id", "CAST(substr(o_orderpriority, 1, 1) AS INT)"),
        ("research_kind", "o_orderpriority"),
        ("device_type", "CASE o_orderkey % 4 WHEN 0 THEN 'CT' WHEN 1 THEN 'MR' WHEN 2 THEN 'DX' ELSE 'MG' END"),
        ("body_part", "CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE concat('часть ', CAST(o_orderkey % 8 AS STRING)) END"),
        ("diagnosis_code", "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE concat('Z', CAST(o_orderkey % 100 AS STRING)) END"),
        ("patient_id", "o_custkey"),
        ("patient_birth_date", "DATE '1930-01-01' + CAST(o_custkey % 30000 AS INT)"),
        ("patient_age", "CAST(floor(o_totalprice / 10000) AS BIGINT)"),
        ("patient_gender", "CASE o_custkey % 3 WHEN 0 THEN 'М' WHEN 1 THEN 'Ж' ELSE NULL END"),
        ("technician_job_execution_id", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 400 END"),
        ("technician_id", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 200 END"),
        ("technician_fio", "CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE concat('техник ', CAST(o_custkey % 200 AS STRING)) END"),
        ("payment_source", "NULLIF(o_orderstatus, 'P')"),
        ("accession_number", "o_orderkey"),
        ("ae_title", "concat('AE', CAST(o_custkey % 40 AS STRING))"),
        ("equipment_result_date", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 600) END"),
        ("study_uid", "CAST(o_orderkey AS STRING)"),
        ("url", "concat('https://viewer.test/', CAST(o_orderkey AS STRING))"),
        ("is_contrast", "CAST(o_orderkey % 2 AS INT)"),
        ("dose_msv", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) / 4 END"),
        ("dose_micro_sv", "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 50 AS DOUBLE) * 250 END"),
        ("model_name", "concat('аппарат ', CAST(o_custkey % 40 AS STRING))"),
    ]),
    # Many rows per accession (one per described service line).
    "results": ("lineitem", [
        ("accession_number", "l_orderkey"),
        ("study_uid", "CAST(l_orderkey AS STRING)"),
        ("line_no", "l_linenumber"),
        ("emp_id", "l_suppkey"),
        ("describe_unit_id", "CAST(l_suppkey AS STRING)"),
        ("diagnostic_code", "l_partkey"),
        ("type_code", "l_linenumber"),
        ("payment_source", "l_returnflag"),
        ("device_type", "l_linestatus"),
        ("doc_created", "l_shipdate"),
        ("conduct_date",
         "l_shipdate - INTERVAL 1 HOUR * (CAST(l_quantity AS INT) * 2 - 10)"
         " - INTERVAL 1 MINUTE * (l_linenumber * 7)"),
        ("describe_start",
         "l_shipdate - INTERVAL 1 SECOND * (CAST(l_quantity AS INT) * 450 + l_linenumber * 3 - 20)"),
        ("amount", "l_extendedprice"),
        ("patient_key", "CAST(l_suppkey AS STRING)"),
        ("job_id", "l_partkey % 3"),
        ("emp_fio", "concat('врач ', CAST(l_suppkey AS STRING))"),
        ("diagnostic_name", "concat('услуга ', CAST(l_partkey % 50 AS STRING))"),
        ("diag_code", "CASE WHEN l_partkey % 5 = 0 THEN '' ELSE concat('Z', CAST(l_partkey % 100 AS STRING)) END"),
        ("conduct_mo_name", "concat('МО ', CAST(l_suppkey % 7 AS STRING))"),
        ("conduct_mu_name", "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE concat('МУ ', CAST(l_partkey % 11 AS STRING)) END"),
        ("conduct_district_name", "concat('округ ', CAST(l_suppkey % 12 AS STRING))"),
        ("patient_gender", "CASE l_linenumber % 3 WHEN 0 THEN 'М' WHEN 1 THEN 'Ж' ELSE NULL END"),
        ("assignment_status", "CASE WHEN l_partkey % 8 = 0 THEN 'В работе' WHEN l_partkey % 53 = 0 THEN NULL ELSE 'Выполнено' END"),
    ]),
    # Units (describing departments): id -> short name.
    "units": ("supplier", [
        ("unit_id", "CAST(s_suppkey AS STRING)"),
        ("unit_name", "s_name"),
        ("region_id", "s_nationkey"),
    ]),
    # Procedure dimension source (codes with a service type and zone count).
    "procedures": ("part", [
        ("diagnostic_code", "p_partkey"),
        ("procedure_name", "p_name"),
        ("family",
         "CASE p_type WHEN 'STANDARD' THEN 'КТ' WHEN 'MEDIUM' THEN 'КТ с КУ' WHEN 'PROMO' THEN 'МРТ' "
         "WHEN 'LARGE' THEN 'МРТ с КУ' WHEN 'SMALL' THEN 'РГ' ELSE 'ММГ' END"),
        ("zones", "CAST(p_size % 4 AS INT) + 1"),
    ]),
    # AI reports (one per described line): raw / computed JSON text; raw may
    # be the literal 'null'; a few sent times carry a ':60' leap second.
    "reports": ("lineitem", [
        ("report_key", "l_orderkey * 10 + l_linenumber"),
        ("app_source", "CASE WHEN l_returnflag = 'A' AND l_linenumber = 7 THEN 'PACS' ELSE 'CDS' END"),
        ("raw_data",
         "CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN 'null' ELSE concat("
         "'{\"studyIUID\": \"', CAST(l_orderkey AS STRING), '\", \"aiResult\": {\"norma\": \"', "
         "CAST(l_partkey % 2 AS STRING), '\", \"seriesIUID\": \"', " + SERIES_UID + ", "
         "'\", \"modelId\": ', CAST(1095 + l_suppkey % 5 AS STRING), ', \"error\": \"', "
         "CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'timeout' ELSE '' END, '\"}}') END"),
        ("computed_data",
         "concat('{\"studyUid\": \"', CAST(l_orderkey AS STRING), '\", \"modelId\": ', "
         "CAST(1095 + l_suppkey % 5 AS STRING), ', \"pumStudyReadyForAiTime\": \"', "
         "CAST(l_shipdate - INTERVAL 1 MINUTE * l_suppkey AS STRING), '\", \"pumReportSentTime\": \"', "
         "CASE WHEN l_partkey % 97 = 0 THEN concat(substr(CAST(l_shipdate AS STRING), 1, 10), ' 12:30:60') "
         "ELSE CAST(l_shipdate + INTERVAL 1 SECOND * (l_partkey % 900) AS STRING) END, "
         "'\", \"pumReportLatestDicomInstanceTime\": \"', "
         "CAST(l_shipdate + INTERVAL 1 SECOND * (l_suppkey * 3) AS STRING), '\"}')"),
    ]),
    # AI viewer log (one event per line, 1-3 events per series).
    "ai_log": ("lineitem", [
        ("study_iuid", "CAST(l_orderkey AS STRING)"),
        ("series_iuid", SERIES_UID),
        ("opened_at", "l_shipdate - INTERVAL 1 MINUTE * (l_partkey % 500)"),
        ("modality", "CASE l_returnflag WHEN 'A' THEN 'CT' WHEN 'N' THEN 'MR' ELSE 'ASMT' END"),
        ("procedure_name",
         "CASE l_partkey % 6 WHEN 0 THEN 'AI_AUTO_LOAD' WHEN 1 THEN 'AI_AUTO_GRID' "
         "WHEN 2 THEN 'AI_MANUAL_LOAD' WHEN 3 THEN 'AI_VIEW_START' WHEN 4 THEN 'AI_VIEW_END' "
         "ELSE 'AI_VIEW_ENLARGE' END"),
        ("access_method",
         "CASE l_suppkey % 4 WHEN 0 THEN 'MANUAL_LOAD' WHEN 1 THEN 'SCROLL' WHEN 2 THEN 'AUTO_LOAD' "
         "ELSE 'AUTO_GRID' END"),
    ]),
    # Source-refresh events (entity, load time).
    "etl_events": ("events", [
        ("entity", "event_type"),
        ("loaded", "ts"),
        ("load_id", "event_id"),
    ]),
    # Pin tasks: several per accession, some still open (NULL end).
    "pin_tasks": ("orders", [
        ("accession_number", "o_custkey * 10"),
        ("task_pin_status", "o_orderpriority"),
        ("task_pin_send_date", "o_orderdate"),
        ("task_pin_end_date",
         "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 200) END"),
        ("pin_id", "o_orderkey"),
    ]),
    # Benefit validity periods per patient (open end = NULL).
    "benefits": ("orders", [
        ("patient_id", "o_custkey"),
        ("start_date", "CAST(o_orderdate AS DATE)"),
        ("end_date",
         "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INT) END"),
        ("benefit_name", "o_orderpriority"),
        ("benefit_code", "CASE WHEN o_orderstatus = 'P' THEN '999' WHEN o_custkey % 2 = 0 THEN '941' ELSE '940' END"),
        ("patient_status_id", "CASE WHEN o_orderkey % 9 = 0 THEN '12' WHEN o_orderkey % 31 = 0 THEN NULL ELSE '11' END"),
        ("status_llo_id", "CASE WHEN o_orderkey % 7 = 0 THEN '3' ELSE '4' END"),
    ]),
    # Trauma-route records: (device, procedure) pairs per accession.
    "trauma": ("customer", [
        ("accession_number", "c_custkey * 7"),
        ("ae_title", "concat('AE', CAST(c_custkey % 40 AS STRING))"),
        ("research_id", "CAST(c_nationkey % 6 AS BIGINT)"),
        ("assignment_signed_date", "TIMESTAMP '2001-10-25 00:00:00' + INTERVAL 1 HOUR * (c_custkey % 300)"),
    ]),
    # Undescribed-study queue events: several per accession, some DEL_ASSIGNMENT.
    "undescribed": ("lineitem", [
        ("accession_number", "l_orderkey"),
        ("status", "l_linestatus"),
        ("reading_type_code", "l_returnflag"),
        ("action", "CASE WHEN l_linenumber >= 6 AND l_returnflag = 'R' THEN 'DEL_ASSIGNMENT' ELSE concat('ACT', CAST(l_linenumber AS STRING)) END"),
        ("cito", "CASE WHEN l_discount > 0.05 THEN '1' ELSE '0' END"),
        ("create_date", "l_shipdate + INTERVAL 1 MINUTE * l_partkey"),
    ]),
    # Staff: doctor jobs and employee records with validity dates (2299-12-31 = open).
    "doctors": ("supplier", [
        ("doctor_id", "s_suppkey"),
        ("medical_employee_id", "s_nationkey"),
        ("sdate", "DATE '1990-01-01' + CAST(s_suppkey AS INT)"),
        ("edate", "CASE WHEN s_suppkey % 5 = 0 THEN DATE '2299-12-31' ELSE DATE '1996-01-01' + CAST(s_suppkey * 20 AS INT) END"),
        ("cur", "CAST(s_suppkey % 2 AS INT)"),
    ]),
    "employees": ("nation", [
        ("medical_employee_id", "n_nationkey"),
        ("medical_employee_fio_obf", "n_name"),
        ("sdate", "DATE '1995-01-01' + CAST(n_regionkey * 200 AS INT)"),
        ("edate", "CASE WHEN n_nationkey % 4 = 0 THEN DATE '2099-12-31' ELSE DATE '2000-06-01' + CAST(n_nationkey * 30 AS INT) END"),
        ("cur", "CAST(n_nationkey % 2 AS INT)"),
    ]),
    "task_lists": ("lineitem", [
        ("assignment_id", "l_orderkey"),
        ("job_execution_id", "l_suppkey"),
        ("task_status_code", "l_linestatus"),
        ("personal_task_list_updated", "l_shipdate + INTERVAL 1 MINUTE * (l_linenumber * 13 + l_partkey % 7)"),
    ]),
    # Raw re-shoot id texts (spaces, Cyrillic letter, no letter, too short, junk).
    "id_lists": ("orders", [
        ("raw_id",
         "CASE o_orderpriority WHEN '1-URGENT' THEN concat('А', CAST(o_orderkey * 7 AS STRING)) "
         "WHEN '2-HIGH' THEN concat(' ', CAST(o_orderkey * 7 AS STRING), ' 1') "
         "WHEN '3-MEDIUM' THEN concat('a', CAST(o_orderkey * 7 AS STRING)) "
         "WHEN '4-NOT SPECIFIED' THEN CAST(o_orderkey % 10000 AS STRING) "
         "ELSE concat('x-', CAST(o_orderkey AS STRING)) END"),
    ]),
    # Inpatient equipment orders (some without a study UID) and their exams.
    "inpatient_orders": ("orders", [
        ("naz_id", "o_orderkey"),
        ("run_dt", "o_orderdate"),
        ("facility_id", "CAST(o_custkey % 25 AS STRING)"),
        ("device_type", "o_orderstatus"),
        ("ae_title", "concat('AE', CAST(o_custkey % 40 AS STRING))"),
        ("naz_code", "o_orderpriority"),
        ("naz_name", "concat('procedure ', o_orderpriority)"),
        ("accession_number", "o_orderkey"),
        ("studyuid", "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderkey AS STRING) END"),
    ]),
    "inpatient_exams": ("lineitem", [
        ("naz_id", "l_orderkey"),
        ("patient_id", "CAST(l_partkey AS STRING)"),
        ("pay_type_name", "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END"),
        ("sign_emp_id", "CAST(l_suppkey AS STRING)"),
    ]),
    "facilities": ("nation", [
        ("id", "CAST(n_nationkey AS STRING)"),
        ("short_name", "n_name"),
    ]),
    # CRM items: scalar, list, boolean and missing values; user and stage refs.
    "crm_items": ("customer", [
        ("id", "c_custkey"),
        ("employee", "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_custkey % 60 END"),
        ("created_by", "c_nationkey"),
        ("assigned_by_id", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey % 120 END"),
        ("stage_id", "c_mktsegment"),
        ("kpe_document", ("array(c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'signed' END)",
                          "[c_mktsegment, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'signed' END]")),
        ("kpe_size", "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal > 5000 END"),
        ("voting_status_9", ("array(CASE WHEN c_custkey % 3 = 0 THEN 'за' END, c_mktsegment)",
                             "[CASE WHEN c_custkey % 3 = 0 THEN 'за' END, c_mktsegment]")),
        ("commission_member_9", "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_nationkey * 3 END"),
        ("department_parus", "concat(' отдел ', CAST(c_nationkey % 8 AS STRING), ' ')"),
        ("additional_info", "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END"),
        ("reregistration", "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 2 = 0 END"),
        ("labor_code_article", "CASE WHEN c_nationkey % 2 = 0 THEN 'ст. 77' ELSE '' END"),
        ("dismissal_reason", "NULLIF(c_mktsegment, 'BUILDING')"),
        ("descriptions_count", "c_acctbal"),
        ("dismissal_date",
         "CASE WHEN c_custkey % 7 = 0 THEN 'not a date' WHEN c_custkey % 11 = 0 THEN NULL "
         "ELSE CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INT) AS STRING) END"),
    ]),
    "crm_users": ("supplier", [
        ("ID", "s_suppkey"),
        ("LAST_NAME", "s_name"),
        ("NAME", "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat('N', CAST(s_nationkey AS STRING)) END"),
        ("SECOND_NAME", "CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE 'M' END"),
    ]),
    # Web registry rows: task code (URL host), status text and page HTML.
    "registry_rows": ("pages", [
        ("seq", "page_id"),
        ("code", "regexp_extract(url, '://([^/:#?]+)', 1)"),
        ("request_id", "CASE WHEN page_id % 4 = 0 THEN NULL ELSE CAST(page_id AS STRING) END"),
        ("created_at", "concat('<b>', CAST(DATE '2024-01-01' + CAST(page_id % 300 AS INT) AS STRING), '</b> 10:00')"),
        ("medservice_name", "concat('<i>услуга</i> ', CAST(page_id % 6 AS STRING))"),
        ("source_name", "CASE WHEN page_id % 5 = 0 THEN NULL ELSE url END"),
        ("organization_fmt", "concat('<a href=\"/o\">', url, '</a>')"),
        ("responsible_name", "concat('  врач   ', CAST(page_id % 9 AS STRING))"),
        ("work_type_name", "CASE WHEN page_id % 2 = 0 THEN 'КТ' ELSE '<br/>' END"),
        ("load_rate", "CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id % 11 END"),
        ("sla_time", "concat(CAST(page_id % 48 AS STRING), '<sup>ч</sup>')"),
        ("status_text",
         "CASE WHEN url LIKE 'https:%' THEN ' Новая ' WHEN url LIKE '%#%' THEN 'В работе' ELSE 'archived' END"),
        ("orthanc_html", "replace(replace(html, '<li>', '<span class=\"z\">'), '</li>', '</span>')"),
        ("doc_list", "CASE WHEN page_id % 10 = 0 THEN NULL WHEN page_id % 10 = 1 THEN '' ELSE 'list' END"),
        ("detail_html",
         "replace(replace(html, 'href=\"/', concat('href=\"https://files.test/docs/', CAST(page_id AS STRING), '/')),"
         " 'href=\"#', 'href=\"https://files.test/other/')"),
    ]),
    # Ids of dental requests (NULL for the others).
    "dentistry": ("pages", [
        ("id", "CASE WHEN page_id % 3 = 0 THEN regexp_extract(url, '://([^/:#?]+)', 1) END"),
    ]),
    # Clinical events per (patient, doctor job) and their status changes.
    "clinical_events": ("orders", [
        ("event_id", "o_orderkey"),
        ("patient_id", "o_custkey % 100"),
        ("job_id", "o_orderkey % 3"),
    ]),
    "status_changes": ("lineitem", [
        ("event_id", "l_orderkey"),
        ("change_time", "l_shipdate + INTERVAL 1 HOUR * l_linenumber"),
        ("status",
         "CASE WHEN l_linenumber IN (2, 5) THEN 'RUNNING' WHEN l_returnflag = 'R' THEN 'DEFERRED' ELSE 'DONE' END"),
    ]),
    # Referral routes: the referring doctor's job per accession (several rows).
    "routes": ("lineitem", [
        ("eris_id", "l_orderkey"),
        ("assignment_doctor_job_name", "concat('job ', CAST(l_suppkey % 7 AS STRING))"),
    ]),
    # Ids already stored in the target.
    "stored_ids": ("lineitem", [
        ("accession", "concat('A', CAST(l_partkey * 7 AS STRING))"),
    ]),
}


def _expr(e, dialect: str) -> str:
    """An expression is shared SQL text, or a (spark, duckdb) pair where the
    two dialects spell a construct differently (array literals)."""
    if isinstance(e, tuple):
        return e[0] if dialect == "spark" else e[1]
    return e


def role_sql(role: str) -> str:
    """``SELECT <exprs> FROM <driver table>`` for a role (used by the oracle)."""
    table, cols = ROLES[role]
    return "SELECT " + ", ".join(f"{_expr(e, 'duckdb')} AS {n}" for n, e in cols) + f" FROM {table}"


def with_roles(*roles: str) -> str:
    """``WITH role AS (...), ...`` prefix for oracle SQL."""
    return "WITH " + ",\n".join(f"{r} AS ({role_sql(r)})" for r in roles) + "\n"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table; its splits follow ``spark.sql.files.maxPartitionBytes`` and ``minPartitionNum``."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The role table as a lazy projection of its driver parquet."""
    table, cols = ROLES[name]
    return load(spark, sf_dir, table).selectExpr(*[f"{_expr(e, 'spark')} AS {n}" for n, e in cols])


class Tables:
    """Lazy role/driver table access for one ``sf_dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in ROLES:
            return role(self.spark, self.sf_dir, name)
        return load(self.spark, self.sf_dir, name)

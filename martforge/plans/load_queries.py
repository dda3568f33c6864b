"""Registered queries of load policies, readers and small operators, each over whole driver tables with a DuckDB twin.

The load queries write versioned tables into scratch storage and read them back; the operator queries cover what no mart
uses by its function.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.functions import bool_text, case, null_if, num_or, norm_accession, to_str, wall_time
from martforge.operators import aggregates as A
from martforge.operators import filters as Fl
from martforge.operators import joins as J
from martforge.operators import setops as U
from martforge.operators import windows as W
from martforge.plans import catalog as C
from martforge.plans import loads as L
from martforge.plans.bindings import Tables, with_roles
from martforge.plans.catalog import ORACLE, _scratch, register
from martforge.session import stored
from martforge.sinks import policies as K
from martforge.sinks.versioned import VersionedTable
from martforge.sources import readers as S


def _table(spark, name: str) -> VersionedTable:
    return VersionedTable(spark, _scratch(spark, name))


# ---- load policies -----------------------------------------------------------------

@register("load_window", ORACLE["unit_summary"])
def q_load_window(spark, sf_dir):
    """K1, K9: all months, then the later ones again, then an empty extract; day folders stand for months here."""
    table, lo, mid = _table(spark, "unit-summary"), dt.date(1994, 1, 1), dt.date(1999, 1, 1)
    mart = C.QUERIES["unit_summary"](spark, sf_dir).withColumn("conduct_month", F.trunc("conduct_date", "MM"))
    table.replace_window(mart, "conduct_month", lo, C.AS_OF)
    again = table.read(version=1).where(F.col("conduct_month") >= F.lit(mid))
    table.replace_window(again, "conduct_month", mid, C.AS_OF)
    table.replace_window(again.where("false"), "conduct_month", mid, C.AS_OF)
    return table.read().drop("conduct_month")


@register("load_whole", ORACLE["describe_time_daily"])
def q_load_whole(spark, sf_dir):
    """K2, K9: the mart replaces an older content; an empty extract changes nothing."""
    table, mart = _table(spark, "describe-time"), C.QUERIES["describe_time_daily"](spark, sf_dir)
    table.overwrite(mart.limit(0), skip_empty=False)
    L.load("describe_time_daily", mart, table, C.AS_OF)
    L.load("describe_time_daily", table.read().where("false"), table, C.AS_OF)
    return table.read()


@register("load_snapshots", with_roles("etl_events") + """
SELECT entity, loaded, CASE WHEN CAST(loaded AS DATE) > DATE '2024-01-20' THEN load_id ELSE 0 END AS load_id
FROM etl_events WHERE CAST(loaded AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-01-31'""")
def q_load_snapshots(spark, sf_dir):
    """K3, K6: three loads of the event log by day, kept for 15 days; the last one brings a column that the others lack."""
    events, table = Tables(spark, sf_dir).etl_events, _table(spark, "event-days")
    day, before = F.to_date("loaded"), dt.date(2023, 12, 31)
    for until in (dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 1, 30)):
        rows = events.where((day > F.lit(before)) & (day <= F.lit(until)))
        table.append_retain(rows if until.day == 30 else rows.drop("load_id"), "loaded", until, 15)
        before = until
    last = events.where(day > F.lit(before))
    table.append_retain(last, "loaded", before, 15)
    return table.read()


@register("load_upsert", with_roles("results") + """,
l2 AS (SELECT accession_number, line_no, diagnostic_code, doc_created FROM results WHERE line_no >= 3),
u AS (SELECT * FROM l2 UNION ALL
      SELECT accession_number, line_no, diagnostic_code, doc_created FROM results r WHERE line_no <= 4 AND NOT EXISTS (
        SELECT 1 FROM l2 WHERE l2.accession_number = r.accession_number AND l2.doc_created = r.doc_created))
SELECT accession_number, line_no, diagnostic_code, doc_created FROM (
  SELECT *, rank() OVER (PARTITION BY accession_number ORDER BY doc_created DESC NULLS LAST) AS rk FROM u) x WHERE rk = 1""")
def q_load_upsert(spark, sf_dir):
    """K4: two loads with common keys and versions, the second one twice; ranges of keys as files."""
    r = Tables(spark, sf_dir).results.select("accession_number", "line_no", "diagnostic_code", "doc_created")
    table = _table(spark, "results")
    for rows in (r.where("line_no <= 4"), r.where("line_no >= 3"), r.where("line_no >= 3")):
        table.upsert_latest(rows, "accession_number", "doc_created", rows_per_file=100_000)
    return table.read()


@register("refresh_dependents", with_roles("results", "units") + """,
u AS (SELECT describe_unit_id, count(*) AS n FROM results GROUP BY describe_unit_id),
a AS (SELECT region_id, sum(n) AS n_results FROM u JOIN units ON describe_unit_id = unit_id GROUP BY region_id),
b AS (SELECT region_id, max(n) AS busiest FROM u JOIN units ON describe_unit_id = unit_id GROUP BY region_id)
SELECT a.region_id, CAST(n_results AS BIGINT) AS n_results, busiest FROM a JOIN b ON a.region_id = b.region_id""")
def q_refresh_dependents(spark, sf_dir):
    """K8: results per unit, two marts from it, a fourth from both; a second refresh has nothing to do."""
    t = Tables(spark, sf_dir)
    tables = {n: _table(spark, n) for n in ("per_unit", "per_region", "busiest", "regions")}
    units = t.units.withColumnRenamed("unit_id", "describe_unit_id")
    by_region = lambda agg: tables["per_unit"].read().join(units, "describe_unit_id").groupBy("region_id").agg(agg)
    marts = {
        "regions": (("per_region", "busiest"), lambda: tables["per_region"].read().join(tables["busiest"].read(), "region_id")),
        "per_region": (("per_unit", "supplier"), lambda: by_region(F.sum("n").alias("n_results"))),
        "busiest": (("per_unit", "supplier"), lambda: by_region(F.max("n").alias("busiest"))),
        "per_unit": (("lineitem",), lambda: t.results.groupBy("describe_unit_id").agg(A.n_rows().alias("n"))),
    }
    jobs = {name: L.Job(inputs, lambda table, now, build=build: table.overwrite(build(), inputs=dict(now)))
            for name, (inputs, build) in marts.items()}
    sources = {n: f"{sf_dir}/{n}.parquet" for n in ("lineitem", "supplier")}
    first = L.refresh(spark, jobs, tables, sources)
    if set(first) != set(jobs) or L.refresh(spark, jobs, tables, sources):
        raise AssertionError("each mart is refreshed once")
    return tables["regions"].read()


# ---- files -------------------------------------------------------------------------

@register("export_reread", with_roles("results") + """
SELECT accession_number, line_no, emp_fio, diagnostic_name, conduct_mu_name, doc_created FROM results""")
def q_export_reread(spark, sf_dir):
    """The results as ``;`` text with a quoted header, read back with the columns that must be there."""
    names = ["accession_number", "line_no", "emp_fio", "diagnostic_name", "conduct_mu_name", "doc_created"]
    rows, path = Tables(spark, sf_dir).results.select(names), _scratch(spark, "export")
    K.export(rows.toDF(*(f"'{n}'" for n in names)), path, "csv")
    back = S.read_delimited(spark, path, required=names)
    return back.select(*(F.col(n).cast(rows.schema[n].dataType) for n in names))


_IDS = "regexp_replace(translate(regexp_replace(raw_id, '\\s+', '', 'g'), 'Аа', 'AA'), '^([0-9])', 'A\\1')"


@register("newest_id_list", with_roles("id_lists") + f"""
SELECT DISTINCT upper({_IDS}) AS accession FROM id_lists
WHERE length(raw_id) % 3 = 2 AND regexp_matches({_IDS}, '^[A-Za-z][0-9]{{5,}}$')""")
def q_newest_id_list(spark, sf_dir):
    """Three id lists arrive one after the other; only the newest is opened."""
    ids, folder = Tables(spark, sf_dir).id_lists, _scratch(spark, "id-lists")
    for k in range(3):
        ids.where(F.length("raw_id") % 3 == k).coalesce(1).write.csv(f"{folder}/{k}")
    newest = S.read_newest_ids(spark, f"{folder}/*")
    if len(newest.inputFiles()) != 1:
        raise AssertionError("one file is read")
    return newest.select(norm_accession("raw_id").alias("accession")).where(F.col("accession").isNotNull()).distinct()


@register("priced_models", with_roles("reports") + """,
p(model_id, price) AS (VALUES (1095, 1.50), (1096, 2.25), (1098, 0.75)),
m AS (SELECT TRY_CAST(json_extract_string(computed_data, '$.modelId') AS BIGINT) AS model_id FROM reports)
SELECT m.model_id, count(*) AS n_reports, CAST(coalesce(sum(price), 0) AS DECIMAL(18, 2)) AS cost
FROM m LEFT JOIN p ON m.model_id = p.model_id GROUP BY m.model_id""")
def q_priced_models(spark, sf_dir):
    """Reports per model with the prices of a small CSV file."""
    path = _scratch(spark, "prices")
    spark.createDataFrame([(1095, "1.50"), (1096, "2.25"), (1098, "0.75")], "model_id long, price string").coalesce(1).write.option(
        "header", True).csv(path)
    schema = T.StructType([T.StructField("model_id", T.LongType()), T.StructField("price", T.DecimalType(10, 2))])
    prices = F.broadcast(S.read_dim_csv(spark, path, schema))  # three rows
    models = Tables(spark, sf_dir).reports.select(num_or(F.get_json_object("computed_data", "$.modelId"), None, "long").alias("model_id"))
    return models.join(prices, "model_id", "left").groupBy("model_id").agg(
        A.n_rows().alias("n_reports"), F.coalesce(A.sum_tariff("price"), F.lit(0)).cast("decimal(18,2)").alias("cost"))


# ---- operators ---------------------------------------------------------------------

@register("typed_reports", with_roles("reports") + """,
r AS (SELECT report_key, app_source, json_extract_string(computed_data, '$.pumStudyReadyForAiTime') AS ready,
             json_extract_string(raw_data, '$.aiResult.seriesIUID') AS series, json_extract_string(raw_data, '$.aiResult.error') AS error,
             TRY_CAST(json_extract_string(raw_data, '$.aiResult.norma') AS DOUBLE) AS norma
      FROM reports WHERE app_source != 'PACS')
SELECT CAST(report_key AS VARCHAR) AS report_key, CAST(ready AS TIMESTAMP) AS ready_at, NULLIF(error, '') AS error,
       CASE WHEN error = 'timeout' THEN '1' ELSE '0' END AS has_error, coalesce(norma, 0) AS norma,
       CASE WHEN error = 'timeout' THEN 'failed' WHEN norma = 1 THEN 'norm' ELSE 'other' END AS outcome,
       TIMESTAMP '2002-01-01 03:00:00' AS loaded_at, 'nightly' AS run
FROM r WHERE TRY_CAST(ready AS TIMESTAMP) >= TIMESTAMP '1996-01-01' AND trim(series) != ''""")
def q_typed_reports(spark, sf_dir, not_source: str = "PACS"):
    """F2, F8, F9, F11, F14, F15, F17, F18, S12, X30, X31, X34, X35, O1 on every report."""
    r = Fl.where_code(Tables(spark, sf_dir).reports, "app_source", "!=", not_source)
    text = lambda c, path: F.get_json_object(c, path)
    r = Fl.add(r, ready=text("computed_data", "$.pumStudyReadyForAiTime"), series=text("raw_data", "$.aiResult.seriesIUID"),
               raw_error=text("raw_data", "$.aiResult.error"), raw_norma=text("raw_data", "$.aiResult.norma"))
    # parsed once: the filters, the sample for the order's ranges and the order itself read the fields
    r = stored(r.select("report_key", "ready", "series", "raw_error", "raw_norma"), "report-fields")
    r = Fl.parsed_ok(Fl.non_blank(r, "series"), "ready", dt.datetime(1996, 1, 1))
    failed = F.col("raw_error") == "timeout"
    r = Fl.add(r, report_key=to_str("report_key"), ready_at=wall_time(F.col("ready").cast("timestamp_ntz")),
               error=null_if("raw_error", ""), has_error=bool_text(failed), norma=num_or("raw_norma"),
               outcome=case((failed, "failed"), (F.col("raw_norma") == "1", "norm"), default="other"))
    r = Fl.stamp(r, loaded_at=F.lit(C.LOADED_AT.isoformat(" ")).cast("timestamp_ntz"), run="nightly")
    columns = ["report_key", "ready_at", "error", "has_error", "norma", "outcome", "loaded_at", "run"]
    return W.order(Fl.conform(r, columns), F.col("ready_at").desc_nulls_last(), "report_key")


@register("event_windows", with_roles("results", "ai_log") + """,
s AS (SELECT study_uid, min(describe_start) AS started, max(doc_created) AS ended FROM results GROUP BY study_uid)
SELECT study_uid, count(*) FILTER (WHERE opened_at >= started - INTERVAL 5 MINUTE AND opened_at <= ended) AS inside,
       count(*) FILTER (WHERE NOT (opened_at >= started - INTERVAL 5 MINUTE AND opened_at <= ended)) AS outside
FROM s JOIN ai_log ON study_uid = study_iuid GROUP BY study_uid""")
def q_event_windows(spark, sf_dir):
    """Log events of each study inside and outside its description, from five minutes before."""
    t = Tables(spark, sf_dir)
    studies = A.group_all(t.results, ["study_uid"], started=F.min("describe_start"), ended=F.max("doc_created"))
    events = t.ai_log.select(F.col("study_iuid").alias("study_uid"), "opened_at")
    classed = J.event_window(studies, events, "study_uid", "started", "ended", "opened_at")
    return classed.groupBy("study_uid").agg(A.count_where(F.col("in_window")).alias("inside"),
                                            A.count_where(~F.col("in_window")).alias("outside"))


@register("closest_result", with_roles("examinations", "results") + """,
j AS (SELECT e.accession_number, r.line_no, r.diagnostic_code, CAST(epoch(r.conduct_date) AS BIGINT) - CAST(epoch(e.conduct_date) AS BIGINT) AS delta
      FROM examinations e JOIN results r ON e.accession_number = r.accession_number)
SELECT accession_number, line_no, diagnostic_code, delta FROM (
  SELECT *, row_number() OVER (PARTITION BY accession_number ORDER BY CASE WHEN line_no <= 3 THEN 0 ELSE 1 END, abs(delta) NULLS LAST,
                               line_no, diagnostic_code) AS rn FROM j) x WHERE rn = 1""")
def q_closest_result(spark, sf_dir):
    """Of each examination the result nearest to it in time, the first lines before all others."""
    t = Tables(spark, sf_dir)
    e = t.examinations.select("accession_number", F.col("conduct_date").alias("at"))
    j = J.inner(e, t.results.select("accession_number", "line_no", "diagnostic_code", "conduct_date"), "accession_number")
    seconds = lambda c: F.col(c).cast("timestamp").cast("long")
    j = j.withColumn("delta", seconds("conduct_date") - seconds("at"))
    return W.closest(j, "accession_number", F.col("line_no") <= 3, F.col("delta"), tie=["line_no", "diagnostic_code"]).select(
        "accession_number", "line_no", "diagnostic_code", "delta")


@register("benefit_periods", with_roles("benefits") + """
SELECT patient_id, array_to_string(list_transform(list_sort(list({'s': start_date, 'e': coalesce(end_date, DATE '2099-12-31'), 'n': benefit_name})),
         lambda p: concat(p.s, '/', p.e, ' ', p.n)), '; ') AS periods, count(*) AS n_periods
FROM benefits GROUP BY patient_id""")
def q_benefit_periods(spark, sf_dir):
    """The validity periods of each patient."""
    b = Tables(spark, sf_dir).benefits
    end = F.coalesce("end_date", F.lit(dt.date(2099, 12, 31)))
    g = A.group_all(b, ["patient_id"], p=A.collect_periods("start_date", end, "benefit_name"), n_periods=A.n_rows())
    shown = F.transform(F.array_sort("p"), lambda p: F.concat(p["s"].cast("string"), F.lit("/"), p["e"].cast("string"), F.lit(" "), p["n"]))
    return g.select("patient_id", F.array_join(shown, "; ").alias("periods"), "n_periods")


@register("id_sets", with_roles("id_lists", "stored_ids") + f""",
n AS (SELECT DISTINCT upper({_IDS}) AS accession FROM id_lists WHERE regexp_matches({_IDS}, '^[A-Za-z][0-9]{{5,}}$')),
s AS (SELECT DISTINCT accession FROM stored_ids WHERE accession IS NOT NULL)
SELECT accession, CASE WHEN accession IN (SELECT accession FROM s) THEN 'stored' ELSE 'new' END AS state
FROM (SELECT accession FROM n UNION SELECT accession FROM s) x""")
def q_id_sets(spark, sf_dir):
    """The union of listed and stored ids; those that only the lists have are marked new."""
    t = Tables(spark, sf_dir)
    listed = t.id_lists.select(norm_accession("raw_id").alias("accession")).where(F.col("accession").isNotNull())
    both = U.id_union(listed, t.stored_ids, "accession").withColumn("state", F.lit("stored"))
    fresh = U.id_minus(listed, t.stored_ids, "accession").withColumn("fresh", F.lit(True))
    marked = both.join(fresh, "accession", "left")
    return U.rewrite_where(marked, F.col("fresh"), lambda d: d.withColumn("state", F.lit("new"))).drop("fresh")


@register("daily_events", """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, max_by(value, event_id) AS last_value
FROM events GROUP BY 1, 2""")
def q_daily_events(spark, sf_dir):
    """A whole table read by path; events of each day and type with the last one's value."""
    events = S.read_table(spark, f"{sf_dir}/events.parquet")
    return A.group_all(events, [F.to_date("ts").alias("day"), "event_type"], n=A.n_rows(), last_value=F.max_by("value", "event_id"))

"""Table-sync and registry marts: mirrored table with cleaned comments (M16),
re-shoot id sync (M17), dismissed-staff guide (M18), web task registry (M19).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.functions import (clean_text, map_status, norm_accession, storage_urls, strip_html,
                                 tag_texts)
from martforge.functions.text import full_name
from martforge.functions.time import ntz
from martforge.operators import joins as J
from martforge.operators import windows as W
from martforge.sources.readers import flatten_items

# Fixed value: characters that end a link inside a page's text.
URL_STOP = r"""[^"'<>\\\s]+"""


def mirror_clean(df: DataFrame, text_cols) -> DataFrame:
    """The source table as it comes, selected text columns cleaned."""
    return df.withColumns({c: clean_text(c) for c in text_cols})


def new_accessions(raw_ids: DataFrame, stored: DataFrame, raw_col: str = "raw_id",
                   stored_col: str = "accession") -> DataFrame:
    """Normalised ids (X21) that are valid, distinct and not stored yet."""
    ids = raw_ids.select(norm_accession(raw_col).alias("accession")).where(F.col("accession").isNotNull())
    return J.new_ids(ids, stored.select(F.col(stored_col).alias("accession")), "accession")


# (source field, output column, kind) for the guide; kinds as in flatten_items.
GUIDE_FIELDS = [
    ("id", "bx_id", "long"),
    ("employee_name", "employee_name", "text"),
    ("created_by_name", "created_by", "text"),
    ("assigned_by_id_name", "assigned_to", "text"),
    ("stage_name", "stage", "text"),
    ("kpe_document", "kpe_document", "text"),
    ("kpe_size", "kpe_size", "text"),
    ("voting_status_9", "voting_status_9", "text"),
    ("commission_member_9_name", "commission_member_9", "text"),
    ("department_parus", "department_parus", "text"),
    ("additional_info", "additional_info", "text"),
    ("reregistration", "reregistration", "text"),
    ("descriptions_count", "descriptions_count", "text"),
    ("labor_code_article", "labor_code_article", "text"),
    ("dismissal_reason", "dismissal_reason", "text"),
    ("dismissal_date", "dismissal_date", "date"),
]
# Fields that hold a user's id.
GUIDE_USERS = ("employee", "created_by", "assigned_by_id", "commission_member_9")


def dismissed_guide(items: DataFrame, users: DataFrame, stages: DataFrame, *, loaded_at: dt.datetime) -> DataFrame:
    """CRM items flattened to typed columns (S9). User references resolve
    to full names (X27), else the id as text (J18); stage ids resolve to stage
    names, else the raw id; lists join with '; ', booleans become Да/Нет,
    bad dates become 1900-01-01, a bad id becomes 0."""
    names = users.select("ID", full_name("LAST_NAME", "NAME", "SECOND_NAME", "ID").alias("full_name"))
    j = items
    for ref in GUIDE_USERS:
        j = J.resolve(j, names, ref, "ID", "full_name", f"{ref}_name")
    j = J.resolve(j, stages, "stage_id", "STATUS_ID", "NAME", "stage_name")
    out = flatten_items(j, GUIDE_FIELDS)
    return out.withColumns({"bx_id": F.coalesce("bx_id", F.lit(0).cast("long")), "load_datetime": ntz(loaded_at)})


def web_registry(rows: DataFrame, dentistry: DataFrame, storage: str, seq: str = "seq", *,
                 loaded_at: dt.datetime) -> DataFrame:
    """Registry rows normalised from HTML: text fields stripped of tags
    (X22), archive names from ``span`` elements (X23), status mapped to a code
    (X25), and the row's documents: links of its detail page that start with
    ``storage`` and, where the row has a request id, lie under ``/docs/<id>/``
    (X24, first-seen order); rows whose document list is empty have none.
    Duplicates by id keep the first arrival, rows without id are keyed by their
    whole content (W7). ``dentistry`` holds the ids of the dental requests."""
    under = F.when(F.col("request_id").isNull(), "").otherwise(F.concat(F.lit("/docs/"), "request_id", F.lit("/")))
    links = storage_urls("detail_html", f"{re.escape(storage)}{URL_STOP}", 0, under)
    out = rows.select(
        seq,
        strip_html("code").alias("id"),
        strip_html("created_at").alias("date_time"),
        strip_html("medservice_name").alias("specialization"),
        strip_html("source_name").alias("source"),
        strip_html("organization_fmt").alias("med_organization"),
        strip_html("responsible_name").alias("responsible"),
        strip_html("work_type_name").alias("type_zayavki"),
        F.col("load_rate").alias("norma_zagruzki"),
        strip_html("sla_time").alias("sla"),
        map_status(strip_html("status_text")).alias("status"),
        tag_texts("orthanc_html", "span").alias("documents_dicom"),
        F.when(F.coalesce("doc_list", F.lit("")) == "", "").otherwise(F.array_join(links, "; ")).alias("documents_pdf"))
    out = W.keep_first(out, "id", seq).drop(seq)
    out = J.membership(out, dentistry.where(F.col("id") != ""), "id", "stomatology", "Да", "Нет")
    return out.withColumn("load_date", F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S")))

"""Which load policy each mart has, and the refresh of marts whose inputs changed.

Every mart is a versioned table. A load is one commit, which also records the row counts and quality figures observed
while it was written, and the versions of the inputs it was built from. :func:`refresh` compares those with the present
versions and builds only marts with a changed input, each after its inputs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martforge.operators import filters as Fl
from martforge.plans import ai_use as AI
from martforge.sinks.versioned import VersionedTable


@dataclass(frozen=True)
class Policy:
    """``window``: the days of a load are replaced (K1, ``column`` is the day); ``whole``: the table is (K2); ``snapshot``:
    load days are added and kept for ``days`` (K3, K6); ``upsert``: the newest ``column`` per ``keys`` survives (K4)."""

    kind: str
    column: str | None = None
    keys: tuple[str, ...] = ()
    days: int = 0


POLICIES = {
    "conclusions_summary": Policy("window", "doc_date"),
    "unit_summary": Policy("window", "conduct_date"),
    "distinct_conclusions": Policy("window", "doc_date"),
    "overdue_monitoring": Policy("window", "conduct_date"),
    "benefit_cohort": Policy("window", "conduct_date"),
    "equipment_studies": Policy("window", "date_dt"),
    "describe_time_daily": Policy("whole"),
    "oncology_counts": Policy("whole"),
    "clean_comments": Policy("whole"),
    "dismissed_guide": Policy("whole"),
    "web_registry": Policy("whole"),
    "undescribed_queue": Policy("snapshot", "load_date", days=3),
    "ai_use_by_model": Policy("upsert", "loaded_at", ("study_uid", "model_id")),
    "ai_use_by_study": Policy("upsert", "loaded_at", ("study_uid",)),
    "model_usage_daily": Policy("upsert", "loaded_at", ("modality", "date", "model_id", "procedure_name", "access_method")),
    "freshness_report": Policy("upsert", "check_timestamp", ("table_name",)),
    "refresh_log": Policy("upsert", "loaded", ("entity",)),
}


def load(name: str, df: DataFrame, table: VersionedTable, as_of: dt.date, lo: dt.date | None = None, hi: dt.date | None = None,
         observed: Iterable[Observation] = (), inputs: Mapping[str, str] | None = None) -> int | None:
    """Loads mart ``name`` by its policy; the new version, or None if the extract was empty and nothing changed (K9).

    ``lo`` and ``hi`` bound a window load, ``as_of`` is the day of a snapshot.
    """
    policy, extra = POLICIES[name], {"inputs": dict(inputs)} if inputs is not None else {}
    if policy.kind == "window":
        return table.replace_window(df, policy.column, lo, hi, observed=observed, **extra)
    if policy.kind == "whole":
        return table.overwrite(df, observed=observed, **extra)
    if policy.kind == "snapshot":
        if policy.column not in df.columns:
            df = df.withColumn(policy.column, F.lit(as_of))
        return table.append_retain(df, policy.column, as_of, policy.days, observed=observed, **extra)
    return table.upsert_latest(df, policy.keys, policy.column, observed=observed, **extra)


def load_ai_use(results: DataFrame, reports: DataFrame, ai_log: DataFrame, cfg: DataFrame, model_names: DataFrame,
                tariffs: DataFrame, date_from: dt.date, date_to: dt.date, by_model: VersionedTable, by_study: VersionedTable,
                excluded_codes=(), min_describe_start: dt.datetime | None = None, unit_id: str | None = None, *,
                loaded_at: dt.datetime) -> None:
    """M10 -> M11, upserted -> M12 from this load's stored rows of M11, upserted.

    The series without a study that M11 leaves out are counted while M11 is written (F10), see
    :meth:`VersionedTable.metrics`. A rerun with the same stamp replaces the load.
    """
    stamp = F.lit(loaded_at.isoformat(" ")).cast("timestamp_ntz")
    series = AI.ai_use_series(results, reports, ai_log, cfg, model_names, date_from, date_to, excluded_codes,
                              min_describe_start, unit_id)
    kept, dropped = Fl.drop_null_key(series, "study_uid")
    models = AI.ai_use_by_model(kept, tariffs, date_from, date_to).withColumn("loaded_at", stamp)
    load("ai_use_by_model", models, by_model, date_to, observed=[dropped])
    stored = by_model.read().where(F.col("loaded_at") == stamp).drop("loaded_at")
    load("ai_use_by_study", AI.ai_use_by_study(stored).withColumn("loaded_at", stamp), by_study, date_to,
         inputs={"ai_use_by_model": str(by_model.version())})


# ---- K8 ------------------------------------------------------------------------

@dataclass(frozen=True)
class Job:
    """A mart with its inputs: names of other marts or of source folders. ``run`` gets the table to load and the input
    versions, which it passes on to :func:`load`."""

    inputs: tuple[str, ...]
    run: Callable[[VersionedTable, Mapping[str, str]], object]


def source_version(spark: SparkSession, folder: str) -> str:
    """Names the state of a folder of source files by their listing (names, times, sizes); no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    row = files.select(F.xxhash64("path", "modificationTime", "length").alias("h")).agg(
        F.count("*").alias("n"), F.bit_xor("h").alias("x")).first()
    return f"{row['n']}-{row['x']}"


def refresh(spark: SparkSession, jobs: Mapping[str, Job], tables: Mapping[str, VersionedTable], sources: Mapping[str, str]) -> list[str]:
    """K8: runs the jobs of ``jobs`` with a changed input, each after the marts it reads; the names of those that ran.

    Input versions are read before a mart is built and stored with it, so an input that changes meanwhile makes the
    mart stale again. A mart that was never loaded is stale; a mart whose job fails keeps its version, and the marts
    that were loaded before it are not run again next time. A circle of inputs is an error.
    """
    order = TopologicalSorter({name: [i for i in job.inputs if i in jobs] for name, job in jobs.items()})
    seen = {name: source_version(spark, folder) for name, folder in sources.items()}
    ran = []
    for name in order.static_order():
        now = {i: seen[i] if i in seen else str(tables[i].version()) for i in jobs[name].inputs}
        if tables[name].manifest().get("inputs") != now:
            jobs[name].run(tables[name], now)
            ran.append(name)
    return ran

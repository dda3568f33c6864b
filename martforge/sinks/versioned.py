"""Marts as versioned tables: every load is one atomic commit.

A table is a folder::

    <path>/data/<load>/...              parquet files, written once and never changed
    <path>/_versions/<number>.json      which of them make up version <number>

A load first writes its files under a new name, where no reader looks, and then publishes a manifest. The manifest is
written beside its place and renamed to the next number only if that number is still free, so a reader sees the old
version or the new one and nothing between, wherever a load is killed. Files that no version names are left behind by
a killed load and go with :meth:`VersionedTable.vacuum`. Two loads at once: one finds its number taken and fails with
:class:`ConcurrentLoad`, its files unseen; it is run again.

Spark writes and reads all rows; the manifest has a line per day folder (window and snapshot loads) or per file
(upserts), with the row count and the smallest and largest key of the file.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.joins import new_ids
from martforge.operators.windows import keep_latest
from martforge.sinks.policies import _FILL, _fs, align_schema, partition_values

#: Rows of a file that an upsert writes, and so about the least that it rewrites.
ROWS_PER_FILE = 2_000_000
PART = "__part"


class ConcurrentLoad(RuntimeError):
    """Another load published its version first."""


class VersionedTable:
    """One mart under ``path`` on any Hadoop file system.

    ``on_step`` is called with a name before each file-system step.
    """

    def __init__(self, spark: SparkSession, path: str, on_step: Callable[[str], None] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self._step = on_step or (lambda name: None)

    # ---- versions ------------------------------------------------------------------

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        fs, folder, _ = _fs(self.spark, f"{self.path}/_versions")
        if not fs.exists(folder):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self) -> int:
        """The current version; 0 before the first load."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """What version ``version`` (default: the current one) consists of; no entries before the first load."""
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schemas": [], "entries": []}
        fs, file, jvm = _fs(self.spark, self._file(version))
        stream = fs.open(file)
        try:
            return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _file(self, version: int) -> str:
        return f"{self.path}/_versions/{version:020d}.json"

    def _publish(self, base: dict, operation: str, schema: T.StructType, entries: list[dict], **extra) -> int:
        """Publishes ``entries`` as the version after ``base``."""
        schemas = list(base["schemas"])
        new = json.loads(schema.json())
        if new not in schemas:
            schemas.append(new)
        for entry in entries:
            entry.setdefault("schema", schemas.index(new))
        number = base["version"] + 1
        text = json.dumps({"version": number, "operation": operation, "schemas": schemas, "entries": entries, **extra})
        fs, final, jvm = _fs(self.spark, self._file(number))
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_versions/.draft-{uuid.uuid4().hex}")
        self._step("draft")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._step("publish")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        flags = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:  # without a flag a rename never replaces a file
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf).rename(draft, final, flags)
        except Exception as failed:
            if "FileAlreadyExists" in str(failed):
                fs.delete(draft, False)
                raise ConcurrentLoad(f"version {number} of {self.path} was published by another load") from failed
            raise
        self._step("published")
        return number

    # ---- reading -------------------------------------------------------------------

    def read(self, version: int | None = None, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a version, columns that its older files lack filled as in :func:`align_schema` (K6).

        ``parts`` (days as ISO text) reads only these window or snapshot folders.
        """
        manifest = self.manifest(version)
        if not manifest["version"]:
            raise FileNotFoundError(f"{self.path} has no version")
        wanted = None if parts is None else set(parts)
        entries = [e for e in manifest["entries"] if wanted is None or e.get("part") in wanted]
        return self._rows(manifest, entries)

    def _rows(self, manifest: dict, entries: list[dict]) -> DataFrame:
        schemas = [T.StructType.fromJson(s) for s in manifest["schemas"]]
        whole = schemas[-1]
        names = set(whole.fieldNames())
        for old in reversed(schemas[:-1]):  # columns that later loads left out
            whole = T.StructType([*whole.fields, *(f for f in old.fields if f.name not in names)])
            names |= set(old.fieldNames())
        out = None
        for k in sorted({e["schema"] for e in entries}):
            paths = [f"{self.path}/{e['path']}" for e in entries if e["schema"] == k]
            own = set(schemas[k].fieldNames())
            rows = self.spark.read.schema(schemas[k]).parquet(*paths)
            rows = rows.select(*(F.col(f"`{f.name}`") if f.name in own else
                                 F.lit(_FILL.get(type(f.dataType))).cast(f.dataType).alias(f.name) for f in whole.fields))
            out = rows if out is None else out.unionByName(rows)
        return self.spark.createDataFrame([], whole) if out is None else out

    def metrics(self) -> DataFrame:
        """The audit table: (version, operation, metric, value) of every published load."""
        rows = [(m["version"], m["operation"], k, int(v)) for m in map(self.manifest, self.versions())
                for k, v in m.get("metrics", {}).items()]
        return self.spark.createDataFrame(rows, "version long, operation string, metric string, value long")

    # ---- writing -------------------------------------------------------------------

    def _write(self, df: DataFrame, by_part: bool = False, observed: Iterable[Observation] = ()) -> tuple[str, dict]:
        """Writes ``df`` where no reader looks; (folder, metrics). The row count is observed by the write itself, as are
        the ``observed`` figures further down in the plan; no job of their own."""
        folder, counted = f"data/{uuid.uuid4().hex}", Observation()
        self._step("write")
        writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write
        (writer.partitionBy(PART) if by_part else writer).parquet(f"{self.path}/{folder}")
        found = {"rows": counted.get.get("rows", 0)}
        for one in observed:
            found |= one.get
        self._step("written")
        return folder, found

    def _discard(self, folder: str) -> None:
        fs, file, _ = _fs(self.spark, f"{self.path}/{folder}")
        self._step("discard")
        fs.delete(file, True)

    def overwrite(self, df: DataFrame, skip_empty: bool = True, observed: Iterable[Observation] = (), **extra) -> int | None:
        """K2: the table becomes ``df``. Returns the new version, or None and no change for an empty extract (K9)."""
        base = self.manifest()
        folder, metrics = self._write(df, observed=observed)
        if skip_empty and not metrics["rows"]:
            return self._discard(folder)
        return self._publish(base, "overwrite", df.schema, [{"path": folder, "rows": metrics["rows"]}], metrics=metrics, **extra)

    def replace_window(self, df: DataFrame, date_col: str, lo: dt.date, hi: dt.date, skip_empty: bool = True,
                       observed: Iterable[Observation] = (), **extra) -> int | None:
        """K1: the days ``[lo, hi]`` of ``date_col`` become ``df``; days without rows are emptied.

        An empty extract leaves the table alone (K9). Rows outside the window, or without a date, are an error.
        """
        base = self.manifest()
        day = F.to_date(date_col).cast("string")
        # ranges of days per task: few files per day, and a very large day is split
        rows = df.withColumn(PART, day).repartitionByRange(date_col)
        folder, metrics = self._write(rows, by_part=True, observed=observed)
        days = partition_values(self.spark, f"{self.path}/{folder}", PART)
        if skip_empty and not days:
            return self._discard(folder)
        outside = [d for d in days if not _is_date(d) or not lo <= dt.date.fromisoformat(d) <= hi]
        if outside:
            self._discard(folder)
            raise ValueError(f"rows outside the window [{lo}, {hi}]: {outside[:3]}")
        kept = [e for e in base["entries"] if not _is_date(e.get("part")) or not lo <= dt.date.fromisoformat(e["part"]) <= hi]
        new = [{"path": f"{folder}/{PART}={d}", "part": d} for d in sorted(days)]
        return self._publish(base, "replace_window", df.schema, kept + new, metrics=metrics, **extra)

    def append_retain(self, df: DataFrame, load_col: str, as_of: dt.date, days: int, skip_empty: bool = True,
                      observed: Iterable[Observation] = (), **extra) -> int | None:
        """K3: adds a snapshot by load day and drops the days before ``as_of - days``, in one commit. A load day that
        comes again is replaced, so a repeated load changes nothing."""
        base = self.manifest()
        folder, metrics = self._write(df.withColumn(PART, F.to_date(load_col).cast("string")), by_part=True, observed=observed)
        loaded = partition_values(self.spark, f"{self.path}/{folder}", PART)
        if skip_empty and not loaded:
            return self._discard(folder)
        floor = as_of - dt.timedelta(days=days)
        fresh = lambda d: not _is_date(d) or dt.date.fromisoformat(d) >= floor
        kept = [e for e in base["entries"] if e.get("part") not in loaded and fresh(e.get("part"))]
        new = [{"path": f"{folder}/{PART}={d}", "part": d} for d in sorted(loaded) if fresh(d)]
        return self._publish(base, "append_retain", df.schema, kept + new, metrics=metrics, **extra)

    def append(self, df: DataFrame, stream: str | None = None, batch: int | None = None, day_col: str | None = None,
               floor: dt.date | None = None, **extra) -> int | None:
        """Adds rows. A micro-batch names its ``stream`` and number, and is added once however often it is replayed.

        With ``day_col`` the rows go into day folders, and days before ``floor`` leave the table in the same commit.
        """
        base = self.manifest()
        batches = dict(base.get("batches", {}))
        if stream is not None and batches.get(stream, -1) >= batch:
            return None
        rows = df if day_col is None else df.withColumn(PART, F.to_date(day_col).cast("string"))
        folder, metrics = self._write(rows, by_part=day_col is not None)
        new = [{"path": folder, "rows": metrics["rows"]}]
        if day_col is not None:
            new = [{"path": f"{folder}/{PART}={d}", "part": d} for d in sorted(partition_values(self.spark, f"{self.path}/{folder}", PART))]
        fresh = lambda e: floor is None or not _is_date(e.get("part")) or dt.date.fromisoformat(e["part"]) >= floor
        if stream is not None:
            batches[stream] = batch
        return self._publish(base, "append", df.schema, [e for e in base["entries"] + new if fresh(e)],
                             metrics=metrics, **({"batches": batches} if batches else {}), **extra)

    def insert_unseen(self, df: DataFrame, key: str) -> int | None:
        """K5: adds the distinct non-null ids of ``df`` that the table lacks."""
        fresh = new_ids(df, self.read(), key) if self.version() else df.select(key).where(F.col(key).isNotNull()).distinct()
        return self.append(fresh)

    def upsert_latest(self, df: DataFrame, keys, ver: str, rows_per_file: int = ROWS_PER_FILE,
                      observed: Iterable[Observation] = (), **extra) -> int | None:
        """K4: the newest version per key survives (ties kept, W6); rows of a stored key and version that come again
        replace them, so a repeated load changes nothing.

        The table's files hold ranges of keys that do not overlap, with their smallest and largest key in the manifest.
        The load is written once, its rows are dealt to the ranges, and only files of ranges with a new row are read and
        written again; all others stay as they are.
        """
        keys = [keys] if isinstance(keys, str) else list(keys)
        base = self.manifest()
        staged, metrics = self._write(df, observed=observed)
        if not metrics["rows"]:
            return self._discard(staged)
        incoming = self.spark.read.schema(df.schema).parquet(f"{self.path}/{staged}")
        types = [df.schema[k].dataType for k in keys]
        ranges = sorted(base["entries"], key=lambda e: e["at"])
        part = _range_of(keys, types, [e["lo"] for e in ranges[1:]])
        touched = sorted(r[0] for r in incoming.select(part).distinct().collect()) if ranges else []  # a row per range
        old = [ranges[k] for k in touched]
        rows, n = incoming, metrics["rows"]
        if old:
            again = incoming.select(*(F.col(c).alias(f"__new_{c}") for c in [*keys, ver])).distinct()
            stored = self._rows(base, old)
            same = F.lit(True)
            for c in [*keys, ver]:
                same = same & stored[c].eqNullSafe(again[f"__new_{c}"])
            rows = align_schema(stored.join(again, same, "left_anti"), incoming)
            n += sum(e["rows"] for e in old)
        whole = keep_latest(rows, keys, ver)
        spread = whole.withColumn(PART, part).repartitionByRange(max(1, -(-n // rows_per_file)), PART, *keys)
        folder, written = self._write(spread.sortWithinPartitions(PART, *keys), by_part=True)
        file = F.substring_index(F.col("_metadata.file_path"), f"{folder}/", -1).alias("file")
        found = self.spark.read.schema(whole.schema).parquet(f"{self.path}/{folder}").select(*keys, file).groupBy("file").agg(
            F.count("*").alias("rows"), F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
        text = lambda s: F.transform(F.array(*(F.col(f"{s}.{k}").cast("string") for k in keys)), lambda x: x).alias(s)
        found = found.orderBy("lo").select("file", "rows", text("lo"), text("hi")).collect()  # a row per file
        new = [{"path": f"{folder}/{r.file}", "rows": r.rows, "lo": r.lo, "hi": r.hi} for r in found]
        entries, gone = [], set(touched)
        for k, e in enumerate(ranges):
            if k not in gone:
                entries.append(e)
        entries = self._in_order(entries, new, keys, types)
        version = self._publish(base, "upsert_latest", whole.schema, entries, metrics=metrics | {"rewritten": written["rows"]}, **extra)
        self._discard(staged)
        return version

    def _in_order(self, kept: list[dict], new: list[dict], keys: list[str], types: list) -> list[dict]:
        """Entries with ``at``, their place in key order; Spark compares the keys."""
        entries = kept + new
        rows = [(i, e["lo"]) for i, e in enumerate(entries)]
        lows = self.spark.createDataFrame(rows, "i int, lo array<string>")
        order = lows.orderBy(*(F.get("lo", F.lit(j)).cast(t) for j, t in enumerate(types))).collect()
        for at, r in enumerate(order):
            entries[r.i]["at"] = at
        return entries

    def vacuum(self, keep: int = 2, min_age: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Removes versions but the last ``keep``, and folders older than ``min_age`` that none of these names: those of
        replaced files and of killed loads. Returns how many folders went.

        ``min_age`` has to be longer than any load takes, as a running load's files have no version yet.
        """
        versions = self.versions()
        named = {e["path"].split("/")[1] for v in versions[-keep:] for e in self.manifest(v)["entries"]}
        fs, data, jvm = _fs(self.spark, f"{self.path}/data")
        for old in versions[:-keep]:
            self._step("forget")
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._file(old)), False)
        until = dt.datetime.now(dt.timezone.utc).timestamp() - min_age.total_seconds()
        gone = 0
        for st in fs.listStatus(data) if fs.exists(data) else []:
            if st.getPath().getName() not in named and st.getModificationTime() / 1000 <= until:
                self._step("vacuum")
                fs.delete(st.getPath(), True)
                gone += 1
        return gone


def _is_date(text: str | None) -> bool:
    try:
        return text is not None and bool(dt.date.fromisoformat(text))
    except ValueError:
        return False


def _range_of(keys: list[str], types: list, lows: list[list[str]]) -> Column:
    """How many of the sorted key tuples ``lows`` are at most the row's key: a binary search in one expression."""
    if not lows:
        return F.lit(0)
    bound = lambda low: F.struct(*(F.lit(v).cast(t).alias(k) for k, t, v in zip(keys, types, low)))
    bounds, own = F.array(*map(bound, lows)), F.struct(*(F.col(k).alias(k) for k in keys))
    steps = [1 << b for b in range(len(lows).bit_length() - 1, -1, -1)]

    def search(at: Column, step: Column) -> Column:
        return F.when((at + step <= len(lows)) & (F.get(bounds, at + step - 1) <= own), at + step).otherwise(at)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), search)

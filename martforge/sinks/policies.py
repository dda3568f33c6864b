"""Load policies on plain parquet folders.

No table format is assumed. Idempotence comes from partition layout:
targets are partitioned by their load/window date column, and each policy
replaces whole partitions. Where a target has to be read and rewritten
(upsert, retention), the new version is written to a sibling staging folder
first and swapped in afterwards: Spark cannot overwrite a path it is reading
in the same plan, and a failed job leaves the old version untouched.

File-system steps (listing, deleting emptied partitions, swapping folders)
use the Hadoop FileSystem of the target path, so they work the same on
HDFS, object stores and local disk.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.joins import new_ids
from martforge.operators.windows import keep_latest


# ---- file-system helpers -------------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of ``column=<v>`` sub-folders of a partitioned target."""
    fs, p, _ = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{column}="):
            out.append(name.split("=", 1)[1])
    return out


def _move(fs, a, b) -> None:
    """Rename that raises where Hadoop only returns false; what was staged stays in place then."""
    if not fs.rename(a, b):
        raise OSError(f"could not rename {a} to {b}")


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    """Replace ``target`` by ``staged`` (rename; the old copy is removed last)."""
    fs, t, jvm = _fs(spark, target)
    old = jvm.org.apache.hadoop.fs.Path(f"{target}.old-{uuid.uuid4().hex[:8]}")
    had = fs.exists(t)
    if had:
        _move(fs, t, old)
    _move(fs, jvm.org.apache.hadoop.fs.Path(staged), t)
    if had:
        fs.delete(old, True)


def _staging(target: str) -> str:
    return f"{target.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"


# ---- policies ------------------------------------------------------------------

def skip_if_empty(df: DataFrame) -> bool:
    """K9: True when there is nothing to load (one row is enough to decide)."""
    return df.isEmpty()


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, **options) -> None:
    """K2: full overwrite (JDBC targets: pass ``fmt='jdbc'`` and ``truncate='true'``)."""
    w = df.write.mode("overwrite").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)


def replace_window(df: DataFrame, path: str, date_col: str, lo: dt.date, hi: dt.date,
                   skip_empty: bool = True) -> bool:
    """K1: make the target's ``[lo, hi]`` days equal to ``df`` (idempotent).

    The extract is computed once, written partitioned by day to a staging
    folder, checked (every day inside the window), and then each window day
    of the target is replaced by its staged folder; window days absent from
    the extract are removed, so a day that became empty is emptied too.
    Returns False and leaves the target untouched when the extract is empty
    and ``skip_empty`` is set (K9: checked on the staged data, not by an
    extra job).
    """
    spark = df.sparkSession
    staged = _staging(path)
    # range-partition on the day: each writer task holds a few consecutive
    # days (few files per day folder) and a very large day is still split
    # over several tasks, unlike a hash repartition on the day.
    df.repartitionByRange(date_col).write.mode("overwrite").partitionBy(date_col).parquet(staged)
    days = partition_values(spark, staged, date_col)
    if skip_empty and not days:
        delete(spark, staged)
        return False
    outside = [v for v in days if v == "__HIVE_DEFAULT_PARTITION__" or not lo <= dt.date.fromisoformat(v) <= hi]
    if outside:
        delete(spark, staged)
        raise ValueError(f"rows outside the window [{lo}, {hi}]: {outside[:3]}")
    fs, _, jvm = _fs(spark, path)
    root = jvm.org.apache.hadoop.fs.Path(path)
    if not fs.exists(root):
        fs.mkdirs(root)
    for v in partition_values(spark, path, date_col):
        if v != "__HIVE_DEFAULT_PARTITION__" and lo <= dt.date.fromisoformat(v) <= hi and v not in days:
            delete(spark, f"{path.rstrip('/')}/{date_col}={v}")
    for v in days:
        delete(spark, f"{path.rstrip('/')}/{date_col}={v}")
        _move(fs, jvm.org.apache.hadoop.fs.Path(f"{staged}/{date_col}={v}"),
              jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{date_col}={v}"))
    delete(spark, staged)
    return True


def append_retain(df: DataFrame, path: str, load_col: str, as_of: dt.date, days: int) -> None:
    """K3: add a snapshot partitioned by load date, then drop partitions older than
    ``as_of - days``. A load date that is loaded again replaces its partition."""
    spark = df.sparkSession
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(load_col).parquet(path))
    floor = as_of - dt.timedelta(days=days)
    for v in partition_values(spark, path, load_col):
        try:
            d = dt.date.fromisoformat(v[:10])
        except ValueError:
            continue
        if d < floor:
            delete(spark, f"{path.rstrip('/')}/{load_col}={v}")


def upsert_latest(df: DataFrame, path: str, keys, ver: str) -> None:
    """K4: union stored and new rows, keep the newest version per key (ties
    kept, W6), write to staging and swap in. Stored rows of a key and version
    that come again are replaced, so a repeated load changes nothing."""
    spark = df.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    allrows = df
    if exists(spark, path):
        own = [*keys, ver]
        again = df.select(*(F.col(c).alias(f"_new_{c}") for c in own)).distinct()
        stored = spark.read.parquet(path)
        same = F.lit(True)
        for c in own:
            same = same & stored[c].eqNullSafe(again[f"_new_{c}"])
        allrows = align_schema(stored.join(again, same, "left_anti"), df)
    staged = _staging(path)
    keep_latest(allrows, keys, ver).write.mode("overwrite").parquet(staged)
    _swap(spark, staged, path)


def insert_unseen(df: DataFrame, path: str, key: str) -> int | None:
    """K5: append the ids of ``df`` not stored yet (distinct, left anti, J17)."""
    spark = df.sparkSession
    if exists(spark, path):
        fresh = new_ids(df, spark.read.parquet(path), key)
    else:
        fresh = df.select(key).where(F.col(key).isNotNull()).distinct()
    fresh.write.mode("append").parquet(path)
    return None


_FILL = {T.StringType: "", T.LongType: 0, T.IntegerType: 0, T.DoubleType: 0.0}


def align_schema(old: DataFrame, new: DataFrame, defaults: dict | None = None) -> DataFrame:
    """K6: union by name; columns missing on either side are added with the
    column's default (per name, else per type, else NULL)."""
    defaults = defaults or {}
    types = {f.name: f.dataType for f in list(old.schema.fields) + list(new.schema.fields)}

    def fill(df: DataFrame) -> DataFrame:
        missing = [c for c in types if c not in df.columns]
        return df.withColumns({c: F.lit(defaults.get(c, _FILL.get(type(types[c])))).cast(types[c])
                               for c in missing})
    order = list(old.columns) + [c for c in new.columns if c not in old.columns]
    return fill(old).select(*order).unionByName(fill(new).select(*order))


def export(df: DataFrame, path: str, fmt: str = "json", sep: str = ";") -> None:
    """K7: JSON lines, or delimited text with a header (``sep`` ';' by default)."""
    if fmt == "json":
        df.write.mode("overwrite").json(path)
    else:
        df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def refresh(jobs: Iterable[tuple[Callable[[], DataFrame], Callable[[DataFrame], object]]]) -> int:
    """K8: recompute dependent marts after a load: each job is (build, load)."""
    n = 0
    for build, load in jobs:
        load(build())
        n += 1
    return n

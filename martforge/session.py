"""Session settings shared by tests, bench and the entry points.

Cluster deployments pass their own settings through ``spark-submit``; this
module only fills in what is unset, so a cluster's values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the marts rely on for correctness (UTC session clock: every
# time-zone shift is explicit in the plan) or for scale (AQE re-plans joins
# from runtime sizes, splits skewed partitions and coalesces small ones).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime broadcast decision: a join side becomes a broadcast only when
    # its measured shuffle output is below this size; otherwise the planned
    # sort-merge join stays. This is the size check for data-derived sides.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # The streams' seen keys stay on local disk with snapshots in the checkpoint, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "martforge") -> SparkSession:
    """Return the active session or build one; :data:`DEFAULTS` fill in what nobody has set."""
    active = SparkSession.getActiveSession()
    if active is None:
        builder = SparkSession.builder.appName(app_name)
        if master:  # a local session of our own; a cluster's come with spark-submit
            builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        active = builder.getOrCreate()
    given = {row.key for row in active.sql("SET").collect()}
    for key, value in DEFAULTS.items():
        if key.startswith("spark.sql.") and key not in given:
            active.conf.set(key, value)
    if shuffle_partitions and "spark.sql.shuffle.partitions" not in given:
        active.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    active.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(active)
    return active


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent, a session on one machine (master ``local[...]``, as in tests) takes a scratch
    folder and records it; on a cluster that would be a folder only one machine sees, so it is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="martforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A staging path next to the checkpoint folder (shared storage on a cluster)."""
    return os.path.join(checkpoint_dir(spark), "staging", name)


#: Removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: (table, path) of what the scratch() block that is open has stored.
_STORED: ContextVar[list | None] = ContextVar("stored", default=None)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet and read back; the write leaves no shuffle files behind."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    if (tables := _STORED.get()) is not None:
        tables.append((table, path))
    return table


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes the tables that were stored in this block at its end, but not those given to the function it yields; of
    blocks inside a block, these are deleted with the outer one. Nothing that reads a deleted table may be left to run."""
    tables, kept = [], []
    outer = _STORED.get()
    token = _STORED.set(tables)
    try:
        yield lambda table: kept.append(table) or table
    finally:
        _STORED.reset(token)
        for table, path in tables:
            if any(table is k for k in kept):
                if outer is not None:
                    outer.append((table, path))
            else:
                at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: what reads it twice computes it once,
    and a lost executor recomputes nothing before it."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/marts/{name}-{uuid.uuid4().hex}"
    return write_and_read(df, path)

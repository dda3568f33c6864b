"""Structured Streaming jobs.

What has been seen is keyed state of the stream, kept in the state store and saved with the checkpoint: each new row
is looked up by its key, and no micro-batch reads the target. The file sink records the files of every micro-batch in
its own log, so a replayed batch changes nothing. ``trigger(availableNow=True)`` processes what has arrived and stops,
so a scheduler can run a stream like a batch job; a restart resumes from the checkpoint.

R1 replaces the reference's poll loop and its persisted set of seen files: the file source's checkpoint is the set of
seen files, ``maxFilesPerTrigger`` caps a micro-batch at 10 files, ``pathGlobFilter`` selects the file type, ids are
normalised and each is stored once.

R2 keeps the source-refresh event log free of repeats: one row per (entity, loaded), either for ever
(:func:`stream_event_log`) or for the last days before the run's date (:func:`stream_retained_log`).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from martforge.functions import norm_accession
from martforge.sinks.policies import exists
from martforge.sinks.versioned import VersionedTable

ID_FILE_SCHEMA = T.StructType([T.StructField("raw_id", T.StringType())])
EVENT = ["entity", "loaded"]


class _AfterBatch(StreamingQueryListener):
    """Calls ``run`` with the number of each batch of one query that read rows; done when the query ends."""

    def __init__(self, spark: SparkSession, name: str, run):
        self.spark, self.name, self.run = spark, name, run

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if event.progress.name == self.name and event.progress.numInputRows:
            self.run(event.progress.batchId)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _own_target(spark: SparkSession, dst_path: str, checkpoint: str) -> None:
    """A target that this checkpoint knows nothing of would get its rows again."""
    if exists(spark, dst_path) and not exists(spark, f"{checkpoint.rstrip('/')}/metadata"):
        raise ValueError(f"{dst_path} holds rows of another origin; give the stream a folder of its own")


def stream_ids(spark: SparkSession, src_dir: str, dst_path: str, checkpoint: str, glob: str = "*.csv",
               max_files: int = 10, run_post_batch=None, known: DataFrame | None = None):
    """Ingest id files as they arrive; returns the started query.

    ``known`` has ids (column ``accession``) stored elsewhere, which the stream leaves out. ``run_post_batch`` is called
    with the batch number after each batch.
    """
    _own_target(spark, dst_path, checkpoint)
    src = (spark.readStream.schema(ID_FILE_SCHEMA).option("header", False)
           .option("maxFilesPerTrigger", max_files).option("pathGlobFilter", glob).csv(src_dir))
    ids = src.select(norm_accession("raw_id").alias("accession")).where(F.col("accession").isNotNull())
    if known is not None:
        ids = ids.join(known.select("accession"), "accession", "left_anti")
    name = f"ids {checkpoint}"
    if run_post_batch is not None:
        spark.streams.addListener(_AfterBatch(spark, name, run_post_batch))
    return (ids.dropDuplicates(["accession"]).writeStream.queryName(name).format("parquet").outputMode("append")
            .option("path", dst_path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _events(spark: SparkSession, src_dir: str, schema: T.StructType, max_files: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src_dir).select(*EVENT)


def stream_event_log(spark: SparkSession, src_dir: str, dst_path: str, checkpoint: str,
                     schema: T.StructType, max_files: int = 1000):
    """R2: stream parquet event files to a de-duplicated parquet log; a row is kept however late it comes."""
    _own_target(spark, dst_path, checkpoint)
    return (_events(spark, src_dir, schema, max_files).dropDuplicates(EVENT).writeStream.format("parquet")
            .outputMode("append").option("path", dst_path).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_retained_log(spark: SparkSession, src_dir: str, log: VersionedTable, checkpoint: str, schema: T.StructType,
                        run_date: dt.date, days: int = 15, max_files: int = 1000):
    """R2 / K3: the de-duplicated log of the last ``days`` days before ``run_date``, as a versioned table.

    State lives as long as a repeat can still be stored: a row's key is dropped once the newest event is ``days`` days
    ahead of it, and rows that late are dropped with it. Each batch is one commit, which adds its rows by day and
    lets go of the days before ``run_date - days``; a replayed batch is added once. Rows without a time are no events.
    """
    floor = run_date - dt.timedelta(days=days)
    events = (_events(spark, src_dir, schema, max_files).withColumn("loaded", F.col("loaded").cast("timestamp"))
              .where(F.to_date("loaded") >= F.lit(floor))
              .withWatermark("loaded", f"{days} days").dropDuplicates(EVENT))

    def add(batch: DataFrame, number: int) -> None:
        log.append(batch, stream=checkpoint, batch=number, day_col="loaded", floor=floor)

    return (events.writeStream.foreachBatch(add).outputMode("append").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())

"""Listings that arrive as files, followed as a stream: each new snapshot is compared with the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexlake.operators.snapshots import record_changes


def follow(spark: SparkSession, incoming: str, state: str, changes: str, checkpoint: str):
    """Reads snapshots (parquet files of the listing's columns) as they come, keeps their rows under state and
    appends what changed to changes. Runs until all files there are read; started again it goes on with new ones.

    A batch may hold several snapshots. Each is compared within the rows from the last snapshot
    before the batch on, so the work of a batch follows its size, not that of all listings. The numbers
    of the records are kept beside state, so a record has one number in all batches. A batch
    that is run again after a failure replaces its own output.
    """
    schema = spark.read.parquet(incoming).schema

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/batch={number}")
        new = spark.read.schema(schema).parquet(f"{state}/batch={number}")
        first = new.agg(F.min("snapshot_no")).first()[0]
        if first is None:
            return
        held = spark.read.option("basePath", state).parquet(state).where(F.col("batch") <= number).drop("batch")
        before = held.where(F.col("snapshot_no") < first).agg(F.max("snapshot_no")).first()[0]
        rows = held.where(F.col("snapshot_no") >= (first if before is None else before))
        record_changes(rows.select(*new.columns), store=f"{state}-ordinals").write.mode("overwrite").parquet(f"{changes}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(incoming)
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windows(events: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """(begin, kind, n): events (ts, event_type) counted in windows; rows later than late are left out."""
    g = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"))
    return g.select(F.col("window.start").alias("begin"), F.col("event_type").alias("kind"), "n")

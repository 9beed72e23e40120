"""The event log as a stream: daily counters, the same columns as the batch query; with a watermark where the stream has no end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.runtime import scratch_folder

LATENESS = "7 days"


def daily_counts(events: DataFrame, lateness: str | None = LATENESS) -> DataFrame:
    """Successes and failures per day. ``events`` may be a stream; rows later than the watermark are left out there.

    Without ``lateness`` no row is; the state then holds one row per day, for good.
    """
    bad = F.col("event_type") == "error"
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if events.isStreaming and lateness is not None:
        events = events.withWatermark("ts", lateness)
    days = events.groupBy(F.window("ts", "1 day")).agg(F.count_if(~bad).alias("n_success"), F.count_if(bad).alias("n_fail"))
    return days.select(F.date_format("window.start", "yyyyMMdd").alias("day"), "n_success", "n_fail")


def drain(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Runs a stream over what is there, and gives its rows as written to the shared folder (the last row of a key counts)."""
    base = f"{scratch_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(rows: DataFrame, batch: int) -> None:
        rows.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{base}/rows")

    query = stream.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{base}/state").foreachBatch(keep).start()
    query.awaitTermination()
    return spark.read.parquet(f"{base}/rows")


def q13_daily_stream(spark: SparkSession, root: str) -> DataFrame:
    schema = spark.read.parquet(f"{root}/events.parquet").schema
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).option("pathGlobFilter", "*.parquet")
    # a stream reads folders; a table that is one file is read through its name
    stream = source.parquet(f"{root}/events*.parquet")
    # the files of a table are in no order of time, so its batches can hold rows of any age
    rows = drain(spark, daily_counts(stream, lateness=None))
    return rows.groupBy("day").agg(F.max_by("n_success", "batch").alias("n_success"), F.max_by("n_fail", "batch").alias("n_fail"))

"""Structured Streaming face of ingestion: hourly averages of readings with a
watermark, de-duplication of re-fetched rows, exactly-once append to the
year/month-partitioned lake (the checkpoint replaces the JSON watermark)."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.config import KEY, TIME
from hourcast.session import ensure_checkpoint_dir

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read_readings_stream(spark: SparkSession, source_dir: str, glob: str = "events.parquet",
                         max_files: int | None = None) -> DataFrame:
    """Landed readings as a stream; event time cast to TIMESTAMP (watermarks
    reject TIMESTAMP_NTZ), station = event_type."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    ev = r.parquet(source_dir)
    return ev.select(F.col("event_type").alias(KEY), F.col("ts").cast("timestamp").alias("ts"),
                     "event_id", "value")


def stream_dedupe(readings: DataFrame, delay: str = "2 hours", keys=("event_id",)) -> DataFrame:
    """Drop re-fetched rows (same keys) within the watermark delay."""
    return readings.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def stream_hourly_avg(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly average per station; append mode emits a window once the
    watermark passes its end (late rows beyond the delay are dropped)."""
    agg = (readings.withWatermark("ts", delay)
                   .groupBy(KEY, F.window("ts", "1 hour").alias("w"))
                   .agg(F.avg("value").alias("pm2_5"), F.count(F.lit(1)).alias("n")))
    return agg.select(KEY, F.col("w.start").cast("timestamp_ntz").alias(TIME), "pm2_5", "n")


def stream_append(df: DataFrame, lake_path: str, checkpoint: str, trigger_once: bool = True):
    """Exactly-once append to ``lake_path`` partitioned by year/month."""
    out = df.withColumn("year", F.year(TIME)).withColumn("month", F.month(TIME))
    w = (out.writeStream.format("parquet").option("path", lake_path).option("checkpointLocation", checkpoint)
            .partitionBy("year", "month").outputMode("append"))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="1 minute")
    return w.start()


def stream_append_batches(df: DataFrame, lake_path: str, checkpoint: str):
    """Append by micro-batches that can be repeated: batch ``n`` owns the partition ``batch=n`` of the lake and replaces
    it as a whole, so a batch that was written but not yet committed when the query stopped is written again with the
    same rows. Runs over everything available and returns the query; the checkpoint says where the next one goes on."""
    def write(rows: DataFrame, batch: int) -> None:
        out = rows.withColumn("year", F.year(TIME)).withColumn("month", F.month(TIME))
        out.write.mode("overwrite").partitionBy("year", "month").parquet(f"{lake_path}/batch={batch}")

    return (df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
              .trigger(availableNow=True).start())


def run_available(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Drive a streaming query over everything available into a Parquet
    table under the checkpoint folder and return the table."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/stream-{name}-{uuid.uuid4().hex[:8]}"
    if TIME in df.columns:
        q = stream_append(df, f"{base}/data", f"{base}/_checkpoint")
    else:
        q = (df.writeStream.format("parquet").option("path", f"{base}/data")
               .option("checkpointLocation", f"{base}/_checkpoint").outputMode("append")
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/data")

"""Streaming forms of the tile intake and the step monitor, each with a batch twin of the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def intake_batch(attempts: DataFrame, limit: float) -> DataFrame:
    """Per tile: latest complete attempt, attempts, failures."""
    good = F.col("nodata_share") <= limit
    return attempts.groupBy("tile").agg(F.max(F.when(good, F.col("attempt"))).alias("attempt"), F.count(F.lit(1)).alias("attempts"), F.count_if(~good).alias("failed"))


def intake_stream(spark: SparkSession, folder: str, schema: str, state: str, checkpoint: str, limit: float):
    """Merge arriving attempts into a state table: one folder per batch id, so a repeated batch overwrites its own output.

    The latest folder is the state; a restart reads the last committed batch. Counts add and the latest attempt is a maximum.
    """

    def merge(batch: DataFrame, number: int) -> None:
        new = intake_batch(batch, limit)
        if number:
            old = spark.read.parquet(f"{state}/batch={number - 1}").select(new.columns)
            new = old.unionByName(new).groupBy("tile").agg(F.max("attempt").alias("attempt"), F.sum("attempts").alias("attempts"), F.sum("failed").alias("failed"))
        new.write.mode("overwrite").parquet(f"{state}/batch={number}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def monitor(runs: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts, mean, median and 90 % duration and the last status per step and tumbling window; on a stream, rows later than the watermark are dropped."""
    t = runs.withWatermark("finished_at", late) if runs.isStreaming else runs
    return t.groupBy("step", F.window("finished_at", window)).agg(F.count(F.lit(1)).alias("n"), F.avg("seconds").alias("mean"), F.percentile("seconds", F.lit(0.5)).alias("p50"), F.percentile("seconds", F.lit(0.9)).alias("p90"), F.max_by("ok", F.struct("finished_at", "event_id")).alias("ok"))

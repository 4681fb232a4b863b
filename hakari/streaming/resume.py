"""The resumable step as a stream: records arrive, those not done yet are handled, once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_once_per_key(arrivals: DataFrame, key: Column, handle: Callable[[DataFrame], DataFrame], results: str, checkpoint: str, late: str = "30 days", arrived: str | None = None):
    """Start a stream that appends handle(new records) to the Parquet table at `results`.

    A record whose key is in the results already is skipped (left anti join on the small key column), so that a
    replayed batch adds nothing; each batch writes under its own number, which makes the write idempotent. With
    `arrived`, keys older than the watermark are forgotten in the stream's own state of seen keys.
    """
    source = arrivals.withColumn("_key", key)
    if arrived:
        source = source.withWatermark(arrived, late).dropDuplicatesWithinWatermark(["_key"])

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        try:
            done = spark.read.parquet(results).where(F.col("_batch") != number).select("_key").distinct()
            df = df.join(done, "_key", "left_anti")
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        df = df.dropDuplicates(["_key"])
        handle(df).withColumn("_batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(results)

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Counts per region and event-time window, kept in the state store of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pick import upsert_view
from ..operators.traffic import stands_for

KEYS = ("region", "bucket")
SCHEMA = "region string, bucket bigint, count bigint, batch_id bigint"


def windowed_counts(rows: DataFrame, *, bucket_seconds: int = 30, delay: str = "10 minutes") -> DataFrame:
    """``(region, bucket, count)`` of streamed rows, enriched or counted, with ``region`` and ``event_time``.

    A bucket is counted until the watermark, ``delay`` behind the newest event, has passed its end;
    rows that come later than that are dropped, and the bucket's state is released.
    """
    window = F.window("event_time", f"{bucket_seconds} seconds")
    counted = rows.withWatermark("event_time", delay).groupBy("region", window).agg(
        F.sum(stands_for(rows)).alias("count")
    )
    bucket = F.floor(F.unix_seconds(F.col("window")["start"]) / bucket_seconds)
    return counted.select("region", bucket.alias("bucket"), "count")


def start_counts(
    rows: DataFrame,
    *,
    folder: str,
    checkpoint: str,
    bucket_seconds: int = 30,
    delay: str = "10 minutes",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Maintain the counts below ``folder``: each batch stores the buckets that it changed.

    A batch owns one partition and overwrites it as a whole, so a replay changes nothing.
    """

    def store(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")

    counts = windowed_counts(rows, bucket_seconds=bucket_seconds, delay=delay)
    writer = counts.writeStream.outputMode("update").foreachBatch(store)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The newest count of every bucket."""
    stored = spark.read.schema(SCHEMA).parquet(folder)
    return upsert_view(stored, KEYS).drop("batch_id")

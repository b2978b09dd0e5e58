"""Traffic forecast: a least-squares line through the counts of time buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_exact, snap
from .traffic import stands_for


def bucket_counts(df: DataFrame, *, bucket_seconds: int = 30) -> DataFrame:
    """Rows per region and time bucket; buckets without rows do not appear."""
    bucket = F.floor(F.col("timestamp") / bucket_seconds).alias("bucket")
    return df.groupBy("region", bucket).agg(F.sum(stands_for(df)).alias("count"))


def forecast(df: DataFrame, *, bucket_seconds: int = 30, min_rows: int = 3) -> DataFrame:
    """Predicted count of the bucket after each region's last one.

    A region with fewer than ``min_rows`` rows predicts its row count; one bucket alone
    predicts its count (slope 0). ``fitted`` is the value before it is cut at zero and
    rounded. Both groupings sum map-side, so a busy region is no hot group.
    """
    sums = (
        bucket_counts(df, bucket_seconds=bucket_seconds)
        .groupBy("region")
        .agg(
            F.sum("count").alias("rows"),
            F.count(F.lit(1)).alias("buckets"),
            F.sum("bucket").alias("bucket_sum"),
            F.max("bucket").alias("last"),
            F.regr_slope("count", "bucket").alias("slope"),
        )
    )
    rows, buckets = F.col("rows"), F.col("buckets")
    slope = F.when(buckets > 1, F.col("slope")).otherwise(0.0)
    # Distance of the next bucket from the mean one; integer until the division, as
    # bucket numbers are large against their spread.
    ahead = ((F.col("last") + 1) * buckets - F.col("bucket_sum")) / buckets
    line = rows / buckets + slope * ahead
    fitted = F.when(rows < min_rows, rows.cast("double")).otherwise(line)
    predicted = F.greatest(F.lit(0.0), round_exact(snap(F.col("fitted")), 1))
    return sums.select("region", "rows", "buckets", fitted.alias("fitted")).withColumn(
        "predicted", predicted
    )


def top_forecasts(predictions: DataFrame, n: int = 3) -> DataFrame:
    return predictions.orderBy(F.col("predicted").desc(), "region").limit(n)

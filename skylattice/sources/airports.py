"""Airport reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_airports(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; columns go by name, unreadable coordinates become null."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(
        F.col("latitude_deg").try_cast("double").alias("ap_lat"),
        F.col("longitude_deg").try_cast("double").alias("ap_lon"),
        "iso_country",
        "iso_region",
        "type",
    )

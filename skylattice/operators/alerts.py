"""Congestion, surge and anomaly alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed_text
from ..sources.storage import materialize
from .pick import latest, one_per_key

# Tier limits of the congestion index, and the columns of an alert.
HIGH_ABOVE, MEDIUM_ABOVE = 1.2, 0.8
COLUMNS = ["type", "level", "region", "message"]


def _tier(high: float, medium: float) -> Column:
    aci = F.col("aci")
    return F.when(aci > high, "HIGH").when(aci > medium, "MEDIUM")


# The wordings of the messages below are fixed values, too.
def congestion_alerts(
    metrics: DataFrame, *, high: float = HIGH_ABOVE, medium: float = MEDIUM_ABOVE
) -> DataFrame:
    message = F.concat(
        F.col("level"),
        F.lit(" CONGESTION in "),
        F.col("region"),
        F.lit(": ACI="),
        fixed_text(F.col("aci"), 2),
        F.lit(", "),
        F.col("aircraft_count").cast("string"),
        F.lit(" aircraft"),
    )
    return (
        metrics.withColumns({"type": F.lit("CONGESTION"), "level": _tier(high, medium)})
        .where(F.col("level").isNotNull())
        .withColumn("message", message)
        .select(*COLUMNS)
    )


def alert_table(
    metrics: DataFrame, *, high: float = HIGH_ABOVE, medium: float = MEDIUM_ABOVE
) -> DataFrame:
    """The stored form: region and alert type (time is stamped on writing)."""
    kind = F.concat(_tier(high, medium), F.lit("_CONGESTION"))
    return metrics.withColumn("alert_type", kind).where(F.col("alert_type").isNotNull())


def alert_tiers(
    metrics: DataFrame, *, high: float = HIGH_ABOVE, medium: float = MEDIUM_ABOVE
) -> DataFrame:
    """Tier of every region's latest metrics row."""
    tier = F.coalesce(F.lower(_tier(high, medium)), F.lit("normal"))
    return latest(metrics, "region").withColumn("tier", tier)


def _surges(counts: DataFrame, pct: float) -> DataFrame:
    """Rows whose ``aircraft_count`` exceeds ``previous_count`` by more than ``pct`` %."""
    current, previous = F.col("aircraft_count"), F.col("previous_count")
    change = (current - previous) / previous * 100
    return counts.where(previous > 0).withColumn("change_pct", change).where(F.col("change_pct") > pct)


def surge_rows(current: DataFrame, previous: DataFrame, *, pct: float = 50) -> DataFrame:
    """Regions that grew against the previous batch; a region new to it cannot surge."""
    before = previous.select("region", F.col("aircraft_count").alias("previous_count"))
    return _surges(current.join(before, "region"), pct)


def previous_batches(counts: DataFrame) -> DataFrame:
    """Each non-empty batch with the non-empty batch before it.

    The ids are cut into ranges of like number, however they are spaced; only the last id
    of each range goes through the one global ordering. The ranges are stored, because a
    second pass might cut them elsewhere.
    """
    ids = counts.select("batch_id").distinct()
    ranges = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(ranges, "batch_id")
    ids = materialize(ranged.withColumn("block", F.spark_partition_id()))
    ends = ids.groupBy("block").agg(F.max("batch_id").alias("end"))
    ends = ends.select("block", F.lag("end").over(Window.orderBy("block")).alias("end_before"))
    inside = F.lag("batch_id").over(Window.partitionBy("block").orderBy("batch_id"))
    return (
        ids.withColumn("inside", inside)
        .join(ends, "block")
        .select("batch_id", F.coalesce("inside", "end_before").alias("previous_batch"))
    )


def surge_history(counts: DataFrame, *, pct: float = 50) -> DataFrame:
    """Surges of a whole history of (batch_id, region, aircraft_count) rows.

    The counts are read three times, so they are stored first: what they are summed up
    from is read once.
    """
    counts = materialize(counts.select("batch_id", "region", "aircraft_count"))
    window = Window.partitionBy("region").orderBy("batch_id")
    linked = counts.withColumns(
        {
            "previous_batch": F.lag("batch_id").over(window),
            "previous_count": F.lag("aircraft_count").over(window),
        }
    ).join(previous_batches(counts), ["batch_id", "previous_batch"])
    return _surges(linked, pct)


def surge_alerts(surges: DataFrame) -> DataFrame:
    message = F.concat(
        F.lit("TRAFFIC SURGE in "),
        F.col("region"),
        F.lit(": "),
        F.col("previous_count").cast("string"),
        F.lit(" → "),
        F.col("aircraft_count").cast("string"),
        F.lit(" aircraft (+"),
        fixed_text(F.col("change_pct"), 0),
        F.lit("%)"),
    )
    return surges.withColumns(
        {"type": F.lit("SURGE"), "level": F.lit("MEDIUM"), "message": message}
    ).select(*COLUMNS)


def anomaly_alerts(anomalies: DataFrame) -> DataFrame:
    """One alert per flagged aircraft."""
    features = ["speed_kmh", "altitude", "vertical_rate"]
    single = one_per_key(anomalies, ["icao24"], [F.col(c).asc_nulls_last() for c in features])
    message = F.concat(
        F.lit("ANOMALY: "),
        F.col("icao24"),
        F.lit(" — speed="),
        fixed_text(F.col("speed_kmh"), 1),
        F.lit(" km/h, alt="),
        fixed_text(F.col("altitude"), 0),
        F.lit("m, vrate="),
        fixed_text(F.col("vertical_rate"), 1),
        F.lit(" m/s"),
    )
    return single.select(
        F.lit("ANOMALY").alias("type"),
        F.lit("HIGH").alias("level"),
        F.lit("N/A").alias("region"),
        message.alias("message"),
    )


def all_alerts(*alerts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, alerts)

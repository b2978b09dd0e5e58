"""Counts and means per region and per country.

Everything here derives from one kind of partial sums, ``traffic_totals``. Raw rows
are summed map-side and shuffled once; a caller that needs several groupings (a
micro-batch does) sums by (region, country) once and rolls the small result up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flight
from ..functions.numeric import round_scaled, snap, truncate2
from .flights import score_tenths

_SUMS = ("rows", "speed", "altitude", "levels", "capacity", "score_tenths", "scored")


def stands_for(rows: DataFrame) -> Column:
    """The number of flight x airport pairs that a row stands for (see ``counted_join``)."""
    return F.col("airports") if "airports" in rows.columns else F.lit(1).cast("bigint")


def traffic_totals(rows: DataFrame, keys: Sequence[str] = ("region", "country")) -> DataFrame:
    """Partial sums of enriched rows, or of counted ones, per key."""
    n = stands_for(rows)
    tenths = F.col("score_tenths") if "score_tenths" in rows.columns else score_tenths()
    return rows.groupBy(*keys).agg(
        F.sum(n).alias("rows"),
        F.sum(F.col("speed_kmh") * n).alias("speed"),
        F.sum(F.col("altitude") * n).alias("altitude"),
        F.coalesce(F.sum(F.when(F.col("altitude").isNotNull(), n)), F.lit(0)).alias("levels"),
        F.sum("effective_capacity").alias("capacity"),
        F.coalesce(F.sum(tenths * n), F.lit(0)).alias("score_tenths"),
        F.coalesce(F.sum(F.when(tenths.isNotNull(), n)), F.lit(0)).alias("scored"),
    )


def roll_up(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coarser totals from finer ones."""
    return totals.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUMS])


def region_counts_of(totals: DataFrame) -> DataFrame:
    return totals.select("region", F.col("rows").alias("aircraft_count"))


def region_avg_speed_of(totals: DataFrame) -> DataFrame:
    mean = snap(F.col("speed") / F.col("rows"))
    return totals.select("region", truncate2(mean).alias("avg_speed"))


def region_metrics_of(totals: DataFrame, by: Sequence[str] = ("region",)) -> DataFrame:
    capacity = F.col("capacity") / F.col("rows")
    return totals.select(
        *by,
        F.col("rows").alias("aircraft_count"),
        capacity.alias("capacity"),
        (F.col("rows") / capacity).alias("aci"),
    )


def country_metrics_of(totals: DataFrame, by: Sequence[str] = ("country",)) -> DataFrame:
    return totals.where(F.col("country").isNotNull()).select(
        *by,
        F.col("rows").alias("total_flights"),
        F.try_divide("altitude", "levels").alias("avg_altitude"),
        flight.traffic_density(F.col("rows")).alias("traffic_density"),
    )


def mean_efficiency_of(totals: DataFrame) -> DataFrame:
    """One row: mean of the rounded scores, and the same rounded to one decimal."""
    sums = totals.agg(F.sum("score_tenths").alias("t"), F.sum("scored").alias("n"))
    mean = F.try_divide(F.col("t"), F.col("n") * 10.0)
    return sums.select(
        F.col("n").alias("scored"),
        mean.alias("mean_score"),
        round_scaled(mean, 1).alias("avg_efficiency"),
    )


def region_counts(rows: DataFrame) -> DataFrame:
    """Rows per region."""
    return rows.groupBy("region").agg(F.sum(stands_for(rows)).alias("aircraft_count"))


def region_avg_speed(rows: DataFrame) -> DataFrame:
    """Mean speed per region, cut to two decimals."""
    return region_avg_speed_of(traffic_totals(rows, ["region"]))


def region_metrics(rows: DataFrame, *, by: Sequence[str] = ("region",)) -> DataFrame:
    """Row count, mean capacity and their ratio, the congestion index ``aci``."""
    return region_metrics_of(traffic_totals(rows, by), by)


def country_metrics(rows: DataFrame, *, by: Sequence[str] = ("country",)) -> DataFrame:
    """Row count and mean altitude of each known country, in one pass."""
    known = rows.where(F.col("country").isNotNull())
    return country_metrics_of(traffic_totals(known, by), by)


def top_regions(counts: DataFrame, n: int = 5) -> DataFrame:
    return counts.orderBy(F.col("aircraft_count").desc(), "region").limit(n)


def speed_sample(speeds: DataFrame, n: int = 5) -> DataFrame:
    """The first regions by name."""
    return speeds.orderBy("region").limit(n)


def batch_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.coalesce(F.sum(stands_for(rows)), F.lit(0)).alias("records"))

"""Queries of a monitoring page over the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import flight
from ..functions.numeric import round_scaled
from ..operators.flights import project_available
from ..operators.pick import latest, recent, top
from ..operators.quantiles import exact_quantiles
from ..sources.maintained import MaintainedTables

# Default scan limits, columns and lengths of the lists shown.
SCAN_LIMITS = {
    "flight_events": 500,
    "region_metrics": 200,
    "country_metrics": 100,
    "anomaly_logs": 100,
}
SCAN_KEYS = {
    "flight_events": "icao24",
    "region_metrics": "region",
    "country_metrics": "country",
    "anomaly_logs": "icao24",
}
MAP_COLUMNS = ["latitude", "longitude", "band", "callsign", "country", "altitude", "velocity"]
EVENT_COLUMNS = [
    "icao24",
    "callsign",
    "country",
    "altitude",
    "velocity",
    "latitude",
    "longitude",
    "vertical_rate",
    "timestamp",
]
CONGESTED_ABOVE = 0.8


def _newest_first(df: DataFrame, key: str) -> list[Column]:
    """By time, key, and the batch that wrote the row where the table says so."""
    batch = [F.col("batch_id").desc()] if "batch_id" in df.columns else []
    return [F.col("timestamp").desc(), F.col(key).asc(), *batch]


def scan(df: DataFrame, table: str, limit: int | None = None) -> DataFrame:
    """The newest rows of a result table."""
    newest = _newest_first(df, SCAN_KEYS[table])
    return recent(df, newest, SCAN_LIMITS[table] if limit is None else limit)


def scan_stored(
    spark: SparkSession, tables: MaintainedTables, table: str, limit: int | None = None
) -> DataFrame:
    """``scan`` of a maintained table: batches and days without rows so new are not opened."""
    order = [F.col("timestamp").desc(), F.col(SCAN_KEYS[table]).asc(), F.col("batch_id").desc()]
    return tables.newest(spark, table, order, SCAN_LIMITS[table] if limit is None else limit)


def kpis(flight_events: DataFrame, region_metrics: DataFrame, anomaly_logs: DataFrame) -> DataFrame:
    """One row of headline numbers, one aggregation per table."""
    mean = F.avg("altitude")
    flights = flight_events.agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_distinct("country").alias("total_countries"),
        F.coalesce(round_scaled(mean, 0), F.lit(0.0)).alias("avg_altitude"),
    )
    anomalies = anomaly_logs.agg(F.count(F.lit(1)))
    congested = region_metrics.agg(F.count_if(F.col("aci") > CONGESTED_ABOVE))
    return flights.select(
        "*",
        anomalies.scalar().alias("total_anomalies"),
        congested.scalar().alias("congested_regions"),
    )


def map_points(flight_events: DataFrame) -> DataFrame:
    """Positions with their altitude band and the columns shown on hover."""
    placed = flight_events.dropna(subset=["latitude", "longitude"])
    banded = placed.withColumn("band", flight.altitude_band(F.col("altitude")))
    return project_available(banded, MAP_COLUMNS)


def anomaly_list(anomaly_logs: DataFrame, n: int = 8) -> DataFrame:
    newest = _newest_first(anomaly_logs, "icao24")
    return project_available(recent(anomaly_logs, newest, n), ["icao24", "reason"])


def top_countries(country_metrics: DataFrame, n: int = 20) -> DataFrame:
    return top(latest(country_metrics, "country"), "total_flights", n, tie="country")


def top_regions_aci(region_metrics: DataFrame, n: int = 25) -> DataFrame:
    """Busiest regions with their congestion index."""
    return top(latest(region_metrics, "region"), "aircraft_count", n, tie="region")


def top_altitude_countries(country_metrics: DataFrame, n: int = 15) -> DataFrame:
    return top(latest(country_metrics, "country"), "avg_altitude", n, tie="country")


def altitude_histogram(flight_events: DataFrame, *, bins: int = 40) -> DataFrame:
    """Equal-width bins from the smallest to the greatest altitude, empty ones included."""
    altitudes = flight_events.select("altitude").dropna()
    span = altitudes.agg(
        F.min("altitude").alias("low"), F.max("altitude").alias("high")
    )
    low, high = span.select("low").scalar(), span.select("high").scalar()
    measured = altitudes.select("altitude", low.alias("low"), high.alias("high"))
    place = F.floor((F.col("altitude") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    # One value only: everything falls into the first bin.
    place = F.when(F.col("high") > F.col("low"), F.least(place, F.lit(bins - 1))).otherwise(0)
    counted = measured.groupBy(place.cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("flights")
    )
    edges = flight_events.sparkSession.range(bins).select(
        F.col("id").alias("bin"), low.alias("low"), ((high - low) / bins).alias("width")
    )
    return (
        edges.where("low is not null")
        .join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("width") * F.col("bin")).alias("bin_start"),
            F.coalesce("flights", F.lit(0).cast("long")).alias("flights"),
        )
    )


def speed_summary(flight_events: DataFrame) -> DataFrame:
    """Quartiles, range and mean of the speed in km/h.

    The table is read several times for the quartiles: pass stored rows, or store
    them with ``sources.storage.materialize`` first.
    """
    speeds = flight_events.select(flight.speed_kmh(F.col("velocity")).alias("speed_kmh")).dropna()
    quartiles = exact_quantiles(speeds, "speed_kmh", [0.25, 0.5, 0.75])
    return speeds.agg(
        F.count(F.lit(1)).alias("flights"),
        F.min("speed_kmh").alias("min_speed"),
        *[
            F.lit(value).cast("double").alias(name)
            for name, value in zip(("q1", "median", "q3"), quartiles)
        ],
        F.max("speed_kmh").alias("max_speed"),
        F.avg("speed_kmh").alias("mean_speed"),
    )


def status_breakdown(flight_events: DataFrame) -> DataFrame:
    """Rows per flight status, most frequent first."""
    status = flight.flight_status(F.col("vertical_rate")).alias("flight_status")
    counted = flight_events.groupBy(status).agg(F.count(F.lit(1)).alias("flights"))
    return counted.orderBy(F.col("flights").desc(), "flight_status")


def recent_events(flight_events: DataFrame, n: int = 50) -> DataFrame:
    newest = _newest_first(flight_events, "icao24")
    return project_available(recent(flight_events, newest, n), EVENT_COLUMNS)

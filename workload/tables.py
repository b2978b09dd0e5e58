"""Domain tables derived from the given tables (see FIXTURES.md).

The expressions are those of ``workload.oracles``; every one is row-wise, so the derived
tables grow with the given ones and need no shuffle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skylattice.operators import traffic
from skylattice.operators.pick import upsert_view
from skylattice.operators.proximity import counted_cells
from skylattice.plans.enrich import counted_at_airports, enrich, ml_aircraft, prepare
from skylattice.schemas import FLIGHT_EVENT, TABLES
from skylattice.sources.storage import delete_at_exit, shared_dir
from skylattice.functions import flight

DAY_SECONDS = 86400
VECTORS_PER_DOCUMENT = 100


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def flights_from(events: DataFrame) -> DataFrame:
    """Flight events, with the id and the day (batch) of the source row."""
    # Differences of zone-free times: independent of the session's time zone.
    steps = events.selectExpr(
        "*",
        "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS epoch_s",
        "(event_id * 7919 % 10007) / 10007D AS lat_step",
        "((event_id * 104729 + user_id * 31) % 10009) / 10009D AS lon_step",
    )
    return steps.selectExpr(
        "event_id",
        f"floor(epoch_s / {DAY_SECONDS}) AS batch_id",
        "concat('u', user_id) AS icao24",
        "if(event_id % 19 = 0, null, concat(upper(event_type), user_id % 10)) AS callsign",
        "if(event_id % 41 = 0, null, event_type) AS country",
        "epoch_s AS timestamp",
        "if(event_id % 53 = 0, null, -10D + 50D * (lon_step * lon_step)) AS longitude",
        "30D + 30D * (lat_step * lat_step) AS latitude",
        "double(event_id * 31 % 13000 - 200) AS altitude",
        "value * 4 AS velocity",
        "if(event_id % 17 = 0, null, double(event_id * 13 % 41 - 20)) AS vertical_rate",
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from(read(spark, sf_dir, "events"))


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").selectExpr(
        "30D + (s_suppkey * 3571 + s_nationkey * 977) % 3001 / 100D AS ap_lat",
        "-10D + (s_suppkey * 2713 + s_nationkey * 1409) % 5003 / 100D AS ap_lon",
        "if(s_nationkey % 9 = 0, null, concat('XX-', s_nationkey)) AS iso_region",
        """CASE s_suppkey % 5 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'
           WHEN 2 THEN 'small_airport' WHEN 3 THEN 'heliport' END AS type""",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(flights(spark, sf_dir), airports(spark, sf_dir))


def counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched rows for sums: one row stands for several airports of a region."""
    return counted_at_airports(prepare(flights(spark, sf_dir)), counted_cells(airports(spark, sf_dir)))


def aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ml_aircraft(flights(spark, sf_dir), airports(spark, sf_dir))


def _daily(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("batch_id") * DAY_SECONDS))


def daily_region_metrics(rows: DataFrame) -> DataFrame:
    return _daily(traffic.region_metrics(rows, by=("batch_id", "region")))


def region_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored metrics, one batch per day."""
    return daily_region_metrics(counted(spark, sf_dir))


def country_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(traffic.country_metrics(counted(spark, sf_dir), by=("batch_id", "country")))


def stored_events(prepared: DataFrame) -> DataFrame:
    """The last write per key of prepared flights."""
    timed = prepared.withColumn("timestamp", F.timestamp_seconds("timestamp"))
    return upsert_view(timed.select("batch_id", *TABLES["flight_events"].names))


def flight_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events: the last write per key, in days."""
    return stored_events(prepare(flights(spark, sf_dir)))


def anomaly_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in log with a rule SQL can state: very steep climbs and descents."""
    return steep_flights(flight_events(spark, sf_dir))


def steep_flights(stored: DataFrame) -> DataFrame:
    steep = stored.where(F.abs("vertical_rate") >= 19)
    return steep.select(
        "batch_id",
        "icao24",
        flight.speed_kmh(F.col("velocity")).alias("speed_kmh"),
        "altitude",
        "vertical_rate",
        F.lit(-1.0).alias("anomaly_score"),
        "timestamp",
        F.lit("IsolationForest anomaly").alias("reason"),
    )


def state_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll documents: up to 100 consecutive events each, as positional text vectors.

    Call signs are padded, and empty where the event has none.
    """
    raw = flights(spark, sf_dir)
    text = {name: F.col(name).cast("string") for name in FLIGHT_EVENT.names}
    text["callsign"] = F.coalesce(
        F.concat(F.lit(" \t"), F.col("callsign"), F.lit("  ")), F.lit("")
    )
    unused = F.lit(None).cast("string")
    vector = F.array(
        text["icao24"],
        text["callsign"],
        text["country"],
        text["timestamp"],
        text["timestamp"],
        text["longitude"],
        text["latitude"],
        text["altitude"],
        F.lit("false"),
        text["velocity"],
        unused,
        text["vertical_rate"],
        *[unused] * 5,
    )
    numbered = raw.select(
        F.floor(F.col("event_id") / VECTORS_PER_DOCUMENT).alias("time"),
        F.struct("event_id", vector.alias("vector")).alias("entry"),
    )
    # Event ids are unique, so a document never holds more than its 100 vectors.
    documents = numbered.groupBy("time").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    states = F.transform("entries", lambda entry: entry["vector"])
    document = F.struct(F.col("time"), states.alias("states"))
    return documents.select(F.to_json(document, {"ignoreNullFields": "false"}).alias("value"))


def airports_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the airports as the CSV the reader expects; some latitudes are unreadable."""
    path = f"{shared_dir(spark)}/airports-{uuid.uuid4().hex}"
    rows = airports(spark, sf_dir)
    latitude = F.when(F.col("type").isNull(), "n/a").otherwise(F.col("ap_lat").cast("string"))
    rows.select(
        F.lit("AP").alias("ident"),
        "type",
        latitude.alias("latitude_deg"),
        F.col("ap_lon").cast("string").alias("longitude_deg"),
        F.substring("iso_region", 1, 2).alias("iso_country"),
        "iso_region",
    ).write.option("header", True).csv(path)
    delete_at_exit(spark, path)
    return path

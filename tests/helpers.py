"""Builders of hand-written rows."""

from skylattice.schemas import AIRPORTS, FLIGHT_EVENT

EVENT = {
    "icao24": "a1",
    "callsign": "AB1",
    "country": "X",
    "timestamp": 1_700_000_000,
    "longitude": 10.5,
    "latitude": 50.5,
    "altitude": 5000.0,
    "velocity": 200.0,
    "vertical_rate": 0.0,
}


def events(spark, *changes):
    rows = [EVENT | change for change in changes]
    return spark.createDataFrame([[r[n] for n in FLIGHT_EVENT.names] for r in rows], FLIGHT_EVENT)


def airports(spark, *rows):
    """Rows of (latitude, longitude, region, type)."""
    full = [(lat, lon, "XX", region, kind) for lat, lon, region, kind in rows]
    return spark.createDataFrame(full, AIRPORTS)


def metrics(spark, *rows):
    """Rows of (region, aircraft_count, aci)."""
    return spark.createDataFrame(list(rows), "region string, aircraft_count bigint, aci double")


def column(df, name, *order):
    return [row[name] for row in (df.orderBy(*order) if order else df).collect()]

"""Schemas of the inputs and of the result tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_text, _long, _double, _time = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()

#: One aircraft observation, as carried in a JSON message.
FLIGHT_EVENT = _struct(
    icao24=_text,
    callsign=_text,
    country=_text,
    timestamp=_long,
    longitude=_double,
    latitude=_double,
    altitude=_double,
    velocity=_double,
    vertical_rate=_double,
)

#: Document of one poll: positional vectors of mixed type, read as text.
STATE_DOCUMENT = _struct(time=_long, states=T.ArrayType(T.ArrayType(_text)))

AIRPORTS = _struct(
    ap_lat=_double, ap_lon=_double, iso_country=_text, iso_region=_text, type=_text
)

#: Keys of result tables: a later row of equal key replaces an earlier one.
KEYS = {"flight_events": ("icao24", "timestamp")}

#: Result tables, without the ``batch_id`` partition column.
TABLES = {
    "flight_events": _struct(
        icao24=_text,
        timestamp=_time,
        altitude=_double,
        callsign=_text,
        country=_text,
        latitude=_double,
        longitude=_double,
        velocity=_double,
        vertical_rate=_double,
    ),
    "region_metrics": _struct(
        region=_text, aircraft_count=_long, capacity=_double, aci=_double, timestamp=_time
    ),
    "country_metrics": _struct(
        country=_text,
        total_flights=_long,
        avg_altitude=_double,
        traffic_density=_double,
        timestamp=_time,
    ),
    "anomaly_logs": _struct(
        icao24=_text,
        speed_kmh=_double,
        altitude=_double,
        vertical_rate=_double,
        anomaly_score=_double,
        timestamp=_time,
        reason=_text,
    ),
    "alerts": _struct(region=_text, timestamp=_time, alert_type=_text),
}

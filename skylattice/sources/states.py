"""Raw poll documents to flight events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import flight
from ..schemas import FLIGHT_EVENT, STATE_DOCUMENT

# Position of each field in a state vector.
POSITIONS = {
    "icao24": 0,
    "callsign": 1,
    "country": 2,
    "timestamp": 3,
    "longitude": 5,
    "latitude": 6,
    "altitude": 7,
    "velocity": 9,
    "vertical_rate": 11,
}
VECTOR_LENGTH = max(POSITIONS.values()) + 1


def decode_states(
    docs: DataFrame, *, value: str = "value", max_records: int | None = None
) -> DataFrame:
    """One row per usable state vector of the JSON documents in column ``value``.

    ``max_records`` keeps the first vectors of each document, counted before unusable
    ones are dropped. Vectors that are too short, and positions that are missing or
    exactly 0, are dropped. A document without vectors gives no rows.
    """
    document = F.from_json(F.col(value).cast("string"), STATE_DOCUMENT)
    states = document["states"]
    if max_records is not None:
        states = F.slice(states, 1, max_records)

    def field(name: str):
        raw = F.get("vector", F.lit(POSITIONS[name]))
        if name == "callsign":
            raw = flight.callsign(raw)
        kind = FLIGHT_EVENT[name].dataType
        return raw.try_cast(kind).alias(name)

    return (
        docs.select(F.explode(states).alias("vector"))
        .where(F.size("vector") >= VECTOR_LENGTH)
        .select(*[field(name) for name in FLIGHT_EVENT.names])
        .where((F.col("latitude") != 0) & (F.col("longitude") != 0))
    )

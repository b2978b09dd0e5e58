"""Input of the learning steps: one complete row per aircraft."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pick import one_per_key

# The columns of a learning row.
COLUMNS = ["icao24", "speed_kmh", "altitude", "vertical_rate", "region", "timestamp"]
_MEASURED = [name for name in COLUMNS if name != "region"]
#: Learning runs only on more rows than this.
MIN_ROWS = 10
PROBE_ROWS_PER_AIRCRAFT = 50

# The newest row of an aircraft; the rest only breaks ties. The region comes last: it is
# known after the join only, so the flight can be chosen before it.
_FLIGHT_ORDER = ["speed_kmh", "altitude", "vertical_rate", "latitude", "longitude"]


def _order(*names: str):
    return [F.col("timestamp").desc(), *[F.col(name) for name in names]]


def _complete(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every column and a finite vertical rate."""
    return rows.dropna(subset=columns).where(F.abs("vertical_rate") < math.inf)


def newest_flights(flights: DataFrame) -> DataFrame:
    """Each aircraft's newest complete observation, before any join to airports.

    Taking ``aircraft_rows`` after joining these few rows gives the same result as after
    joining all flights.
    """
    return one_per_key(_complete(flights, _MEASURED), ["icao24"], _order(*_FLIGHT_ORDER))


def aircraft_rows(rows: DataFrame) -> DataFrame:
    """The newest complete row of each aircraft among enriched rows."""
    needed = _complete(rows.select(*COLUMNS, "latitude", "longitude"), COLUMNS)
    return one_per_key(needed, ["icao24"], _order(*_FLIGHT_ORDER, "region")).select(*COLUMNS)


def enough_rows(flights: DataFrame, *, min_rows: int = MIN_ROWS) -> bool:
    """Whether complete observations of more than ``min_rows`` aircraft exist.

    The first few rows nearly always tell; only otherwise all ids are looked at.
    """
    ids = _complete(flights, _MEASURED).select("icao24")
    probe = ids.take(PROBE_ROWS_PER_AIRCRAFT * (min_rows + 1))
    if len({row["icao24"] for row in probe}) > min_rows:
        return True
    return ids.distinct().limit(min_rows + 1).count() > min_rows


def ml_input(rows: DataFrame, *, min_rows: int = MIN_ROWS) -> DataFrame:
    """``aircraft_rows``, or nothing when there are too few of them."""
    aircraft = aircraft_rows(rows)
    return aircraft if enough_rows(rows, min_rows=min_rows) else aircraft.limit(0)

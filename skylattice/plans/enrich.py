"""From parsed events to the enriched flight x airport rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import learning
from ..operators.flights import (
    add_airport_capacity,
    add_counted_capacity,
    add_features,
    add_flight_factors,
    add_flight_scores,
    add_joined_capacity,
    clean_flights,
)
from ..operators.proximity import CountedCells, airport_join, counted_cells, counted_join


def prepare(events: DataFrame) -> DataFrame:
    """Valid observations with features: one row per flight, no shuffle."""
    return add_features(clean_flights(events))


def at_airports(
    flights: DataFrame, airports: DataFrame, *, radius: float = 1.0, small: bool | None = None
) -> DataFrame:
    """Prepared flights joined to nearby airports, with capacity and region."""
    near = airport_join(add_flight_factors(flights), add_airport_capacity(airports), radius=radius, small=small)
    return add_joined_capacity(near)


def enrich(
    events: DataFrame, airports: DataFrame, *, radius: float = 1.0, small: bool | None = None
) -> DataFrame:
    return at_airports(prepare(events), airports, radius=radius, small=small)


def counted_at_airports(flights: DataFrame, cells: CountedCells) -> DataFrame:
    """``at_airports`` for sums: a row stands for all ``airports`` of one region that it counts."""
    return add_counted_capacity(counted_join(add_flight_scores(flights), cells))


def aircraft(flights: DataFrame, cells: CountedCells) -> DataFrame:
    """One row per aircraft of prepared flights; only the chosen rows are joined."""
    newest = learning.newest_flights(flights)
    return learning.aircraft_rows(counted_at_airports(newest, cells))


def ml_aircraft(
    events: DataFrame, airports: DataFrame, *, min_rows: int = learning.MIN_ROWS
) -> DataFrame:
    """``learning.ml_input`` of the enriched events, without enriching all of them."""
    flights = prepare(events)
    rows = aircraft(flights, counted_cells(airports))
    return rows if learning.enough_rows(flights, min_rows=min_rows) else rows.limit(0)

"""Per-observation column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_scaled

# Class limits, capacities and factors the results are defined by.
KMH_PER_MS = 3.6
ALTITUDE_LOW_BELOW = 2000
ALTITUDE_MEDIUM_BELOW = 10000
CLIMB_ABOVE = 5
DESCENT_BELOW = -5
REGION_DEGREES = 5
CAPACITY_BY_TYPE = {"large_airport": 120, "medium_airport": 80, "small_airport": 50}
CAPACITY_ELSEWHERE = 30
FAST_KMH, FAST_FACTOR = 850, 0.7
SLOW_KMH, SLOW_FACTOR = 200, 0.9
IDEAL_SPEED_KMH = 850.0
IDEAL_ALTITUDE_M = 10000.0
FLIGHTS_PER_DENSITY_UNIT = 100.0


def callsign(raw: Column) -> Column:
    """Empty text becomes null; surrounding white space of any kind is cut."""
    space = r"[\s\x1c-\x1f]+"  # all white space of Unicode, and the four separators
    return F.when(raw != "", F.regexp_replace(raw, f"(?U)^{space}|{space}$", ""))


def speed_kmh(velocity: Column) -> Column:
    return velocity * KMH_PER_MS


def altitude_band(altitude: Column) -> Column:
    """LOW, MEDIUM or HIGH; a missing altitude counts as HIGH."""
    return (
        F.when(altitude < ALTITUDE_LOW_BELOW, "LOW")
        .when(altitude < ALTITUDE_MEDIUM_BELOW, "MEDIUM")
        .otherwise("HIGH")
    )


def flight_status(vertical_rate: Column) -> Column:
    """CLIMB, DESCENT or STABLE; a missing (null or NaN) rate counts as STABLE."""
    return (
        F.when((vertical_rate > CLIMB_ABOVE) & ~F.isnan(vertical_rate), "CLIMB")
        .when(vertical_rate < DESCENT_BELOW, "DESCENT")
        .otherwise("STABLE")
    )


def geo_region(latitude: Column, longitude: Column, *, cell: int = REGION_DEGREES) -> Column:
    """South-west corner of the grid square, e.g. ``-5_10``."""

    def corner(degrees: Column) -> Column:
        return (F.floor(degrees / cell) * cell).cast("string")

    return F.concat(corner(latitude), F.lit("_"), corner(longitude))


def base_capacity(airport_type: Column) -> Column:
    chain = F
    for kind, places in CAPACITY_BY_TYPE.items():
        chain = chain.when(airport_type == kind, places)
    return chain.otherwise(CAPACITY_ELSEWHERE)


def weather_factor(speed: Column) -> Column:
    """Capacity factor, read off the speed."""
    return F.when(speed > FAST_KMH, FAST_FACTOR).when(speed < SLOW_KMH, SLOW_FACTOR).otherwise(1.0)


def event_time(epoch_seconds: Column) -> Column:
    return F.timestamp_seconds(epoch_seconds)


def traffic_density(flights: Column) -> Column:
    return flights / FLIGHTS_PER_DENSITY_UNIT


def efficiency(
    speed: Column,
    altitude: Column,
    *,
    ideal_speed: float = IDEAL_SPEED_KMH,
    ideal_altitude: float = IDEAL_ALTITUDE_M,
) -> Column:
    """Closeness to the ideal cruise, 0 to 100 with one decimal."""
    def closeness(value: Column, ideal: float) -> Column:
        score = 1 - F.abs(value - ideal) / ideal
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))

    both = closeness(speed, ideal_speed) + closeness(altitude, ideal_altitude)
    return round_scaled(both / 2 * 100, 1)

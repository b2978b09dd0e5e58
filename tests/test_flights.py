import math

from helpers import airports, column, events
from pyspark.sql import functions as F

from skylattice.functions.flight import callsign
from skylattice.operators import flights, learning
from skylattice.plans.enrich import enrich, ml_aircraft, prepare


def ids(spark, **field):
    (name, values), = field.items()
    df = events(spark, *[{"icao24": str(v), name: v} for v in values])
    return set(column(flights.clean_flights(df), "icao24"))


def test_validity_limits_are_inclusive(spark):
    assert ids(spark, latitude=[-90.0, 90.0, -90.01, 90.01, None]) == {"-90.0", "90.0"}
    assert ids(spark, longitude=[-180.0, 180.0, -180.01, 180.01, None]) == {"-180.0", "180.0"}


def test_parked_and_unmeasured_flights_are_dropped(spark):
    values = [0.0, 0.1, -1.0, None, math.nan]
    assert ids(spark, velocity=values) == {"0.1"}
    assert ids(spark, altitude=values) == {"0.1"}


def test_nan_can_be_kept(spark):
    df = events(spark, {"velocity": math.nan})
    assert flights.clean_flights(df, drop_nan=False).count() == 1


def test_bands(spark):
    heights = {1999.9: "LOW", 2000.0: "MEDIUM", 9999.9: "MEDIUM", 10000.0: "HIGH"}
    df = flights.add_features(events(spark, *[{"altitude": h} for h in heights]))
    assert {r["altitude"]: r["altitude_band"] for r in df.collect()} == heights
    missing = flights.add_features(events(spark, {"altitude": None}, {"altitude": math.nan}))
    assert column(missing, "altitude_band") == ["HIGH", "HIGH"]


def test_status(spark):
    rates = {-5.1: "DESCENT", -5.0: "STABLE", 5.0: "STABLE", 5.1: "CLIMB", None: "STABLE"}
    df = flights.add_features(events(spark, *[{"vertical_rate": r} for r in rates]))
    assert {r["vertical_rate"]: r["flight_status"] for r in df.collect()} == rates
    nan = flights.add_features(events(spark, {"vertical_rate": math.nan}))
    assert column(nan, "flight_status") == ["STABLE"]


def test_grid_square_text(spark):
    places = {
        (-0.1, 0.0): "-5_0",
        (-5.0, -5.1): "-5_-10",
        (0.0, 4.99): "0_0",
        (89.9, 180.0): "85_180",
        (-90.0, -180.0): "-90_-180",
    }
    df = flights.add_features(
        events(spark, *[{"latitude": a, "longitude": o} for a, o in places])
    )
    assert {(r["latitude"], r["longitude"]): r["geo_region"] for r in df.collect()} == places


def test_capacity_classes(spark):
    kinds = {
        "large_airport": 120,
        "medium_airport": 80,
        "small_airport": 50,
        "closed": 30,
        None: 30,
    }
    near = airports(spark, *[(50.5, 10.5, str(kind), kind) for kind in kinds])
    rows = enrich(events(spark, {"velocity": 100.0}), near).collect()
    assert {r["type"]: r["base_capacity"] for r in rows} == kinds
    assert all(r["effective_capacity"] == r["base_capacity"] for r in rows)


def test_speed_factor_limits(spark):
    far = airports(spark, (0.0, 0.0, "XX", "heliport"))
    df = prepare(events(spark, {}))
    for speed, factor in [(199.9, 0.9), (200.0, 1.0), (850.0, 1.0), (850.1, 0.7)]:
        rows = flights.add_capacity(
            df.withColumn("speed_kmh", F.lit(speed)).crossJoin(far)
        ).collect()
        assert [r["weather_factor"] for r in rows] == [factor]


def test_region_prefers_the_airport(spark):
    near = airports(spark, (50.5, 10.5, "DE-BY", "heliport"), (50.6, 10.5, None, "heliport"))
    rows = enrich(events(spark, {}), near)
    assert sorted(column(rows, "region")) == ["50_10", "DE-BY"]


def test_event_time_is_the_epoch(spark):
    rows = enrich(events(spark, {}), airports(spark)).select(F.unix_seconds("event_time").alias("s"))
    assert column(rows, "s") == [1_700_000_000]


def test_project_available_keeps_listed_order(spark):
    df = events(spark, {})
    assert flights.project_available(df, ["velocity", "nope", "icao24"]).columns == [
        "velocity",
        "icao24",
    ]


def aircraft(spark, n, **field):
    rows = [{"icao24": f"p{i}"} | field for i in range(n)]
    return enrich(events(spark, *rows), airports(spark))


def test_learning_needs_more_than_ten_aircraft(spark):
    assert learning.ml_input(aircraft(spark, 10)).count() == 0
    assert learning.ml_input(aircraft(spark, 11)).count() == 11
    many_rows = aircraft(spark, 10).crossJoin(spark.range(100))
    assert not learning.enough_rows(many_rows)


def test_learning_counts_complete_rows_only(spark):
    assert not learning.enough_rows(aircraft(spark, 11, vertical_rate=None))


def test_one_row_per_aircraft_is_the_newest(spark):
    rows = enrich(
        events(spark, {"altitude": 1.0}, {"timestamp": 1_700_000_001, "altitude": 2.0}),
        airports(spark, (50.5, 10.5, "B", None), (50.5, 10.5, "A", None)),
    )
    picked = learning.aircraft_rows(rows).collect()
    assert [(r["altitude"], r["region"]) for r in picked] == [(2.0, "A")]


def test_choosing_before_the_join_gives_the_same_rows(spark):
    flown = [
        {"icao24": f"p{i % 40}", "timestamp": i % 3, "latitude": 50.0 + i % 7 / 5, "altitude": 1.0 + i % 11}
        for i in range(400)
    ] + [{"icao24": "p1", "timestamp": 9, "vertical_rate": None}]
    near = airports(spark, (50.2, 10.5, "B", None), (51.1, 10.5, "A", None), (50.9, 10.0, None, None))
    df = events(spark, *flown)
    late, early = learning.ml_input(enrich(df, near)), ml_aircraft(df, near)
    assert sorted(early.collect()) == sorted(late.collect()) and early.count() == 40
    assert ml_aircraft(df, near, min_rows=40).count() == 0


def test_infinite_numbers_are_invalid(spark):
    rows = [{"velocity": math.inf}, {"altitude": math.inf}, {"velocity": math.nan}, {"vertical_rate": math.inf}]
    kept = flights.clean_flights(events(spark, *rows))
    assert column(kept, "vertical_rate") == [math.inf]
    assert flights.clean_flights(events(spark, *rows), drop_nan=False).count() == 4
    assert learning.newest_flights(prepare(events(spark, *rows))).count() == 0


def test_callsign_white_space(spark):
    spaces = "\u00a0\u2003\x1c\x1f\t\x85 \u3000"
    df = spark.createDataFrame([(f"{spaces}AB 1{spaces}",), (spaces,), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(callsign(F.col("c"))).collect()] == ["AB 1", "", None, None]

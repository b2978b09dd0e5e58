import random
from dataclasses import replace

import pytest
from helpers import airports, column, events
from pyspark.sql import functions as F

from skylattice.operators import proximity, traffic
from skylattice.plans.enrich import at_airports, counted_at_airports, prepare


def nested_loop(flights, near, radius):
    band = (F.abs(F.col("latitude") - F.col("ap_lat")) < radius) & (
        F.abs(F.col("longitude") - F.col("ap_lon")) < radius
    )
    return flights.join(F.broadcast(near), band, "left")


def same_rows(a, b):
    return a.exceptAll(b.select(a.columns)).isEmpty() and b.select(a.columns).exceptAll(a).isEmpty()


def positions(rng, radius, n):
    """Random points, and points on cell edges and exactly one radius apart."""
    spread = [(rng.uniform(-89, 89), rng.uniform(-179, 179)) for _ in range(n)]
    edges = [(rng.randint(-8, 8) * radius, rng.randint(-8, 8) * radius) for _ in range(n)]
    hairs = [(a + rng.choice([-1e-12, 1e-12, radius]), o - radius) for a, o in edges]
    return spread + edges + hairs


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("radius", [1.0, 0.1, 2.5])
def test_equals_the_band_join(spark, radius, small):
    rng = random.Random(radius)
    flown = [{"latitude": a, "longitude": o} for a, o in positions(rng, radius, 60)]
    flights = events(spark, *flown)
    near = airports(spark, *[(a, o, "R", None) for a, o in positions(rng, radius, 60)])
    joined = proximity.airport_join(flights, near, radius=radius, small=small)
    expected = nested_loop(flights, near, radius)
    assert expected.where("ap_lat is not null").count() > 60
    assert same_rows(joined, expected)


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("most", [proximity.MAX_PACKED, 0])
def test_flights_meet_the_airports_of_a_cell_as_one_row(spark, monkeypatch, small, most):
    monkeypatch.setattr(proximity, "MAX_PACKED", most)
    rng = random.Random(5)
    spots = [(50 + rng.uniform(-2, 2), 10 + rng.uniform(-2, 2), rng.choice(["R", None]), None) for _ in range(300)]
    near = airports(spark, *spots)
    flights = events(spark, *[{"latitude": 50 + i / 9, "longitude": 10 - i / 9} for i in range(40)], {"latitude": None})
    joined = proximity.airport_join(flights, near, small=small)
    assert same_rows(joined, nested_loop(flights, near, 1.0))
    assert joined.count() > 500
    # The pairs are listed after the join, which then has a row per flight.
    assert ("explode(_near" in executed_plan(joined)) == bool(most)
    assert proximity.packed_cells(near).count() < 70 < proximity.airport_cells(near).count()


def matches(spark, flight, *near):
    joined = proximity.airport_join(events(spark, flight), airports(spark, *near))
    return [(r["ap_lat"], r["ap_lon"]) for r in joined.collect()]


def test_distance_is_strict_and_fans_out(spark):
    flight = {"latitude": 50.0, "longitude": 10.0}
    inside = [(50.999, 10.999, "A", None), (49.5, 9.5, "B", None)]
    assert len(matches(spark, flight, *inside)) == 2
    assert matches(spark, flight, (51.0, 10.0, "A", None)) == [(None, None)]


def test_no_wrap_at_the_date_line(spark):
    flight = {"latitude": 0.5, "longitude": 179.9}
    assert matches(spark, flight, (0.5, -179.9, "A", None)) == [(None, None)]


def test_airport_without_position_never_matches(spark):
    flight = {"latitude": 50.0, "longitude": 10.0}
    assert matches(spark, flight, (None, 10.0, "A", None)) == [(None, None)]


def test_copies_of_an_airport_all_match(spark):
    flight = {"latitude": 50.0, "longitude": 10.0}
    assert len(matches(spark, flight, *[(50.1, 10.1, "A", None)] * 3)) == 3


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_airports_are_broadcast_and_large_ones_are_not(spark):
    flights, near = events(spark, {}), airports(spark, (50.0, 10.0, "A", "heliport"))
    assert proximity.fits_broadcast(near)
    assert not proximity.fits_broadcast(near, limit=100)
    small = executed_plan(proximity.airport_join(flights, near, small=True))
    large = executed_plan(proximity.airport_join(flights, near, small=False))
    assert "BroadcastHashJoin" in small and "NestedLoop" not in small
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_measured_size_counts_rows_and_text(spark):
    assert proximity.replicated_bytes(airports(spark)) == 0
    one = proximity.replicated_bytes(airports(spark, (50.0, 10.0, "A" * 100, None)))
    assert one > 9 * 100


def test_hot_cell_is_split_in_the_shuffled_join(spark):
    """A third of all flights at one place, and most of the bytes."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        hot = F.col("id") % 3 == 0
        flights = spark.range(0, 60_000, numPartitions=16).select(
            F.when(hot, F.sha2(F.col("id").cast("string"), 256)).alias("icao24"),
            F.when(hot, 50.2).otherwise(F.col("id") % 120 - 60).alias("latitude"),
            F.when(hot, 10.2).otherwise(F.col("id") % 310 - 155).alias("longitude"),
        )
        near = airports(spark, (50.0, 10.0, "A", None), (10.0, 20.0, "B", None))
        joined = proximity.airport_join(flights, near, small=False)
        counted = joined.groupBy("iso_region").agg(F.count("icao24"))
        got = {r[0]: r[1] for r in counted.collect()}
        plan = counted._jdf.queryExecution().executedPlan().toString()
        want = nested_loop(flights, near, 1.0).groupBy("iso_region").agg(F.count("icao24"))
        assert "skew" in plan
        assert got == {r[0]: r[1] for r in want.collect()}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_unusable_airport_positions_are_near_nothing(spark):
    rows = [(99_999_999_999.0, 10.0, "A", "x"), (float("inf"), 10.0, "B", "x"), (float("nan"), 10.0, "C", "x")]
    rows += [(1e300, 10.0, "D", "x"), (50.4, 10.4, "E", "x")]
    near = proximity.airport_join(events(spark, {}), airports(spark, *rows), small=True)
    assert column(near, "iso_region") == ["E"]


def test_every_column_counts_for_the_broadcast(spark):
    wide = airports(spark, (50.0, 10.0, "A", "x")).withColumn("note", F.repeat(F.lit("z"), 100_000))
    nested = airports(spark, (50.0, 10.0, "A", "x")).withColumn("note", F.array(F.repeat(F.lit("z"), 100_000)))
    assert min(map(proximity.replicated_bytes, (wide, nested))) > 900_000


def summed(rows):
    """Totals by region of enriched or counted rows."""
    totals = traffic.traffic_totals(rows, ["region", "country"])
    numbers = [F.round(c, 6).alias(c) for c in ("rows", "speed", "altitude", "levels", "capacity", "score_tenths", "scored")]
    return totals.select("region", "country", *numbers)


@pytest.mark.parametrize("parts, small, radius", [(1, True, 1.0), (2, False, 2.5), (3, True, 0.1), (4, False, 1.0), (6, True, 2.5), (9, True, 1.0)])
def test_counted_rows_give_the_sums_of_all_pairs(spark, parts, small, radius):
    rng = random.Random(parts)
    kinds = ["large_airport", "medium_airport", "heliport", None]
    flown = [
        {"latitude": a, "longitude": o, "icao24": rng.choice(["a", "b", None]), "country": rng.choice(["X", "Y", None])}
        for a, o in positions(rng, radius, 60)
    ]
    flights = prepare(events(spark, *flown))
    dense = [(rng.uniform(-2, 2) * radius, rng.uniform(-2, 2) * radius) for _ in range(100)]
    spots = positions(rng, radius, 60) + dense
    near = airports(spark, *[(a, o, rng.choice(["R", "S", None]), rng.choice(kinds)) for a, o in spots])
    cells = replace(proximity.counted_cells(near, radius=radius, parts=parts), small=small)
    counted = counted_at_airports(flights, cells).localCheckpoint()
    pairs = at_airports(flights, near, radius=radius).localCheckpoint()
    assert counted.agg(F.sum("airports")).first()[0] == pairs.count() > 150
    assert same_rows(summed(counted), summed(pairs))


def test_rows_of_sums_do_not_grow_with_the_airports(spark):
    rng = random.Random(3)
    spots = [(50 + rng.uniform(-1, 1), 10 + rng.uniform(-1, 1), "R", None) for _ in range(3000)]
    near = airports(spark, *spots)
    flights = prepare(events(spark, {"latitude": 50.0, "longitude": 10.0}))
    counted = counted_at_airports(flights, proximity.counted_cells(near)).localCheckpoint()
    assert counted.agg(F.sum("airports")).first()[0] == 3000
    assert counted.count() < 600


def test_no_airports_and_no_flights(spark):
    none = airports(spark)
    alone = counted_at_airports(prepare(events(spark, {})), proximity.counted_cells(none)).collect()
    assert [(r["airports"], r["base_capacity"], r["region"]) for r in alone] == [(1, 30, "50_10")]
    nobody = prepare(events(spark, {}).limit(0))
    assert counted_at_airports(nobody, proximity.counted_cells(none, parts=3)).count() == 0


def test_flights_compared_in_their_tasks_give_the_same_sums(spark, monkeypatch):
    rng = random.Random(11)
    kinds = ["large_airport", "medium_airport", "heliport", None]
    dense = [(50 + rng.uniform(-2, 2), 10 + rng.uniform(-2, 2)) for _ in range(300)]
    spots = dense + positions(rng, 1.0, 40) + [(float("nan"), 10.0), (1e300, 10.0), (None, 10.0)]
    near = airports(spark, *[(a, o, rng.choice(["R", "S", None]), rng.choice(kinds)) for a, o in spots])
    flown = [(a + rng.choice([-1, 0, 1]), o + rng.choice([-1, 0, 1])) for a, o in dense] + positions(rng, 1.0, 60)
    flights = prepare(events(spark, *[{"latitude": a, "longitude": o, "country": rng.choice(["X", None])} for a, o in flown]))
    joined = proximity.counted_cells(near, parts=1)
    monkeypatch.setattr(proximity, "DENSE", 0)
    beside = proximity.counted_cells(near)
    assert joined.spots is None and beside.spots is not None and proximity.stored_cells(beside) is beside
    # No cells are joined, and no flight is moved before its sums.
    counted = counted_at_airports(flights.repartition(3), beside)
    plan = executed_plan(counted)
    assert "Join" not in plan and counted.columns == counted_at_airports(flights, joined).columns
    assert same_rows(summed(counted), summed(counted_at_airports(flights, joined)))
    assert counted.agg(F.sum("airports")).first()[0] == at_airports(flights, near).count() > 1000
    moved = events(spark, {"latitude": None}, {"latitude": float("nan")}, {"latitude": 1e300}, {})
    alone = proximity.counted_join(moved, beside)
    assert alone.where("iso_region is null and airports = 1 and base_capacity = 30").count() >= 3
    assert same_rows(
        alone.groupBy("latitude", "iso_region").agg(F.sum("airports"), F.sum("base_capacity")),
        proximity.counted_join(moved, joined).groupBy("latitude", "iso_region").agg(F.sum("airports"), F.sum("base_capacity")),
    )

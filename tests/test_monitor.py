import pytest
from helpers import column
from pyspark.sql import functions as F

from skylattice.operators import pick
from skylattice.plans import monitor
from skylattice.schemas import TABLES


def stored(spark, table, *rows, with_batch=False):
    names = TABLES[table].names + (["batch_id"] if with_batch else [])
    schema = ", ".join(
        f"{f.name} {'bigint' if f.name == 'timestamp' else f.dataType.simpleString()}"
        for f in TABLES[table]
    )
    schema += ", batch_id bigint" if with_batch else ""
    df = spark.createDataFrame([[r.get(n) for n in names] for r in rows], schema)
    return df.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def flights(spark, *rows):
    return stored(spark, "flight_events", *rows)


def test_latest_prefers_time_then_batch(spark):
    rows = [
        {"region": "a", "aci": 1.0, "timestamp": 5, "batch_id": 1},
        {"region": "a", "aci": 2.0, "timestamp": 9, "batch_id": 2},
        {"region": "a", "aci": 3.0, "timestamp": 9, "batch_id": 3},
        {"region": "b", "aci": 4.0, "timestamp": 1, "batch_id": 1},
    ]
    newest = pick.latest(stored(spark, "region_metrics", *rows, with_batch=True), "region")
    assert sorted(column(newest, "aci")) == [3.0, 4.0]


def test_upsert_keeps_the_last_write_per_key(spark):
    rows = [
        {"icao24": "a", "timestamp": 1, "altitude": 1.0, "batch_id": 1},
        {"icao24": "a", "timestamp": 1, "altitude": 2.0, "batch_id": 2},
        {"icao24": "a", "timestamp": 2, "altitude": 3.0, "batch_id": 1},
        {"icao24": None, "timestamp": 2, "altitude": 4.0, "batch_id": 1},
        {"icao24": "a", "timestamp": None, "altitude": 5.0, "batch_id": 1},
    ]
    view = pick.upsert_view(stored(spark, "flight_events", *rows, with_batch=True))
    assert sorted(column(view, "altitude")) == [2.0, 3.0]


def test_one_row_per_key_is_chosen_before_the_shuffle(spark):
    """A key with a third of all rows sends one row per task, not all of them."""
    df = spark.range(9000, numPartitions=4).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) AS k", "id"
    )
    picked = pick.one_per_key(df, ["k"], [F.col("id").desc()])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert picked.where("k = 'hot'").first()["id"] == 8997
    assert picked.count() == 6001


def test_top_ignores_missing_numbers_and_breaks_ties_by_name(spark):
    df = spark.createDataFrame(
        [("d", 1.0), ("c", 2.0), ("b", 2.0), ("a", float("nan")), ("e", None)], "k string, v double"
    )
    assert column(pick.top(df, "v", 10, tie="k"), "k") == ["b", "c", "d"]
    assert column(pick.top(df, "v", 1, tie="k"), "k") == ["b"]


def test_scan_returns_the_newest_rows(spark):
    rows = [{"icao24": f"p{i}", "timestamp": i} for i in range(5)]
    found = monitor.scan(flights(spark, *rows), "flight_events", 2)
    assert column(found, "icao24") == ["p4", "p3"]
    assert monitor.scan(flights(spark, *rows), "flight_events").count() == 5


def test_kpis(spark):
    events = flights(
        spark,
        {"country": "X", "altitude": 1.0, "timestamp": 1},
        {"country": "X", "altitude": 4.0, "timestamp": 1},
        {"country": "Y", "timestamp": 1},
        {"country": None, "timestamp": 1},
    )
    regions = stored(spark, "region_metrics", {"aci": 0.8}, {"aci": 0.81}, {"aci": 2.0}, {"aci": None})
    logs = stored(spark, "anomaly_logs", {"icao24": "a"}, {"icao24": "a"})
    assert monitor.kpis(events, regions, logs).first().asDict() == {
        "total_flights": 4,
        "total_countries": 2,
        "avg_altitude": 2.0,  # 2.5 rounds to even
        "total_anomalies": 2,
        "congested_regions": 2,
    }


def test_kpis_of_empty_tables(spark):
    empty = [stored(spark, t) for t in ("flight_events", "region_metrics", "anomaly_logs")]
    assert set(monitor.kpis(*empty).first()) == {0, 0.0}


def test_map_points(spark):
    df = flights(
        spark,
        {"latitude": 1.0, "longitude": 2.0, "altitude": 1999.9},
        {"latitude": None, "longitude": 2.0},
        {"latitude": 1.0, "longitude": None},
    )
    points = monitor.map_points(df)
    assert column(points, "band") == ["LOW"]
    assert points.columns == monitor.MAP_COLUMNS


def histogram(spark, *altitudes, bins=4):
    df = flights(spark, *[{"altitude": a} for a in altitudes])
    rows = monitor.altitude_histogram(df, bins=bins).orderBy("bin").collect()
    return [(r["bin_start"], r["flights"]) for r in rows]


def test_histogram_covers_the_range(spark):
    assert histogram(spark, 0.0, 9.9, 10.0, 39.0, 40.0, None) == [
        (0.0, 2),
        (10.0, 1),
        (20.0, 0),
        (30.0, 2),
    ]


def test_histogram_of_one_value_and_of_nothing(spark):
    assert [n for _, n in histogram(spark, 5.0, 5.0)] == [2, 0, 0, 0]
    assert histogram(spark, None) == []


def test_speed_summary(spark):
    df = flights(spark, *[{"velocity": v} for v in (10.0, 20.0, 30.0, 40.0, None)])
    row = monitor.speed_summary(df).first().asDict()
    assert row == pytest.approx(
        {
            "flights": 4,
            "min_speed": 36.0,
            "q1": 63.0,
            "median": 90.0,
            "q3": 117.0,
            "max_speed": 144.0,
            "mean_speed": 90.0,
        }
    )


def test_status_breakdown_order(spark):
    df = flights(spark, *[{"vertical_rate": v} for v in (6.0, 7.0, None, -6.0, 0.0, 1.0)])
    assert [tuple(r) for r in monitor.status_breakdown(df).collect()] == [
        ("STABLE", 3),
        ("CLIMB", 2),
        ("DESCENT", 1),
    ]


def test_lists_are_newest_first(spark):
    logs = [{"icao24": f"p{i}", "timestamp": i, "reason": "r"} for i in range(20)]
    shown = monitor.anomaly_list(stored(spark, "anomaly_logs", *logs))
    assert column(shown, "icao24") == [f"p{i}" for i in range(19, 11, -1)]
    recent = monitor.recent_events(flights(spark, *[{"icao24": "a", "timestamp": i} for i in range(60)]))
    assert recent.count() == 50 and recent.columns == monitor.EVENT_COLUMNS

import pytest
from helpers import column, metrics
from pyspark.sql import functions as F

from skylattice.operators import alerts, balance, traffic

TIERS = [("a", 1, 0.4), ("b", 1, 0.8), ("c", 1, 0.81), ("d", 1, 1.2), ("e", 9, 1.21)]


def test_congestion_tiers_are_strict(spark):
    found = alerts.congestion_alerts(metrics(spark, *TIERS))
    assert {r["region"]: r["level"] for r in found.collect()} == {
        "c": "MEDIUM",
        "d": "MEDIUM",
        "e": "HIGH",
    }
    assert found.columns == ["type", "level", "region", "message"]


def test_congestion_message(spark):
    found = alerts.congestion_alerts(metrics(spark, ("30_0", 27, 1.125)))
    assert column(found, "message") == ["MEDIUM CONGESTION in 30_0: ACI=1.12, 27 aircraft"]


def test_alert_table(spark):
    table = alerts.alert_table(metrics(spark, *TIERS))
    assert {r["region"]: r["alert_type"] for r in table.collect()} == {
        "c": "MEDIUM_CONGESTION",
        "d": "MEDIUM_CONGESTION",
        "e": "HIGH_CONGESTION",
    }


def test_latest_tiers(spark):
    history = spark.createDataFrame(
        [(1, "a", 1.5, 10), (2, "a", 0.9, 20), (1, "b", 1.3, 10), (1, "c", 0.1, 10)]
        + [(2, "d", 1.3, 10), (1, "d", 0.1, 10)],
        "batch_id bigint, region string, aci double, timestamp bigint",
    )
    tiers = {r["region"]: r["tier"] for r in alerts.alert_tiers(history).collect()}
    assert tiers == {"a": "medium", "b": "high", "c": "normal", "d": "high"}


def counts(spark, *rows):
    return spark.createDataFrame(
        list(rows), "batch_id bigint, region string, aircraft_count bigint"
    )


def test_surge_needs_more_than_half(spark):
    now = counts(spark, (2, "a", 15), (2, "b", 16), (2, "new", 99), (2, "less", 1))
    before = counts(spark, (1, "a", 10), (1, "b", 10), (1, "less", 5), (1, "gone", 7))
    surges = alerts.surge_rows(now, before)
    assert [(r["region"], r["change_pct"]) for r in surges.collect()] == [("b", 60.0)]
    assert column(alerts.surge_alerts(surges), "message") == [
        "TRAFFIC SURGE in b: 10 → 16 aircraft (+60%)"
    ]


def test_history_looks_at_the_previous_batch_only(spark):
    history = counts(
        spark,
        *[(1, "a", 10), (1, "b", 10)],
        *[(4, "b", 100)],  # batches 2 and 3 were empty: 1 comes before 4
        *[(5, "a", 100), (5, "b", 100)],  # a was missing from 4
    )
    surges = alerts.surge_history(history).collect()
    assert [(r["batch_id"], r["region"]) for r in surges] == [(4, "b")]


def test_previous_batch_across_blocks(spark):
    ids = [0, 1, 4095, 4096, 4097, 20000, 20001, 90000, *range(10**12, 10**12 + 10**8, 10**6)]
    links = alerts.previous_batches(counts(spark, *[(i, r, 1) for i in ids for r in "ab"]))
    got = {r["batch_id"]: r["previous_batch"] for r in links.collect()}
    assert got == dict(zip(ids, [None, *ids]))


def test_sparse_ids_do_not_meet_in_one_task(spark):
    """Ids far apart fall into few ranges; one range's worth is all that a task orders."""
    history = spark.range(5000).selectExpr(
        "id * 10000000 AS batch_id", "'a' AS region", "1L AS aircraft_count"
    )
    plan = alerts.previous_batches(history)
    assert plan.where("previous_batch = batch_id - 10000000").count() == 4999
    stored = history.sparkSession.read.parquet(plan.inputFiles()[0].rpartition("/")[0])
    ranges = [r["count"] for r in stored.groupBy("block").count().collect()]
    assert len(ranges) == 8 and max(ranges) < 1500


def test_history_reads_its_input_once(spark, tmp_path):
    spark.range(50).selectExpr("id AS batch_id", "'a' AS region", "id AS aircraft_count").write.parquet(
        f"{tmp_path}/counts"
    )
    found = alerts.surge_history(spark.read.parquet(f"{tmp_path}/counts"))
    assert not any("counts" in f.rpartition("/")[0] for f in found.inputFiles())


def test_history_equals_step_by_step(spark):
    steps = [counts(spark, (i, "a", (i * 7) % 11), (i, "b", (i * 5) % 7)) for i in range(1, 12)]
    whole = steps[0]
    for step in steps[1:]:
        whole = whole.unionByName(step)
    got = {(r["batch_id"], r["region"]) for r in alerts.surge_history(whole).collect()}
    want = set()
    for before, now in zip(steps, steps[1:]):
        for r in alerts.surge_rows(now, before).collect():
            want.add((r["batch_id"], r["region"]))
    assert got == want and want


def test_anomaly_alert_once_per_aircraft(spark):
    rows = [("a", 900.25, 999.5, 1.0), ("a", 900.25, 999.5, 2.0), ("b", 1.0, 2.0, -3.25)]
    flagged = spark.createDataFrame(
        rows, "icao24 string, speed_kmh double, altitude double, vertical_rate double"
    )
    assert sorted(column(alerts.anomaly_alerts(flagged), "message")) == [
        "ANOMALY: a — speed=900.2 km/h, alt=1000m, vrate=1.0 m/s",
        "ANOMALY: b — speed=1.0 km/h, alt=2m, vrate=-3.2 m/s",
    ]


def test_all_alerts_keeps_every_row(spark):
    part = alerts.congestion_alerts(metrics(spark, *TIERS))
    assert alerts.all_alerts(part, part, part).count() == 9


def suggestions(spark, *rows):
    found = balance.reroute(metrics(spark, *rows)).orderBy(F.col("aci").desc())
    return column(found, "suggestion")


def test_reroute_names_the_three_lightest(spark):
    rows = [("hot", 1, 1.3), ("warm", 1, 0.9), ("w", 1, 0.39), ("x", 1, 0.2), ("y", 1, 0.1)]
    assert suggestions(spark, *rows, ("z", 1, 0.3), ("edge", 1, 0.4)) == [
        "[HIGH] hot (ACI=1.30) → reroute via: y, x, z",
        "[MEDIUM] warm (ACI=0.90) → reroute via: y, x, z",
    ]


def test_reroute_without_light_regions(spark):
    assert suggestions(spark, ("hot", 1, 1.3), ("edge", 1, 0.4)) == [
        "[HIGH] hot (ACI=1.30) → no light regions available"
    ]


def test_reroute_without_congestion_or_regions(spark):
    assert suggestions(spark, ("a", 1, 0.8), ("b", 1, 0.1)) == [
        "✅ No rerouting needed — all regions within capacity."
    ]
    assert suggestions(spark) == []


def test_load_balance_limits_are_strict(spark):
    rows = [("mean", 1, 1.0), ("low", 1, 0.5), ("high", 1, 1.5), ("over", 1, 1.6), ("under", 1, 0.4)]
    found = balance.load_balance(metrics(spark, *rows))
    assert {r["region"]: r["load_status"] for r in found.collect()} == {
        "mean": "BALANCED",
        "low": "BALANCED",
        "high": "BALANCED",
        "over": "OVERLOADED",
        "under": "UNDERLOADED",
    }
    assert column(balance.overloaded(found), "region") == ["over"]


def test_efficiency_scores(spark):
    rows = [("ideal", 850.0, 10000.0), ("half", 425.0, 5000.0), ("none", 1700.0, 20001.0)]
    rows += [(None, 850.0, 10000.0), ("x", None, 1.0), ("y", 1.0, None), ("nan", float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "icao24 string, speed_kmh double, altitude double")
    scored = {r["icao24"]: r["efficiency_score"] for r in balance.efficiency_score(df).collect()}
    assert scored == {"ideal": 100.0, "half": 50.0, "none": 0.0}


def totals_input(spark):
    rows = [("a", "X", "r1", 850.0, 10000.0, 50.0), ("b", "X", "r2", 425.0, 5000.0, 30.0)]
    rows += [("c", None, "r1", 0.5, 1.0, 30.0), (None, "Y", "r1", 10.0, 300.0, 27.0)]
    return spark.createDataFrame(
        rows,
        "icao24 string, country string, region string, speed_kmh double, altitude double, "
        "effective_capacity double",
    )


def test_roll_up_equals_direct_sums(spark):
    rows = totals_input(spark)
    totals = traffic.traffic_totals(rows, ["region", "country"])
    for key, direct, of in [
        ("region", traffic.region_metrics(rows), traffic.region_metrics_of),
        ("country", traffic.country_metrics(rows), traffic.country_metrics_of),
        ("region", traffic.region_avg_speed(rows), traffic.region_avg_speed_of),
    ]:
        rolled = of(traffic.roll_up(totals, [key]))
        assert sorted(map(tuple, rolled.collect())) == sorted(map(tuple, direct.collect()))


def test_unknown_country_is_dropped_and_rows_are_counted(spark):
    found = {r["country"]: r["total_flights"] for r in traffic.country_metrics(totals_input(spark)).collect()}
    assert found == {"X": 2, "Y": 1}
    regions = {r["region"]: r["aircraft_count"] for r in traffic.region_counts(totals_input(spark)).collect()}
    assert regions == {"r1": 3, "r2": 1}


def test_mean_efficiency_of_scorable_rows(spark):
    from skylattice.operators.balance import mean_efficiency

    row = mean_efficiency(totals_input(spark)).first()
    assert (row["scored"], row["avg_efficiency"]) == (3, 50.0)
    assert row["mean_score"] == pytest.approx((100.0 + 50.0 + 0.0) / 3, abs=0.1)

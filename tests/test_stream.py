import json
import os

import pytest
from helpers import EVENT, airports, column, events
from pyspark.sql import functions as F

from skylattice.operators import traffic
from skylattice.plans.enrich import enrich, prepare
from skylattice.schemas import TABLES
from skylattice.sources.events import read_flight_stream
from skylattice.sources.storage import ResultTables
from skylattice.streaming import pipeline
from workload import queries

NEAR = [(50.4, 10.4, "DE-BY", "heliport"), (50.6, 10.6, "DE-BY", "heliport")]


def batch(n, *, start=0, place=50.5):
    """n aircraft, all but the first on cruise."""
    return [
        {
            "icao24": f"p{start + i}",
            "timestamp": 1_700_000_000 + start + i,
            "latitude": place,
            "velocity": 200.0 + i,
            "altitude": 9000.0 + 10 * i,
        }
        for i in range(n)
    ]


def drop_file(folder, number, rows):
    folder.mkdir(exist_ok=True)
    lines = "\n".join(json.dumps(EVENT | row) for row in rows)
    path = folder / f"{number:03}.txt"
    path.write_text(lines or "not json")
    os.utime(path, (1_700_000_000 + number,) * 2)  # files are read in order of their times


def drain(spark, folder, base, report=None):
    stream = read_flight_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(folder))
    query = pipeline.start(
        stream,
        airports=airports(spark, *NEAR),
        tables=ResultTables(f"{base}/tables"),
        checkpoint=f"{base}/checkpoint",
        trigger={"availableNow": True},
        report=report,
    )
    query.awaitTermination()
    return ResultTables(f"{base}/tables")


def counts(spark, tables):
    rows = tables.read(spark, "region_metrics").collect()
    return {(r["batch_id"], r["region"]): r["aircraft_count"] for r in rows}


@pytest.fixture
def surge_log():
    found = {}

    def report(batch_id, parts):
        messages = parts["alerts"].where("type = 'SURGE'")
        found[batch_id] = sorted(column(messages, "message"))

    report.found = found
    return report


def test_batches_surges_and_restart(spark, tmp_path, surge_log):
    files, base = tmp_path / "in", tmp_path / "out"
    drop_file(files, 0, batch(4))
    drop_file(files, 1, [])  # one unreadable message: an empty batch
    drop_file(files, 2, batch(7, start=10))
    tables = drain(spark, files, base, surge_log)
    # Two airports in reach: every flight counts twice.
    assert counts(spark, tables) == {(0, "DE-BY"): 8, (2, "DE-BY"): 14}
    assert surge_log.found == {
        0: [],
        2: ["TRAFFIC SURGE in DE-BY: 8 → 14 aircraft (+75%)"],
    }
    assert tables.read(spark, "flight_events").count() == 11  # the fan-out is not stored

    drop_file(files, 3, batch(12, start=30) + batch(1, start=60, place=20.5))
    tables = drain(spark, files, base, surge_log)  # restart from the checkpoint
    assert counts(spark, tables)[(3, "DE-BY")] == 24
    assert surge_log.found[3] == ["TRAFFIC SURGE in DE-BY: 14 → 24 aircraft (+71%)"]
    assert set(column(tables.read(spark, "anomaly_logs"), "batch_id")) == {3}


def process(spark, tables, rows, batch_id, report=None):
    flights = prepare(events(spark, *rows))
    pipeline.process_batch(
        flights, batch_id, airports=airports(spark, *NEAR), tables=tables, report=report
    )


def contents(spark, tables):
    return {
        name: sorted(map(repr, tables.read(spark, name).drop("timestamp").collect()))
        for name in TABLES
    }


def test_replayed_batch_leaves_the_tables_unchanged(spark, tmp_path, surge_log):
    tables = ResultTables(str(tmp_path))
    process(spark, tables, batch(4), 0)
    process(spark, tables, batch(15), 1, surge_log)
    first, surges = contents(spark, tables), dict(surge_log.found)
    process(spark, tables, batch(15), 1, surge_log)
    assert contents(spark, tables) == first
    assert surge_log.found == surges and surges[1]
    assert all(first.values())


def test_empty_batch_writes_nothing(spark, tmp_path):
    tables = ResultTables(str(tmp_path))
    process(spark, tables, batch(3), 0)
    process(spark, tables, [{"altitude": 0.0}], 1)
    assert tables.batch_before(spark, "region_metrics", 9) == 0
    process(spark, tables, batch(12), 5)
    assert pipeline.previous_counts(spark, tables, 5).first()["aircraft_count"] == 6


def test_tables_equal_the_batch_operators(spark, tmp_path):
    tables = ResultTables(str(tmp_path))
    rows = batch(9) + batch(5, start=40, place=-3.0) + [{"country": None, "icao24": "q"}]
    process(spark, tables, rows, 0)
    enriched = enrich(events(spark, *rows), airports(spark, *NEAR))
    for name, expected in [
        ("region_metrics", traffic.region_metrics(enriched)),
        ("country_metrics", traffic.country_metrics(enriched)),
    ]:
        got = tables.read(spark, name).select(expected.columns)
        assert sorted(got.collect()) == sorted(expected.collect())


def test_report_summaries(spark, tmp_path):
    seen = {}

    def report(batch_id, parts):
        seen.update({name: df.collect() for name, df in parts.items()})

    process(spark, ResultTables(str(tmp_path)), batch(20), 0, report)
    assert seen["records"][0]["records"] == 40
    assert [tuple(r) for r in seen["top_regions"]] == [("DE-BY", 40)]
    assert sum(r["aircraft"] for r in seen["cluster_sizes"]) == 20
    assert len(seen["anomalies"]) == 1
    assert {r["type"] for r in seen["alerts"]} == {"CONGESTION", "ANOMALY"}
    assert set(seen) == {
        "records",
        "top_regions",
        "avg_speed",
        "efficiency",
        "reroute",
        "overloaded",
        "cluster_sizes",
        "top_forecasts",
        "anomalies",
        "alerts",
    }


def test_stored_times_are_utc_seconds(spark, tmp_path):
    tables = ResultTables(str(tmp_path))
    process(spark, tables, batch(1), 0)
    stored = tables.read(spark, "flight_events").select(F.unix_seconds("timestamp").alias("s"))
    assert column(stored, "s") == [1_700_000_000]


def test_bad_numbers_do_not_stop_the_stream(spark, tmp_path, surge_log):
    files, base = tmp_path / "in", tmp_path / "out"
    text = json.dumps(EVENT | {"velocity": 1.5}).replace("1.5", "Infinity")
    wild = json.dumps(EVENT | {"icao24": "w", "vertical_rate": 1.5}).replace("1.5", "Infinity")
    drop_file(files, 0, batch(12))
    with open(next(files.iterdir()), "a") as out:
        out.write("\n" + text + "\n" + wild + "\n")
    drop_file(files, 1, batch(13, start=20))
    tables = drain(spark, files, base, surge_log)
    assert set(counts(spark, tables)) == {(0, "DE-BY"), (1, "DE-BY")}
    assert tables.read(spark, "flight_events").where("velocity = double('Infinity')").count() == 0


def test_multi_batch_queries_learn_as_the_job_does(spark, small_sf):
    """Every stored batch with rows enough has its anomalies, the replayed ones once."""
    stored, numbers = queries._run_batches(spark, small_sf)
    logs = stored.read(spark, "anomaly_logs")
    found, filled = (set(column(df, "batch_id")) for df in (logs, stored.read(spark, "region_metrics")))
    assert found == filled and len(found) >= 3 and numbers[1] not in found
    assert logs.count() == logs.dropDuplicates(["batch_id", "icao24"]).count()


def test_batches_of_events_in_order_of_time_run_in_many_tasks(spark, tmp_path, monkeypatch):
    """The events of a day or so in one file each, so that a batch lies in a few of them."""
    spark.range(0, 6000, numPartitions=12).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + floor(id * 172.8)) AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "double(id % 90 + 1) AS value", "'{}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    spark.range(20).selectExpr("id AS s_suppkey", "'s' AS s_name", "int(id) AS s_nationkey", "0D AS s_acctbal").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    parts = {}

    def noted(rows, batch_id, **_):
        parts[batch_id] = rows.groupBy(F.spark_partition_id()).count().count()

    monkeypatch.setattr(queries.pipeline, "process_batch", noted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        queries._batch_run(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        queries._runs.pop((spark.sparkContext.applicationId, str(tmp_path)))
    filled = [n for n in parts.values() if n]
    assert len(filled) >= 3 and min(filled) == 8

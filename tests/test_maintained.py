import pytest
from helpers import airports, column, events
from pyspark.sql import functions as F

from skylattice.plans import monitor
from skylattice.plans.enrich import prepare
from skylattice.schemas import TABLES
from skylattice.sources.maintained import MaintainedTables
from skylattice.streaming import pipeline

NEAR = [(50.4, 10.4, "DE-BY", "heliport"), (50.6, 10.6, "DE-BY", "heliport")]
DAY = 86400
START = 1_700_006_400  # a midnight


def flight(name, at, **changes):
    return {"icao24": name, "timestamp": START + at, "velocity": 200.0, "altitude": 9000.0} | changes


def process(spark, tables, rows, batch_id):
    pipeline.process_batch(
        prepare(events(spark, *rows)), batch_id, airports=airports(spark, *NEAR), tables=tables
    )


def put(spark, tables, rows, batch_id):
    """A batch without the job: its events, and metrics and a log derived from them plainly."""
    flights = events(spark, *rows).coalesce(1)
    now = F.timestamp_seconds(F.lit(START + 100 * batch_id))
    number = F.lit(float(batch_id))
    metrics = flights.groupBy(F.col("country").alias("region")).agg(F.count("*").alias("aircraft_count"))
    country = flights.groupBy("country").agg(F.count("*").alias("total_flights"), F.avg("altitude").alias("avg_altitude"))
    log = flights.where("icao24 = 'p1'").selectExpr("icao24", "velocity * 3.6 AS speed_kmh", "altitude", "vertical_rate")
    with tables.batch(spark, batch_id) as out:
        if out.write("flight_events", pipeline.event_rows(flights)):
            out.write("region_metrics", metrics.select("*", number.alias("capacity"), (number / 2).alias("aci"), now.alias("timestamp")))
            out.write("country_metrics", country.select("*", number.alias("traffic_density"), now.alias("timestamp")))
            out.write("anomaly_logs", log.select("*", number.alias("anomaly_score"), now.alias("timestamp"), F.lit("r").alias("reason")))


def rows_of(df, *drop):
    return sorted(map(repr, df.drop(*drop).collect()))


def everything(spark, tables):
    return {
        name: rows_of(tables.current(spark, name).select("batch_id", *TABLES[name].names), "timestamp")
        for name in TABLES
        if name != "alerts"
    }


def days(n, *, rewrite=True):
    """Batches of a day each, the first with rows enough to learn; every other one also rewrites a flight of the first."""
    out = []
    for b in range(n):
        rows = [flight(f"p{i}", b * DAY + i, altitude=5000.0 + 100 * b + i, country=f"c{i % 3}") for i in range(9 if b else 14)]
        if rewrite and b % 2:
            rows.append(flight("p3", 3, altitude=100.0 * b, country="late"))
        out.append(rows)
    return out


def expected_current(batches):
    kept = {}
    for b, rows in enumerate(batches):
        for r in rows:
            kept[r["icao24"], r["timestamp"]] = (b, r["altitude"], r["country"])
    return kept


def current(spark, tables):
    rows = tables.current(spark, "flight_events").withColumn("s", F.unix_seconds("timestamp")).collect()
    assert len({(r["icao24"], r["s"]) for r in rows}) == len(rows)
    return {(r["icao24"], r["s"]): (r["batch_id"], r["altitude"], r["country"]) for r in rows}


def assert_kpis(spark, tables):
    """From totals and commits, as from the tables themselves."""
    read = lambda name: tables.read(spark, name)
    want = monitor.kpis(tables.current(spark, "flight_events"), read("region_metrics"), read("anomaly_logs"))
    assert tables.kpis(spark).select(want.columns).collect() == want.collect()


def test_views_before_and_after_compaction(spark, tmp_path):
    tables = MaintainedTables(str(tmp_path))
    batches = days(5)
    for b, rows in enumerate(batches):
        put(spark, tables, rows, b)
    before = everything(spark, tables)
    assert current(spark, tables) == expected_current(batches)
    assert_kpis(spark, tables)
    newest = rows_of(tables.newest_per_key(spark, "country_metrics"), "timestamp")

    assert tables.compact(spark)
    assert sorted(tables.state(spark).commits) == [3, 4]  # what a restart may replay stays outside
    assert everything(spark, tables) == before
    assert current(spark, tables) == expected_current(batches)
    assert_kpis(spark, tables)
    assert rows_of(tables.newest_per_key(spark, "country_metrics"), "timestamp") == newest
    assert not tables.compact(spark)

    put(spark, tables, batches[4], 4)  # the newest batch again
    put(spark, tables, batches[0], 0)  # one that the base holds already
    assert everything(spark, tables) == before
    assert_kpis(spark, tables)

    tables.compact(spark, keep=0)
    assert not tables.state(spark).commits
    assert everything(spark, tables) == before
    assert_kpis(spark, tables)
    assert rows_of(tables.newest_per_key(spark, "country_metrics"), "timestamp") == newest
    assert tables.vacuum(spark) > 0
    assert everything(spark, tables) == before and tables.vacuum(spark) == 0
    assert_kpis(spark, tables)


@pytest.mark.parametrize("crashing", ["country_metrics", "region_metrics"])
def test_half_a_batch_is_never_seen(spark, tmp_path, monkeypatch, crashing):
    tables = MaintainedTables(str(tmp_path))
    first, second = days(2)
    process(spark, tables, first, 0)
    seen = everything(spark, tables)
    written = type(tables.batch(spark, 1).__enter__()).write

    def fail(self, name, df):
        if name == crashing:
            raise OSError("lost")
        return written(self, name, df)

    with monkeypatch.context() as broken:
        broken.setattr("skylattice.sources.maintained._Batch.write", fail)
        with pytest.raises(OSError):
            process(spark, tables, second, 1)
    assert everything(spark, tables) == seen
    assert_kpis(spark, tables)
    assert pipeline.previous_counts(spark, tables, 2).first()["aircraft_count"] == 28

    process(spark, tables, second, 1)
    assert len(tables._names(spark, tables.COMMITS)) == 2
    assert current(spark, tables) == expected_current([first, second])
    assert_kpis(spark, tables)


def test_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    tables = MaintainedTables(str(tmp_path))
    for b, rows in enumerate(days(4)):
        put(spark, tables, rows, b)
    seen = everything(spark, tables)
    for step in ("_put", "_forget"):
        with monkeypatch.context() as broken:
            broken.setattr(MaintainedTables, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                tables.compact(spark)
        assert everything(spark, tables) == seen
        assert_kpis(spark, tables)
    # The base is there, its commits were not deleted: they are ignored, and go with the next one.
    assert tables.state(spark).upto == 1 and len(tables._names(spark, tables.COMMITS)) == 4
    put(spark, tables, days(5)[4], 4)
    tables.compact(spark)
    assert len(tables._names(spark, tables.COMMITS)) == 2
    assert current(spark, tables) == expected_current(days(5))


def test_newest_rows_open_few_files(spark, tmp_path):
    tables = MaintainedTables(str(tmp_path))
    batches = days(6, rewrite=False)
    for b, rows in enumerate(batches):
        put(spark, tables, rows, b)
    for n in (5, 9, 12):
        got = monitor.scan_stored(spark, tables, "flight_events", n)
        files = got.inputFiles()
        assert {f.split("batch_id=")[1][0] for f in files} == ({"5"} if n <= 9 else {"4", "5"})
        want = monitor.scan(tables.current(spark, "flight_events"), "flight_events", n)
        assert got.select(want.columns).collect() == want.collect()
    tables.compact(spark, keep=1)
    got = monitor.scan_stored(spark, tables, "flight_events", 12)
    assert {f.rsplit("/", 2)[1].split("=")[0] for f in got.inputFiles()} == {"attempt", "day"}
    assert len(got.inputFiles()) == 2 and got.count() == 12
    assert monitor.scan_stored(spark, tables, "flight_events", 1000).count() == 59
    assert monitor.scan_stored(spark, tables, "region_metrics", 3).count() == 3


def test_newest_rows_where_batches_overlap(spark, tmp_path):
    """Rows that a later batch replaces must not count as enough."""
    tables = MaintainedTables(str(tmp_path))
    put(spark, tables, [flight(f"p{i}", i) for i in range(10)], 0)
    for b in (1, 2):
        put(spark, tables, [flight(f"p{i}", 1000 + i, altitude=1000.0 * b) for i in range(5)], b)
    got = monitor.scan_stored(spark, tables, "flight_events", 8).collect()
    assert len(got) == 8 and [r["batch_id"] for r in got] == [2] * 5 + [0] * 3


def test_compaction_rewrites_touched_days_only(spark, tmp_path):
    tables = MaintainedTables(str(tmp_path))
    for b, rows in enumerate(days(3, rewrite=False)):
        put(spark, tables, rows, b)
    tables.compact(spark, keep=0)
    before = {p.oldest: p.path for p in tables.state(spark).days["flight_events"]}
    put(spark, tables, [flight("new", DAY + 5)], 7)
    tables.compact(spark, keep=0)
    after = {p.oldest: p.path for p in tables.state(spark).days["flight_events"]}
    changed = [t for t in before if after[t] != before[t]]
    assert changed == [(START + DAY) * 1_000_000]
    assert tables.counts(spark, "flight_events")["rows"] == 33


def test_empty_tables_and_empty_batches(spark, tmp_path):
    tables = MaintainedTables(str(tmp_path))
    assert tables.kpis(spark).collect() == [(0, 0, 0.0, 0, 0)]
    assert all(tables.current(spark, name).count() == 0 for name in TABLES)
    assert monitor.scan_stored(spark, tables, "flight_events").count() == 0
    assert tables.newest_per_key(spark, "region_metrics").count() == 0
    assert not tables.compact(spark)
    process(spark, tables, [flight("p", 0, altitude=0.0)], 0)  # no valid flight
    assert not tables.state(spark).commits and tables.batch_before(spark, "region_metrics", 5) is None


def test_totals_of_nulls_and_tallies(spark, tmp_path):
    steep = {"steep": F.col("vertical_rate") > 9}
    tables = MaintainedTables(str(tmp_path), tallies=steep)
    put(spark, tables, [flight("a", 0, country=None, vertical_rate=10.0), flight("b", 0, country="x")], 0)
    put(spark, tables, [flight("a", 0, country="x", vertical_rate=1.0), flight("c", 0, vertical_rate=None)], 1)
    (row,) = tables.kpis(spark).collect()
    assert (row["total_flights"], row["total_countries"], row["steep"]) == (3, 2, 0)
    assert {(r["country"], r["measure"]): int(r["amount"]) for r in tables.totals(spark).where("measure = 'rows'").collect()} == {
        ("x", "rows"): 2, ("X", "rows"): 1,
    }


def test_stream_with_compaction_and_restart(spark, tmp_path):
    from skylattice.sources.events import read_flight_stream
    from test_stream import batch, drop_file

    files, base = tmp_path / "in", tmp_path / "out"
    tables = MaintainedTables(f"{base}/tables")

    def drain():
        stream = read_flight_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=str(files))
        pipeline.start(
            stream,
            airports=airports(spark, *NEAR),
            tables=tables,
            checkpoint=f"{base}/checkpoint",
            trigger={"availableNow": True},
            compact_every=3,
        ).awaitTermination()

    for n in range(4):
        drop_file(files, n, batch(3, start=10 * n))
    drain()
    assert tables.state(spark).upto is not None
    drop_file(files, 4, batch(3, start=40))
    drain()
    assert tables.current(spark, "flight_events").count() == 15
    assert column(tables.read(spark, "region_metrics"), "aircraft_count") == [6] * 5
    assert_kpis(spark, tables)


def test_totals_open_earlier_rows_only_where_times_meet(spark, tmp_path, monkeypatch):
    tables = MaintainedTables(str(tmp_path))
    opened, plain = [], MaintainedTables._current

    def noted(self, *args):
        opened.append(args[1:])
        return plain(self, *args)

    monkeypatch.setattr(MaintainedTables, "_current", noted)
    for b, rows in enumerate(days(2, rewrite=False)):
        put(spark, tables, rows, b)
    assert not opened  # days apart
    put(spark, tables, [flight("p3", 3, altitude=70.0, country="late"), flight("q", DAY)], 2)
    assert len(opened) == 1
    tables.compact(spark, keep=0)
    put(spark, tables, [flight("p4", 4, altitude=90.0)], 3)
    assert len(opened) == 2
    assert_kpis(spark, tables)


def test_learning_runs_in_few_tasks(spark, tmp_path, monkeypatch):
    """One row per aircraft, though the shuffles before have many parts."""
    parts, plain = [], pipeline.isolation_scores

    def noted(newest, **options):
        parts.append(newest.rdd.getNumPartitions())
        return plain(newest, **options)

    monkeypatch.setattr(pipeline, "isolation_scores", noted)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        tables = MaintainedTables(str(tmp_path))
        process(spark, tables, days(1)[0], 0)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert parts == [spark.sparkContext.defaultParallelism]
    assert tables.read(spark, "anomaly_logs").count() == 1

import json
import math
from types import SimpleNamespace

import pytest
from helpers import EVENT, column, events

from skylattice.schemas import FLIGHT_EVENT
from skylattice.sources import storage
from skylattice.sources.airports import read_airports
from skylattice.sources.events import parse_events, publish, read_flight_stream, to_json_value
from skylattice.sources.states import decode_states


def vector(**change):
    full = ["a1", "AB1 ", "X", 1700000000, 1700000001, 10.5, 50.5, 5000.0, False, 200.0]
    full += [90.0, 1.5, None, 5100.0, None, False, 0]
    for at, value in change.items():
        full[int(at[1:])] = value
    return full


def documents(spark, *docs):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in docs]
    return spark.createDataFrame(texts, "value string")


def decoded(spark, *vectors, **options):
    docs = documents(spark, {"time": 1, "states": list(vectors)})
    return [r.asDict() for r in decode_states(docs, **options).collect()]


def test_vector_fields_by_position(spark):
    assert decoded(spark, vector()) == [EVENT | {"vertical_rate": 1.5}]


def test_short_vectors_are_dropped(spark):
    assert len(decoded(spark, vector()[:12])) == 1
    assert decoded(spark, vector()[:11], [], None) == []


@pytest.mark.parametrize(
    "raw, kept", [("  ", ""), ("", None), (None, None), (" AB1 ", "AB1"), ("\tX\n", "X")]
)
def test_callsign(spark, raw, kept):
    assert decoded(spark, vector(_1=raw))[0]["callsign"] == kept


def test_missing_and_zero_positions_are_dropped(spark):
    assert decoded(spark, vector(_5=None), vector(_6=None), vector(_5=0), vector(_6=0.0)) == []


def test_bad_field_becomes_null(spark):
    row = decoded(spark, vector(_3=1700000000.5, _7="high"))[0]
    assert (row["timestamp"], row["altitude"]) == (None, None)


def test_cap_counts_before_dropping(spark):
    rows = [vector(_0="a", _6=0.0), vector(_0="b"), vector(_0="c")]
    assert [r["icao24"] for r in decoded(spark, *rows, max_records=2)] == ["b"]
    assert len(decoded(spark, *rows)) == 2


def test_documents_without_vectors(spark):
    docs = documents(spark, {"time": 1, "states": None}, {"time": 1}, "{oops", "", None)
    assert decode_states(docs).count() == 0


def parsed(spark, *texts):
    rows = parse_events(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    return [r.asDict() for r in rows]


def test_events_round_trip_with_nulls(spark):
    df = events(spark, {}, {"callsign": None, "vertical_rate": None})
    messages = to_json_value(df)
    assert json.loads(column(messages, "value")[1])["callsign"] is None
    assert parse_events(messages).collect() == df.collect()


def test_bytes_are_read_as_text(spark):
    messages = to_json_value(events(spark, {})).selectExpr("cast(value AS binary) AS value")
    assert parse_events(messages).first().asDict() == EVENT


def test_bad_messages_become_null_rows(spark):
    nothing = dict.fromkeys(FLIGHT_EVENT.names)
    assert parsed(spark, "not json", None) == [nothing, nothing]
    partial = parsed(spark, '{"icao24": "a", "timestamp": 1.5, "altitude": "x", "velocity": 2}')[0]
    assert partial == nothing | {"icao24": "a", "velocity": 2.0}


def test_airports_go_by_name_and_bad_numbers_are_null(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text(
        "id,type,name,latitude_deg,longitude_deg,iso_country,iso_region\n"
        "1,heliport,A,40.5,-70.25,US,US-PA\n"
        "2,closed,B,north,10,DE,\n"
    )
    rows = read_airports(spark, str(path)).collect()
    assert [tuple(r) for r in rows] == [
        (40.5, -70.25, "US", "US-PA", "heliport"),
        (None, 10.0, "DE", None, "closed"),
    ]


def test_publish_and_read_a_stream_of_messages(spark, tmp_path):
    folder = str(tmp_path / "messages")
    publish(events(spark, {}, {"icao24": "b"}), "text", path=folder)
    stream = read_flight_stream(spark, "text", path=folder)
    assert stream.isStreaming and stream.schema == FLIGHT_EVENT
    query = stream.writeStream.format("memory").queryName("read_back").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(column(spark.table("read_back"), "icao24")) == ["a1", "b"]


def test_publish_from_a_stream(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    publish(events(spark, {}), "text", path=source)
    writer = publish(read_flight_stream(spark, "text", path=source), "text", path=target)
    query = writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.start().awaitTermination()
    assert parse_events(spark.read.text(target)).first().asDict() == EVENT


# --- storage


def test_materialized_rows_are_read_from_files(spark):
    df = storage.materialize(events(spark, {}, {"altitude": math.pi}))
    assert sorted(column(df, "altitude")) == [math.pi, 5000.0]
    assert df.inputFiles()


def named(folder, master):
    settings = {"spark.checkpoint.dir": folder} if folder else {}
    context = SimpleNamespace(getConf=lambda: settings, master=master)
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_shared_folder_is_the_one_the_session_names(spark):
    assert storage.shared_dir(named("s3a://bucket/folder/", "spark://host:1")) == "s3a://bucket/folder"
    with pytest.raises(ValueError):
        storage.shared_dir(named(None, "spark://host:1"))
    assert storage.shared_dir(spark) == storage.shared_dir(spark)
    local = named(None, "local[2]")
    local.conf["spark.sql.warehouse.dir"] = "/some/warehouse"
    assert storage.shared_dir(local) == "/some/warehouse/_shared"


def test_unshared_local_path_is_refused_off_local(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(storage, "_check_seen_by_all", lambda s, folder: tried.append(folder))
    assert storage.shared_dir(named("hdfs://h/x", "spark://host:1")) == "hdfs://h/x" and not tried
    storage.shared_dir(named("/tmp/x", "spark://host:1"))
    storage.shared_dir(named("file:///tmp/x", "yarn"))
    storage.shared_dir(named("/tmp/x", "local[4]"))
    assert tried == ["/tmp/x", "file:///tmp/x"]


def test_probe_of_the_shared_folder(spark, tmp_path):
    storage._check_seen_by_all(spark, str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_scratch_leaves_nothing_behind(spark):
    with storage.scratch(spark):
        copy = storage.materialize(spark.range(5))
        folder = copy.inputFiles()[0].rpartition("/")[0]
        assert storage.exists(spark, folder) and copy.count() == 5
    assert not storage.exists(spark, folder)


def test_batch_before_does_not_list_the_history(spark, tmp_path, monkeypatch):
    tables = storage.ResultTables(str(tmp_path))
    for batch in range(10_000):
        (tmp_path / "alerts" / f"batch_id={batch}").mkdir(parents=True)
    tables.write("alerts", alert_rows(spark, "a"), 10_000)
    monkeypatch.setattr(storage, "folder_names", None)  # any listing would fail
    assert tables.batch_before(spark, "alerts", 10_001) == 10_000
    assert tables.batch_before(spark, "alerts", 10_000) == 9_999
    tables.write("alerts", alert_rows(spark, "b"), 10_000)  # a replay
    assert tables.batch_before(spark, "alerts", 10_000) == 9_999
    tables.write("alerts", alert_rows(spark, "b"), 10_003)
    assert tables.batch_before(spark, "alerts", 10_003) == 10_000


def test_current_view_replaces_rows_of_equal_key(spark, tmp_path):
    tables = storage.ResultTables(str(tmp_path))
    row = "'a' AS icao24, timestamp_seconds(7) AS timestamp, {alt}D AS altitude, 'c' AS callsign, 'x' AS country, 1D AS latitude, 2D AS longitude, 3D AS velocity, 0D AS vertical_rate"
    for batch, alt in [(1, 500), (2, 900), (3, 700)]:
        tables.write("flight_events", spark.sql("SELECT " + row.format(alt=alt)), batch)
    (kept,) = tables.current(spark, "flight_events").collect()
    assert (kept["batch_id"], kept["altitude"]) == (3, 700.0)
    assert tables.read(spark, "flight_events").count() == 3


def alert_rows(spark, *regions):
    return spark.createDataFrame(
        [(r, "HIGH_CONGESTION") for r in regions], "region string, alert_type string"
    ).selectExpr("region", "timestamp_seconds(0) AS timestamp", "alert_type")


def test_batch_overwrites_its_own_partition_only(spark, tmp_path):
    tables = storage.ResultTables(str(tmp_path))
    assert tables.read(spark, "alerts").count() == 0
    assert tables.batch_before(spark, "alerts", 5) is None
    for batch, regions in [(1, "ab"), (3, "c"), (10, "d"), (3, "ef"), (10, "")]:
        tables.write("alerts", alert_rows(spark, *regions), batch)
    rows = tables.read(spark, "alerts").collect()
    assert sorted((r["batch_id"], r["region"]) for r in rows) == [
        (1, "a"),
        (1, "b"),
        (3, "e"),
        (3, "f"),
    ]
    assert [tables.batch_before(spark, "alerts", b) for b in (1, 2, 3, 11)] == [None, 1, 1, 10]
    assert column(tables.read_batch(spark, "alerts", 3), "region", "region") == ["e", "f"]


def test_unknown_table(tmp_path):
    with pytest.raises(KeyError):
        storage.ResultTables(str(tmp_path)).path("nope")

import json
import os

import pytest
from helpers import airports
from pyspark.sql import functions as F
from test_stream import NEAR, drop_file

from skylattice.operators.forecast import bucket_counts
from skylattice.operators.proximity import airport_join
from skylattice.plans.enrich import at_airports, enrich, prepare
from skylattice.schemas import FLIGHT_EVENT
from skylattice.sources.events import read_flight_stream
from skylattice.sources.polls import poll_events, read_polls
from skylattice.streaming import windows
from skylattice.streaming.proximity import ProximityStream

START = 1_700_000_010
NOW = {"availableNow": True}


def at(*seconds, **changes):
    return [{"icao24": f"p{s}", "timestamp": START + s} | changes for s in seconds]


def stream(spark, files, per_batch="1"):
    return read_flight_stream(spark, "text", {"maxFilesPerTrigger": per_batch}, path=str(files))


def batch_rows(spark, files):
    from skylattice.sources.events import parse_events

    return parse_events(spark.read.text(str(files)))


def counted(df):
    return sorted((r["region"], r["bucket"], r["count"]) for r in df.collect())


def test_streamed_buckets_equal_batch_buckets_after_a_restart(spark, tmp_path):
    files, base = tmp_path / "in", str(tmp_path / "out")
    near = airports(spark, *NEAR)

    def drain():
        windows.start_counts(
            at_airports(prepare(stream(spark, files)), near),
            folder=f"{base}/counts", checkpoint=f"{base}/check", trigger=NOW,
        ).awaitTermination()
        return counted(windows.read_counts(spark, f"{base}/counts"))

    drop_file(files, 0, at(0, 1, 19, 20, 49))
    drop_file(files, 1, at(5, 50, 300) + at(20, latitude=20.5))  # one falls into a bucket of the first batch
    want = lambda: counted(bucket_counts(enrich(batch_rows(spark, files), near)))
    assert drain() == want()
    drop_file(files, 2, at(21, 301, 640))
    assert drain() == want()
    assert drain() == want()  # nothing new


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    files, base = tmp_path / "in", str(tmp_path / "out")
    for n, rows in enumerate([at(0, 20), at(2000), at(3000), at(1)]):
        drop_file(files, n, rows)
    rows = at_airports(prepare(stream(spark, files)), airports(spark, *NEAR))
    windows.start_counts(rows, folder=f"{base}/counts", checkpoint=f"{base}/check", trigger=NOW, delay="1 minute").awaitTermination()
    found = windows.read_counts(spark, f"{base}/counts")
    first = START // 30
    assert found.where(F.col("bucket") == first).first()["count"] == 4  # two airports each, without the late one
    assert found.count() == 3


def test_append_stream_equals_the_join_and_follows_new_airports(spark, tmp_path):
    files, base = tmp_path / "in", str(tmp_path / "out")
    drop_file(files, 0, at(0, 1) + at(2, latitude=-40.0))
    old, new = airports(spark, *NEAR), airports(spark, (50.5, 10.5, "DE-HE", "small_airport"))
    job = ProximityStream(
        lambda: prepare(stream(spark, files)), folder=f"{base}/near", checkpoint=f"{base}/check", trigger=NOW
    )
    job.start(old).awaitTermination()
    columns = ["icao24", "ap_lat", "ap_lon", "iso_region", "type"]
    rows = lambda df: sorted(map(repr, df.select(*columns).collect()))
    near = lambda some: airport_join(prepare(batch_rows(spark, files)), some)
    seen = rows(spark.read.parquet(f"{base}/near"))
    assert seen == rows(near(old)) and len(seen) == 5

    drop_file(files, 1, at(7, 8))
    job.refresh(new).awaitTermination()
    late = near(new).where("icao24 IN ('p7', 'p8')")
    assert rows(spark.read.parquet(f"{base}/near")) == sorted(seen + rows(late))


# --- stored polls


def vector(name, lat=50.0):
    return [name, f"{name} ", "X", 1_700_000_000, None, 10.0, lat, 5000.0, False, 200.0, None, 0.0]


def poll(folder, name, *documents):
    folder.mkdir(exist_ok=True)
    fresh = folder / f".{name}"
    fresh.write_text("\n".join(d if isinstance(d, str) else json.dumps({"time": 1, "states": d}) for d in documents) + "\n")
    os.rename(fresh, folder / name)


def drain_polls(spark, folder, base, **options):
    seen = []

    def keep(df, batch_id):
        seen.append(sorted(r["icao24"] for r in df.collect()))

    polls = poll_events(read_polls(spark, str(folder), **options), max_records=2)
    polls.writeStream.foreachBatch(keep).option("checkpointLocation", f"{base}/check").trigger(**NOW).start().awaitTermination()
    return [s for s in seen if s]


def test_a_restart_neither_loses_nor_repeats_polls(spark, tmp_path):
    folder, base = tmp_path / "polls", tmp_path / "out"
    poll(folder, "0001.json", [vector("a"), vector("b"), vector("over the cap")], "not json")
    poll(folder, "0002.json", [vector("c")], [vector("d"), vector("zero", 0.0)])
    assert [sum(drain_polls(spark, folder, base), [])] == [["a", "b", "c", "d"]]
    assert drain_polls(spark, folder, base) == []
    poll(folder, "0003.json", [vector("e")])
    poll(folder, "0004.json", [])
    poll(folder, "0005.json", [vector("f")])
    assert sorted(sum(drain_polls(spark, folder, base, files_per_task=1), [])) == ["e", "f"]
    assert drain_polls(spark, folder, base) == []


@pytest.mark.parametrize("start, want", [("earliest", ["a", "b"]), ("0001.json", ["b"]), ("latest", [])])
def test_where_a_new_stream_begins(spark, tmp_path, start, want):
    folder = tmp_path / "polls"
    poll(folder, "0001.json", [vector("a")])
    poll(folder, "0002.json", [vector("b")])
    assert sum(drain_polls(spark, folder, tmp_path / start, start=start), []) == want


def test_polls_decode_like_batch_documents(spark, tmp_path):
    from skylattice.sources.states import decode_states

    folder = tmp_path / "polls"
    for i in range(12):
        poll(folder, f"{i:04}.json", [vector(f"v{i}"), vector(f"w{i}", 1.0 + i)], [vector(f"x{i}")])
    got = []
    polls = poll_events(read_polls(spark, str(folder), files_per_task=5))
    polls.writeStream.foreachBatch(lambda df, n: got.extend(map(repr, df.collect()))).option(
        "checkpointLocation", str(tmp_path / "check")
    ).trigger(**NOW).start().awaitTermination()
    want = decode_states(spark.read.text(str(folder)))
    assert want.columns == FLIGHT_EVENT.names
    assert sorted(got) == sorted(map(repr, want.collect())) and len(got) == 36


def test_streamed_pairs_hold_the_columns_of_the_query(spark, tmp_path, monkeypatch):
    from workload import queries

    spark.range(300).selectExpr(
        "id AS event_id", "timestamp_seconds(1704067200 + id) AS ts", "id % 50 AS user_id",
        "'view' AS event_type", "double(id % 90 + 1) AS value", "'{}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    suppliers = spark.range(2000).selectExpr("id AS s_suppkey", "'s' AS s_name", "int(id % 25) AS s_nationkey", "0D AS s_acctbal")
    suppliers.write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(queries, "_stream_folder", lambda _: str(tmp_path / "out"))
    streamed = queries.stream_proximity_join(spark, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "out" / "near")).columns == streamed.columns
    batch = queries.proximity_join(spark, str(tmp_path))
    assert streamed.where("ap_lat is not null").count() > 1000
    assert streamed.exceptAll(batch).isEmpty() and batch.exceptAll(streamed).isEmpty()

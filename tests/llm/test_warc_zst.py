import io
import random

import pytest
import zstandard
from llm_cases import sentence
from pyspark.sql import functions as F

from skylattice.llm import warc_zst as w

SCHEMA = "page_id bigint, url string, html string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def round_trip(spark, pages, **options):
    folder = w.new_folder(spark)
    archives = w.write_archives(pages, folder, **options)
    return archives, w.read_archives(archives, folder).collect()


def test_round_trip(spark):
    rng = random.Random(1)
    rows = [(i, f"http://h/{i}", f"<html>{sentence(rng, 60)}</html>") for i in range(200)]
    rows += [(500 + i, "http://copy", rows[i % 3][2]) for i in range(30)]
    rows += [(900, None, None), (901, "u\r\nx", "")]
    archives, got = round_trip(spark, table(spark, rows).repartition(3), archive_bytes=8000)
    assert len(got) == len(rows) and archives.count() > 3
    first = {}
    for i, _, html in rows:
        first.setdefault(html or "", i)
    for r in got:
        html = next(h or "" for i, _, h in rows if i == r["page_id"])
        assert r["payload_digest"] == w.sha1_base32(html.encode()) and r["payload_bytes"] == len(html.encode())
        want = None if first[html] == r["page_id"] else first[html]
        assert (r["refers_to"], r["record_type"]) == (want, "response" if want is None else "revisit")


def test_archive_layout(spark):
    rng = random.Random(2)
    pages = table(spark, [(i, "u", sentence(rng, 200)) for i in range(300)])
    archives, _ = round_trip(spark, pages.coalesce(1))
    (row,) = archives.collect()
    data = open(row["path"], "rb").read()
    assert int.from_bytes(data[:4], "little") == w.SKIPPABLE
    size = int.from_bytes(data[4:8], "little")
    content = zstandard.ZstdCompressionDict(data[8 : 8 + size])
    assert content.dict_id() != 0
    rest, records = data[8 + size :], 0
    while rest:  # every record is a frame of its own
        frame = zstandard.ZstdDecompressor(dict_data=content).decompressobj()
        assert frame.decompress(rest).startswith(w.VERSION)
        rest, records = frame.unused_data, records + 1
    assert records == 300


def test_small_payloads_can_stay_responses(spark):
    pages = table(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")])
    _, got = round_trip(spark, pages, min_bytes=5)
    assert {r["page_id"]: r["record_type"] for r in got} == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_hard_rows(spark):
    pages = table(spark, [(None, None, None), (None, "u", "x"), (3, "u", "x"), (3, "u", "x"), (5, "u", "é" * 300_000)])
    pages = pages.withColumns({n: F.lit("mine") for n in ("payload", "code", "first", "n", "refers_to", "path")})
    _, got = round_trip(spark, pages)
    key = lambda r: (str(r["page_id"]), r["payload_bytes"])
    assert sorted((key(r), r["record_type"], r["refers_to"]) for r in got) == [
        (("3", 1), "response", None),
        (("3", 1), "response", None),
        (("5", 600_000), "response", None),
        (("None", 0), "response", None),
        (("None", 1), "revisit", 3),
    ]
    _, none = round_trip(spark, pages.limit(0))
    assert none == []


def test_damage_is_noticed():
    frame = zstandard.ZstdCompressor().compress(w.record(1, "u", b"abc", None, w.sha1_base32(b"abc")))
    whole = w.leading_frame(b"") + frame
    assert len(list(w.read_archive(io.BytesIO(whole)))) == 1
    with pytest.raises(ValueError):
        list(w.read_archive(io.BytesIO(whole[:-6])))
    with pytest.raises(ValueError):
        list(w.read_archive(io.BytesIO(frame)))

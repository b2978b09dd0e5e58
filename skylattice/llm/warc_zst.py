"""Dictionary-compressed WARC archives: a leading skippable frame with the Zstandard dictionary, then
one frame per record.

The dictionary is built once from a bounded sample of the records to be archived. Tasks write whole
archives of bounded size to the shared folder under a name of their own, so a lost task's half file
is never listed; what was written is known from the returned rows. Reading streams frame by frame.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as files
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.storage import delete_at_exit
from .rows import bounded_sample, materialize, prepare, shared_uri, slices

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"  # records carry no capture time
VERSION = b"WARC/1.1\r\n"

DICT_BYTES = 64 * 1024
SAMPLE_ROWS = 400
SAMPLE_BYTES = 6_000_000
ARCHIVE_BYTES = 64_000_000
LEVEL = 3


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str | None) -> str:
    return "".join(c for c in (value or "") if c >= " " and c != "\x7f")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, digest: str) -> bytes:
    """A response record, or with ``refers_to`` a revisit that carries the payload's length alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_clean(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:x-page:{refers_to}>",
        ]
    head.append(f"Content-Length: {len(block)}")
    return VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers of the record, headers of the HTTP message, and its body."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version.encode() + b"\r\n" != VERSION:
        raise ValueError(f"not a WARC record: {version!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    length = int(headers["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("record length does not match its header")
    http, _, body = rest[:length].partition(b"\r\n\r\n")
    return headers, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), body


def dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; samples too few or too alike to train on serve as raw content."""
    total = sum(map(len, samples))
    try:
        # Limits follow the library's advice of a hundred times the dictionary's size.
        return zstandard.train_dictionary(max(256, min(size, total // 10)), samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def leading_frame(content: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(content)) + content


def read_archive(source) -> Iterator[bytes]:
    """Records of an archive, one at a time, from a binary stream."""
    magic, length = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("archive does not begin with a dictionary frame")
    content = source.read(length)
    own = zstandard.ZstdCompressionDict(content) if content else None
    decompressor = zstandard.ZstdDecompressor(dict_data=own)
    pending, out, inside = b"", io.BytesIO(), False
    frame = decompressor.decompressobj()
    while True:
        chunk = pending or source.read(1 << 20)
        if not chunk:
            break
        out.write(frame.decompress(chunk))
        pending, inside = b"", not frame.eof
        if frame.eof:
            yield out.getvalue()
            pending, out = frame.unused_data, io.BytesIO()
            frame = decompressor.decompressobj()
    if inside:
        raise ValueError("archive ends inside a record")


_WRITTEN = "path string, records bigint, bytes bigint"


def _first_of_payload(pages: DataFrame, min_bytes: int) -> DataFrame:
    """Adds ``refers_to``: the smallest page_id of the equal payload where this row is another."""
    code = F.sha2("payload", 256)
    keyed = pages.withColumn("code", code)
    first = keyed.groupBy("code").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    return keyed.join(first, "code", "left").withColumn(
        "refers_to",
        F.when(
            (F.length("payload") >= min_bytes)
            & F.col("first").isNotNull()
            & ~F.col("page_id").eqNullSafe(F.col("first")),
            F.col("first"),
        ),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    dict_bytes: int = DICT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    sample_rows: int = SAMPLE_ROWS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html); the archives as rows.

    Of rows with equal payloads (at least ``min_bytes``) that with the smallest page_id becomes the
    response and the others revisits. A null html is an empty payload, a null url an empty target.
    A null page_id is never the smallest: it refers to the smallest other, and rows of null ids
    alone, or rows repeating the smallest id, are all responses. Other columns are not read. An
    empty table writes no archive. The dictionary alone is built from a bounded sample: ``sample_rows``
    records, of each payload its even share of ``sample_bytes``; every payload is written whole.
    """
    spark = pages.sparkSession
    prepare(spark)
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"),
    )
    share = F.substring("payload", 1, sample_bytes // sample_rows).alias("payload")
    sample = bounded_sample(rows, sample_rows, "page_id", "url").select("page_id", "url", share)
    sample = sample.where(F.length("payload") > 0).collect()  # at most sample_bytes
    content = dictionary([record(r[0], r[1], bytes(r[2]), None, "") for r in sample], dict_bytes)
    shared = spark.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(shared.value) if shared.value else None
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=own, write_checksum=True)
        target, base = files.FileSystem.from_uri(folder)
        out, path, records, size, done = None, "", 0, 0, []
        for batch in slices(batches):
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "refers_to")]
            for page_id, url, payload, refers_to in zip(*columns):
                if out is None:
                    path = f"{base}/{uuid.uuid4().hex}.warc.zst"
                    out, records = target.open_output_stream(path, compression=None), 0
                    out.write(leading_frame(shared.value))
                    size = 8 + len(shared.value)
                frame = compressor.compress(record(page_id, url, payload, refers_to, sha1_base32(payload)))
                out.write(frame)
                records, size = records + 1, size + len(frame)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, records, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, records, size))
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], type=k) for i, k in enumerate(kinds)],
            names=["path", "records", "bytes"],
        )

    target, base = files.FileSystem.from_uri(folder)
    target.create_dir(base, recursive=True)
    placed = _first_of_payload(rows, min_bytes).select("page_id", "url", "payload", "refers_to")
    return materialize(placed.mapInArrow(run, _WRITTEN))


_READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """One row per record of the archives (column ``path``), every payload checked by its digest."""

    def page(urn: str | None) -> int | None:
        number = (urn or "").removeprefix("<urn:x-page:").removesuffix(">")
        return int(number) if number else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, _ = files.FileSystem.from_uri(folder)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)], names=names
            )

        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with target.open_input_stream(path, compression=None) as source:
                    for data in read_archive(source):
                        headers, http, body = parse(data)
                        kind = headers["WARC-Type"]
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(http["Content-Length"])
                        if kind == "response" and (sha1_base32(body) != digest or len(body) != length):
                            raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                        own = page(headers["WARC-Record-ID"])
                        rows.append((own, length, digest, kind, page(headers.get("WARC-Refers-To"))))
                        if len(rows) >= 5000:
                            yield batch_of(rows)
                            rows = []
                yield batch_of(rows)

    # One archive a task: archives are of bounded size.
    n = max(1, min(archives.count(), 10_000))
    return archives.select("path").repartition(n, "path").mapInArrow(run, _READ)


def new_folder(spark) -> str:
    """A fresh folder for archives below the cluster's shared folder, as a URI; it goes with the application."""
    folder = f"{shared_uri(spark)}/warc/{uuid.uuid4().hex}"
    delete_at_exit(spark, folder)
    return folder

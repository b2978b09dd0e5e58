"""Small helpers shared by the operators: stored intermediates and Arrow batches."""

from __future__ import annotations

import ctypes
import functools
import gc
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize, shared_dir, write_bytes

__all__ = ["materialize", "shared_dir", "read", "bounded_sample", "prepare", "shared_uri", "count_of", "slices", "releasing", "texts_of", "spans_text"]

BATCH_ROWS = 1000
SURPLUS = 4
_HASHES = 2**31 - 1
_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Settings of the operators, and the package for the Python workers.

    Arrow batches hold whole texts, so they get fewer rows than Spark's default. The package goes
    to the shared folder as an archive once per application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    content = io.BytesIO()
    package = Path(__file__).resolve().parent.parent
    with zipfile.ZipFile(content, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    path = f"{shared_dir(spark)}/{package.name}-{context.applicationId}.zip"
    write_bytes(spark, path, content.getvalue())
    context.addPyFile(path)


def shared_uri(spark: SparkSession) -> str:
    """The shared folder as a URI that file systems other than Spark's understand, too."""
    folder = shared_dir(spark)
    if "://" in folder:
        return folder
    return "file://" + folder.removeprefix("file:")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """Short slices of the batches: only few texts exist as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def release() -> None:
    """Give memory that is no longer used back to the system, as far as its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable) -> Callable:
    """``run`` of a task, whose Python worker holds no freed memory while it waits for another.

    Workers outlive their tasks and stay beside the stages after them, in the same executor's memory.
    """

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def bounded_sample(df: DataFrame, limit: int, *key: str) -> DataFrame:
    """The ``limit`` rows whose ``key`` hashes lowest, whatever the layout of ``df``.

    A cut on the hash, from the row count, lets about four times as many through, so that
    what the tasks send does not grow with their number.
    """
    rows = df.count()
    cut = _HASHES if rows <= SURPLUS * limit else SURPLUS * limit * _HASHES // rows
    at = F.pmod(F.xxhash64(*key), F.lit(_HASHES))
    through = df.withColumn("_at", at).where(F.col("_at") < cut)
    return through.orderBy("_at", *key).limit(limit).drop("_at")


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of every span, joined by commas; empty without spans."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def count_of(spans: str, kind: str) -> Column:
    """``n_<kind>``: how many of the spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

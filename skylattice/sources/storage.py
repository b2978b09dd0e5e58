"""Shared storage: result tables keyed by batch, and materialised intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.pick import upsert_view
from ..schemas import KEYS, TABLES

CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_SCHEMES = ("", "file")
_seen_by_all: set[tuple[str, str]] = set()
_copies: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a session whose executors are threads of this machine uses a folder
    beside its warehouse, and any other session is refused. A path without the scheme of a
    shared store is tried out before a cluster uses it.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    master = spark.sparkContext.master
    own_threads = master.startswith("local") and not master.startswith("local-cluster")
    if not named:
        if not own_threads:
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    folder = named.rstrip("/")
    if not own_threads and folder.partition(":")[0 if ":" in folder else 2] in _LOCAL_SCHEMES:
        _check_seen_by_all(spark, folder)
    return folder


def _check_seen_by_all(spark: SparkSession, folder: str) -> None:
    """A file the driver writes must be readable in a task, as on a mounted share."""
    known = (spark.sparkContext.applicationId, folder)
    if known in _seen_by_all:
        return
    fs, path = _file_system(spark, f"{folder}/probe-{uuid.uuid4().hex}")
    out = fs.create(path, True)
    out.writeBytes("seen")
    out.close()
    try:
        if spark.read.text(path.toString()).count() != 1:
            raise ValueError(f"{folder} is not shared by all executors")
    finally:
        fs.delete(path, False)
    _seen_by_all.add(known)


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file, deleted with the application."""
    fs, at = _file_system(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(content))
    out.close()
    fs.deleteOnExit(at)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Have the folder deleted with the application."""
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    For operators that read their input several times. The copy outlives lost executors,
    unlike cached blocks, and is columnar. It is deleted at the end of the ``scratch``
    block it was made in, or else with the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/materialized/{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_at_exit(spark, path)
    _copies.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the copies materialised inside the block when it ends.

    Results that are read later must be stored elsewhere by then.
    """
    before = len(_copies)
    try:
        yield
    finally:
        for path in _copies[before:]:
            fs, at = _file_system(spark, path)
            fs.delete(at, True)
            fs.cancelDeleteOnExit(at)
        del _copies[before:]


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of ``path`` (one listing call); empty when it is absent."""
    fs, at = _file_system(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(at)] if fs.exists(at) else []


class ResultTables:
    """The result tables below one base folder, partitioned by ``batch_id``.

    A batch owns its partition of every table and overwrites it as a whole, so a
    replayed batch leaves the tables as one run would have. Tables and the stream's
    checkpoint belong together: batch ids restart with a new checkpoint.
    """

    KEY = "batch_id"
    POINTER = "_newest"

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(f"unknown result table {name!r}")
        return f"{self.base}/{name}"

    @contextmanager
    def batch(self, spark: SparkSession, batch_id: int):
        """Writes the tables of a batch, each as soon as it is given."""
        yield _Batch(self, batch_id)

    def write(self, name: str, df: DataFrame, batch_id: int) -> None:
        columns = TABLES[name].names
        df.select(*columns).write.mode("overwrite").parquet(
            f"{self.path(name)}/{self.KEY}={batch_id}"
        )
        self._point(df.sparkSession, name, batch_id)

    def _pointer(self, spark: SparkSession, name: str) -> list[int]:
        """The newest stored batch and the one before it, as far as there are any."""
        fs, path = _file_system(spark, f"{self.path(name)}/{self.POINTER}")
        if not fs.exists(path):
            return []
        source = fs.open(path)
        line = source.readLine()
        source.close()
        return [int(x) for x in (line or "").split()]

    def _point(self, spark: SparkSession, name: str, batch_id: int) -> None:
        """Note the newest batch after it is stored; a replayed or older one changes nothing.

        A crash in between leaves the older note, which is right for the replay to come.
        """
        noted = self._pointer(spark, name)
        if noted and noted[0] >= batch_id:
            return
        if not noted:  # tables of unknown history
            before = self._listed_before(spark, name, batch_id)
            noted = [] if before is None else [before]
        fs, path = _file_system(spark, f"{self.path(name)}/{self.POINTER}")
        _, fresh = _file_system(spark, f"{self.path(name)}/{self.POINTER}-{uuid.uuid4().hex}")
        out = fs.create(fresh, True)
        out.writeBytes(" ".join(map(str, [batch_id, *noted[:1]])))
        out.close()
        fs.delete(path, False)  # without a note the folders are listed
        fs.rename(fresh, path)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        schema = StructType([*TABLES[name].fields, StructField(self.KEY, LongType())])
        if not exists(spark, self.path(name)):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path(name))

    def current(self, spark: SparkSession, name: str) -> DataFrame:
        """The table as a keyed store holds it: a later batch replaces rows of equal key."""
        return upsert_view(self.read(spark, name), KEYS[name])

    def read_batch(self, spark: SparkSession, name: str, batch_id: int) -> DataFrame:
        path = f"{self.path(name)}/{self.KEY}={batch_id}"
        return spark.read.schema(TABLES[name]).parquet(path)

    def batch_before(self, spark: SparkSession, name: str, batch_id: int) -> int | None:
        """Greatest stored batch id below ``batch_id``.

        The note of the newest batches answers for the batch that runs now, also when it is
        run again, however long the history is; for older ones the folders are listed.
        """
        noted = self._pointer(spark, name)
        if noted and noted[0] < batch_id:
            return noted[0]
        if noted and noted[0] == batch_id:
            return noted[1] if len(noted) > 1 else None
        return self._listed_before(spark, name, batch_id)

    def _listed_before(self, spark: SparkSession, name: str, batch_id: int) -> int | None:
        prefix = f"{self.KEY}="
        stored = [
            int(entry[len(prefix) :])
            for entry in folder_names(spark, self.path(name))
            if entry.startswith(prefix)
        ]
        return max((b for b in stored if b < batch_id), default=None)


class _Batch:
    def __init__(self, tables: ResultTables, batch_id: int):
        self.tables, self.batch_id = tables, batch_id

    def write(self, name: str, df: DataFrame) -> None:
        self.tables.write(name, df, self.batch_id)

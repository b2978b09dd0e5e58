"""Stored poll documents as a stream that can be replayed from any position.

A poll is kept as a file of JSON documents, one per line, whose name sorts after those of earlier polls.
A position in the stream is the name of the last file read, so a checkpoint holds one name however long
the history is, and a range between two positions always means the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .states import decode_states

FORMAT = "stored_polls"
SCHEMA = "poll string, value string"


def _source():
    # Defined here so that the classes travel by value to workers without this package.
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    def listed(folder: str) -> list[str]:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        names = [f.base_name for f in files if f.type == fs.FileType.File]
        return sorted(n for n in names if not n.startswith(("_", ".")))

    class Polls(InputPartition):
        def __init__(self, names: list[str]):
            self.names = names

    class Reader(DataSourceStreamReader):
        def __init__(self, options: dict[str, str]):
            self.folder = options["path"]
            self.start = options.get("start", "earliest")
            self.per_task = int(options.get("filespertask", 16))

        def initialOffset(self) -> dict:
            if self.start == "latest":
                return {"after": (listed(self.folder) or [""])[-1]}
            return {"after": "" if self.start == "earliest" else self.start}

        def latestOffset(self) -> dict:
            return {"after": max([*listed(self.folder), self.initialOffset()["after"]])}

        def partitions(self, start: dict, end: dict) -> list[Polls]:
            names = [n for n in listed(self.folder) if start["after"] < n <= end["after"]]
            return [Polls(names[i : i + self.per_task]) for i in range(0, len(names), self.per_task)]

        def read(self, partition: Polls):
            import io

            from pyarrow import fs

            store, path = fs.FileSystem.from_uri(self.folder)
            for name in partition.names:
                with store.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    for line in io.TextIOWrapper(raw, encoding="utf-8", errors="replace"):
                        yield name, line.rstrip("\r\n")

    class StoredPolls(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def schema(self) -> str:
            return SCHEMA

        def streamReader(self, schema) -> Reader:
            return Reader(dict(self.options))

    return StoredPolls


def uri(path: str) -> str:
    """The folder as a URI; plain paths are those of the machines' own (shared) file system."""
    if "://" in path:
        return path
    return "file://" + path.removeprefix("file:")


def read_polls(
    spark: SparkSession,
    path: str,
    *,
    start: str = "earliest",
    files_per_task: int = 16,
) -> DataFrame:
    """Streaming ``(poll, value)``: every stored document once, in the order of the polls.

    ``start`` is ``earliest``, ``latest`` or the name of a poll to begin after; a checkpoint goes before it.
    A batch takes all polls since the one before, in tasks of ``files_per_task`` files that pass lines on
    one by one.
    """
    spark.dataSource.register(_source())
    reader = spark.readStream.format(FORMAT).option("path", uri(path)).option("start", start)
    return reader.option("filespertask", str(files_per_task)).load()


def poll_events(polls: DataFrame, *, max_records: int | None = None) -> DataFrame:
    """Flight events of the stored documents, as ``decode_states`` finds them."""
    return decode_states(polls, max_records=max_records)


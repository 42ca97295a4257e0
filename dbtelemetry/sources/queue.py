"""The exported message queue as a Python data source, for batch and streaming reads.

The queue reader of a server exports messages as files (Parquet or JSON
lines) into a folder. Files are published whole and in order: a file's
modification time is not before that of files published earlier. A file is
one partition; its messages keep their order, and a message's id is its
file and row, so two messages of equal content and time stay two. The
stream's offset is the last file taken: a restart at an offset repeats and
loses nothing. Files whose names begin with ``_`` or ``.`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

FORMAT = "message_queue"
SCHEMA = "message_id string, server_name string, message_type_name string, event_ts timestamp_ntz, message_body string"
_ARROW = pa.schema([("message_id", pa.string()), ("server_name", pa.string()), ("message_type_name", pa.string()),
                    ("event_ts", pa.timestamp("us")), ("message_body", pa.string())])
ROWS = 1024


@dataclass
class QueueFile(InputPartition):
    name: str


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class _Queue:
    """What batch and stream readers share: listing the files, reading one."""

    def __init__(self, options: dict):
        self.path, self.kind = options["path"], options.get("fileformat", "parquet")
        if self.kind not in ("parquet", "json"):
            raise ValueError(f"a queue holds parquet or json files, not {self.kind}")

    def files(self) -> list[tuple[int, str]]:
        """``(modification time, name)`` of all files, in queue order."""
        from pyarrow import fs

        there, path = _open(self.path)
        found = there.get_file_info(fs.FileSelector(path, allow_not_found=True))
        return sorted((f.mtime_ns, f.base_name) for f in found
                      if f.type == fs.FileType.File and f.base_name[0] not in "_.")

    def read(self, partition: QueueFile) -> Iterator[pa.RecordBatch]:
        there, path = _open(self.path)
        row = 0
        with there.open_input_file(f"{path.rstrip('/')}/{partition.name}") as f:
            for batch in self._batches(f):
                ids = [f"{partition.name}#{row + k:012d}" for k in range(len(batch))]
                row += len(batch)
                columns = [pa.array(ids)] + [batch.column(c.name).cast(c.type) if c.name in batch.schema.names
                                             else pa.nulls(len(batch), c.type) for c in list(_ARROW)[1:]]
                yield pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def _batches(self, f) -> Iterator[pa.RecordBatch]:
        if self.kind == "parquet":
            import pyarrow.parquet as pq

            names = set(_ARROW.names[1:])
            file = pq.ParquetFile(f)
            yield from file.iter_batches(ROWS, columns=[n for n in file.schema_arrow.names if n in names])
        elif f.size():
            from pyarrow import json

            fields = [(c.name, pa.string()) for c in list(_ARROW)[1:]]
            parse = json.ParseOptions(explicit_schema=pa.schema(fields), unexpected_field_behavior="ignore")
            yield from json.open_json(f, parse_options=parse)


class QueueReader(_Queue, DataSourceReader):
    def partitions(self) -> list[QueueFile]:
        return [QueueFile(name) for _, name in self.files()]


class QueueStreamReader(_Queue, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"time": 0, "name": ""}

    def latestOffset(self) -> dict:
        files = self.files()
        return {"time": files[-1][0], "name": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[QueueFile]:
        after, until = (start["time"], start["name"]), (end["time"], end["name"])
        return [QueueFile(name) for time, name in self.files() if after < (time, name) <= until]


class QueueSource(DataSource):
    """``spark.read`` / ``readStream.format("message_queue")``; options ``path`` and ``fileformat`` (parquet or json)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> QueueReader:
        return QueueReader(self.options)

    def streamReader(self, schema) -> QueueStreamReader:
        return QueueStreamReader(self.options)


def read_queue(spark: SparkSession, path: str, fileformat: str = "parquet"):
    """All exported messages as they are now, as a batch relation."""
    spark.dataSource.register(QueueSource)
    return spark.read.format(FORMAT).option("fileformat", fileformat).load(path)


def stream_queue(spark: SparkSession, path: str, fileformat: str = "parquet"):
    """The exported messages as a stream."""
    spark.dataSource.register(QueueSource)
    return spark.readStream.format(FORMAT).option("fileformat", fileformat).load(path)

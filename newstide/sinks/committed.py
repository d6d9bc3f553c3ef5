"""Lines of text that count once their batch is committed: a data source for points.

Tasks write files of their own attempt. When all have finished, the driver writes one manifest
that names the files which count, and only these are read. What a failed or repeated attempt
has left is never seen, and a batch that is written again replaces its manifest. The same
sink serves batch writes and streams, whose batch numbers make a replay harmless.

The folder must be one that pyarrow opens from driver and executors: shared, as the
checkpoint folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

FORMAT = "committed_lines"


def _opened(path: str):
    """The file system and the folder in it."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    return FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: the file's name and its number of lines."""

    file: str
    lines: int


class _Lines:
    """Files of attempts, and the manifest that makes some of them count."""

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")

    def attempt(self, batches: Iterator[pa.RecordBatch], batch: str) -> Written:
        files, base = _opened(self.folder)
        name, lines = f"{batch}-{uuid.uuid4().hex}.txt", 0
        files.create_dir(f"{base}/lines", recursive=True)
        with files.open_output_stream(f"{base}/lines/{name}") as out:
            for rows in batches:
                own = [v for v in rows.column(0).to_pylist() if v is not None]
                out.write("".join(f"{v}\n" for v in own).encode())
                lines += len(own)
        return Written(name, lines)

    def publish(self, messages: list[Written | None], batch: str) -> None:
        files, base = _opened(self.folder)
        files.create_dir(f"{base}/manifests", recursive=True)
        counted = [{"file": m.file, "lines": m.lines} for m in messages if m is not None and m.lines]
        # under a name of its own first: a manifest is there whole or not at all
        draft = f"{base}/manifests/_{batch}-{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as out:
            out.write(json.dumps({"batch": batch, "files": counted}).encode())
        files.move(draft, f"{base}/manifests/{batch}.json")

    def discard(self, messages: list[Written | None]) -> None:
        """Attempts that will never count are deleted as far as they are known."""
        files, base = _opened(self.folder)
        for message in messages:
            if message is not None:
                files.delete_file(f"{base}/lines/{message.file}")


class _BatchWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.lines, self.batch = _Lines(options), options.get("batch") or uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.lines.attempt(iterator, self.batch)

    def commit(self, messages: list[Written | None]) -> None:
        self.lines.publish(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.lines.discard(messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.lines, self.stream = _Lines(options), options.get("batch") or "stream"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.lines.attempt(iterator, self.stream)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.lines.publish(messages, f"{self.stream}-{batchId:09d}")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.lines.discard(messages)


class CommittedLines(DataSource):
    """Options ``path`` and ``batch``, the name under which a repeated write replaces the first."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> _BatchWriter:
        return _BatchWriter(self.options)

    def streamWriter(self, schema, overwrite: bool) -> _StreamWriter:
        return _StreamWriter(self.options)


def write_lines(frame: DataFrame, path: str, batch: str) -> None:
    """Write a frame's one text column as a batch; the same batch written again replaces it."""
    frame.sparkSession.dataSource.register(CommittedLines)
    frame.write.format(FORMAT).option("path", path).option("batch", batch).mode("append").save()


def stream_lines(frame: DataFrame, path: str, checkpoint: str, stream: str = "stream", available_now: bool = True) -> StreamingQuery:
    """Write a streaming frame's one text column, each micro-batch once."""
    frame.sparkSession.dataSource.register(CommittedLines)
    writer = frame.writeStream.format(FORMAT).option("path", path).option("batch", stream).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start() if available_now else writer.start()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all committed batches; a list of file names reaches the driver, no line."""
    files, base = _opened(path.rstrip("/"))
    from pyarrow.fs import FileSelector, FileType

    found = files.get_file_info(FileSelector(f"{base}/manifests", allow_not_found=True))
    names = []
    for info in found:
        if info.type == FileType.File and info.path.endswith(".json"):
            with files.open_input_stream(info.path) as manifest:
                names += [f["file"] for f in json.loads(manifest.read())["files"]]
    if not names:
        return spark.createDataFrame([], "value string")
    return spark.read.text([f"{path.rstrip('/')}/lines/{name}" for name in names])

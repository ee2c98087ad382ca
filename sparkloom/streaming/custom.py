"""Custom stream source and sink on the Python Data Source API."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow.fs as fs
from pyspark import TaskContext
from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceStreamReader, DataSourceStreamWriter,
                                    InputPartition, WriterCommitMessage)
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from sparkloom.scratch import qualified

SOURCE_NAME = "numbered"
SINK_NAME = "statements"


@dataclass
class NumberedPartition(InputPartition):
    batch: int
    index: int


class NumberedReader(DataSourceStreamReader):
    """Batch n holds `partitions` x `rows` rows; a new batch exists while the offset still grows."""

    def __init__(self, options: dict[str, str]):
        self.partitions_per_batch = int(options.get("partitions", "2"))
        self.rows = int(options.get("rows", "3"))
        self.batches = int(options.get("batches", "1000000000"))
        self.counter = 0

    def initialOffset(self) -> dict:
        return {"batch": 0}

    def latestOffset(self) -> dict:
        self.counter = min(self.counter + 1, self.batches)
        return {"batch": self.counter}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # After a restart the counter may lie behind the stored offset: then there is nothing to read.
        self.counter = max(self.counter, end["batch"])
        return [NumberedPartition(batch, index)
                for batch in range(start["batch"], end["batch"])
                for index in range(self.partitions_per_batch)]

    def read(self, partition: NumberedPartition) -> Iterator[tuple]:
        first = (partition.batch * self.partitions_per_batch + partition.index) * self.rows
        for number in range(first, first + self.rows):
            yield (number, f"value-{number}")

    def commit(self, end: dict) -> None:
        pass


class NumberedSource(DataSource):
    """Rows (id INT, value STRING) by offset; the content depends on the offset only."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self):
        raise PySparkNotImplementedError(errorClass="NOT_IMPLEMENTED",
                                         messageParameters={"feature": "reading without a given schema"})

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return NumberedReader(self.options)


@dataclass
class WrittenFile(WriterCommitMessage):
    file: str
    rows: int


def _target(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI. A path without a scheme is on the machine's own disk: only a local run may name
    one. `scratch.qualified` gives the URI that Spark itself would use, `write_statements` does so."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass(frozen=True)
class Manifest:
    batch: int
    attempt: int
    path: str


def _manifests(files: fs.FileSystem, base: str) -> list[Manifest]:
    """All manifests, by batch and attempt."""
    found = []
    for info in files.get_file_info(fs.FileSelector(base)):
        if info.base_name.startswith("batch-") and info.extension == "json":
            _, batch, attempt, _ = info.base_name.split("-", 3)
            found.append(Manifest(int(batch), int(attempt), info.path))
    return sorted(found, key=lambda m: (m.batch, m.attempt, m.path))


class StatementsWriter(DataSourceStreamWriter):
    """Each task writes its own file; the batch counts only once its manifest lists them.

    All files go through the file system that the URI names, so on a cluster the path is on shared storage.
    Each attempt at a batch writes a manifest of its own name, which appears whole by a rename; the newest of a batch
    counts, older ones are deleted afterwards. So at no moment is a committed batch unlisted, and files that no
    counting manifest lists do not count.
    """

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator) -> WriterCommitMessage:
        files, base = _target(self.path)
        files.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.sql"
        rows = 0
        with files.open_output_stream(f"{base}/{name}") as out:
            for row in iterator:
                out.write(f"{row[0]}\n".encode())
                rows += 1
        return WrittenFile(name, rows)

    def commit(self, messages, batchId: int) -> None:
        files, base = _target(self.path)
        files.create_dir(base, recursive=True)
        written = [{"file": m.file, "rows": m.rows} for m in messages if m is not None]
        before = [m for m in _manifests(files, base) if m.batch == batchId]
        attempt = max((m.attempt for m in before), default=-1) + 1
        final = f"{base}/batch-{batchId:010d}-{attempt:06d}-{uuid.uuid4().hex}.json"
        with files.open_output_stream(f"{final}.tmp") as out:
            out.write(json.dumps({"batch": batchId, "files": written}).encode())
        files.move(f"{final}.tmp", final)
        for old in before:
            files.delete_file(old.path)

    def abort(self, messages, batchId: int) -> None:
        files, base = _target(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{base}/{m.file}")


class StatementsSink(DataSource):
    """Writes a frame with one string column, the statements to send; option `path` is required."""

    @classmethod
    def name(cls) -> str:
        return SINK_NAME

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        if [f.dataType.simpleString() for f in schema.fields] != ["string"]:
            raise ValueError("the sink takes exactly one string column")
        if "path" not in self.options:
            raise ValueError("option path is required")
        return StatementsWriter(self.options["path"])


def committed_files(path: str) -> list[str]:
    """Files of the committed batches, as paths to read: one short text per task of a batch."""
    files, base = _target(path)
    newest = {m.batch: m for m in _manifests(files, base)}
    found = []
    for manifest in newest.values():
        with files.open_input_stream(manifest.path) as opened:
            listed = json.loads(opened.read())["files"]
        found += [f"{path.rstrip('/')}/{part['file']}" for part in listed]
    return found


def committed_statements(spark: SparkSession, path: str) -> DataFrame:
    """Statements of the committed batches, one per row."""
    found = committed_files(qualified(spark, path))
    if not found:
        return spark.createDataFrame([], "statement string")
    return spark.read.text(found).withColumnRenamed("value", "statement")


def write_statements(statements: DataFrame, path: str) -> DataStreamWriter:
    """A stream of statements into the sink at a path on any file system that Spark resolves."""
    register(statements.sparkSession)
    return statements.writeStream.format(SINK_NAME).option("path", qualified(statements.sparkSession, path))


def register(spark: SparkSession) -> None:
    """Make both formats known to the session and to the thread's active one, where Spark looks a sink up."""
    for session in (spark, SparkSession.getActiveSession() or spark):
        session.dataSource.register(NumberedSource)
        session.dataSource.register(StatementsSink)

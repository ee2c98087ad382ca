"""A custom stream source over the files of a stored table: offset log, admission by rows, planned partitions.

An offset is a place in the table: its files in the order of time and name, and a row of a file. A micro-batch takes
at most `rowsPerBatch` rows from there on, so a table of any size is read in bounded steps, and rows that later files
bring are taken when they are there. The rows between two offsets follow from the offsets alone, so a batch that is
run again reads the same rows.

Python stream sources are not told where a restarted query stands. The reader therefore logs each offset to
`offsetLog` before it gives it to Spark. A restarted reader goes on from the last logged one: Spark's own is that one
or an earlier one, and the rows between them belong to the first batch after the restart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from sparkloom.scratch import qualified
from sparkloom.streaming.custom import _target

SOURCE_NAME = "table_files"
_LOGGED = 20  # offsets that are kept; the last one counts


@dataclass
class RowRange(InputPartition):
    """Rows [first, last) of a file."""

    file: str
    first: int
    last: int


@dataclass(frozen=True)
class TableFile:
    time: int
    path: str

    @property
    def place(self) -> tuple[int, str]:
        return self.time, self.path


class OffsetLog:
    """Offsets in the order in which they were given out, one small file each."""

    def __init__(self, uri: str):
        self._files, self._base = _target(uri)
        self._files.create_dir(self._base, recursive=True)
        names = self._names()
        self._next = int(names[-1].split("-")[0]) + 1 if names else 0

    def _names(self) -> list[str]:
        found = self._files.get_file_info(fs.FileSelector(self._base))
        return sorted(i.base_name for i in found if i.extension == "json")

    def last(self) -> dict | None:
        names = self._names()
        if not names:
            return None
        with self._files.open_input_stream(f"{self._base}/{names[-1]}") as entry:
            return json.loads(entry.read())

    def add(self, offset: dict) -> None:
        """A whole entry appears at once: it is written under another name and renamed."""
        name = f"{self._base}/{self._next:012d}-{uuid.uuid4().hex}"
        with self._files.open_output_stream(f"{name}.tmp") as out:
            out.write(json.dumps(offset).encode())
        self._files.move(f"{name}.tmp", f"{name}.json")
        self._next += 1
        for old in self._names()[:-_LOGGED]:
            self._files.delete_file(f"{self._base}/{old}")


class TableFilesReader(DataSourceStreamReader):
    """`path` and `offsetLog` are URIs; `rowsPerBatch` and `rowsPerPartition` bound a batch and a task."""

    def __init__(self, options, schema: StructType):
        for name in ("path", "offsetLog"):
            if name not in options:
                raise ValueError(f"option {name} is required")
        self.path, self.schema = options["path"], schema
        self.per_batch = int(options.get("rowsPerBatch", "5000000"))
        self.per_partition = int(options.get("rowsPerPartition", "500000"))
        if self.per_batch < 1 or self.per_partition < 1:
            raise ValueError("rowsPerBatch and rowsPerPartition must be at least 1")
        self._log_uri, self._log, self._at = options["offsetLog"], None, None
        self._known: list[TableFile] = []
        self._rows: dict[str, int] = {}

    # Places: offsets are dictionaries of numbers and texts, as they go through Spark's log.

    def initialOffset(self) -> dict:
        return {"time": -1, "file": "", "row": 0}

    def _list(self) -> list[TableFile]:
        files, base = _target(self.path)
        info = files.get_file_info(base)
        if info.type == fs.FileType.File:
            return [TableFile(info.mtime_ns, info.path)]
        found = files.get_file_info(fs.FileSelector(base, recursive=True))
        return sorted((TableFile(i.mtime_ns, i.path) for i in found
                       if i.type == fs.FileType.File and not i.base_name.startswith(("_", "."))), key=lambda f: f.place)

    def _from(self, offset: dict) -> list[TableFile]:
        return [f for f in self._known if f.place >= (offset["time"], offset["file"])]

    def _size(self, file: TableFile) -> int:
        if file.path not in self._rows:
            with _target(self.path)[0].open_input_file(file.path) as opened:
                self._rows[file.path] = pq.read_metadata(opened).num_rows
        return self._rows[file.path]

    def _advance(self, offset: dict, rows: int) -> dict:
        """The place `rows` rows further on, or the end of the last file."""
        for file in self._from(offset):
            first = offset["row"] if file.place == (offset["time"], offset["file"]) else 0
            taken = min(rows, self._size(file) - first)
            offset, rows = {"time": file.time, "file": file.path, "row": first + taken}, rows - taken
            if not rows:
                break
        return offset

    def latestOffset(self) -> dict:
        if self._log is None:
            self._log = OffsetLog(self._log_uri)
            self._at = self._log.last() or self.initialOffset()
        ahead = self._from(self._at)
        if not ahead or (len(ahead) == 1 and self._at["row"] >= self._size(ahead[0])):
            self._known = self._list()
        to = self._advance(self._at, self.per_batch)
        if to != self._at:
            self._log.add(to)
            self._at = to
        return to

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        last = (end["time"], end["file"])
        if not any(f.place == last for f in self._known):
            self._known = self._list()
        found = []
        for file in self._from(start):
            if file.place > last:
                break
            first = start["row"] if file.place == (start["time"], start["file"]) else 0
            stop = end["row"] if file.place == last else self._size(file)
            found += [RowRange(file.path, a, min(a + self.per_partition, stop))
                      for a in range(first, stop, self.per_partition)]
        return found

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        """Only the row groups that hold rows of the range are read."""
        wanted = to_arrow_schema(self.schema)
        with _target(self.path)[0].open_input_file(partition.file) as opened:
            stored = pq.ParquetFile(opened)
            begin = 0
            for group in range(stored.num_row_groups):
                end = begin + stored.metadata.row_group(group).num_rows
                if begin < partition.last and end > partition.first:
                    at = begin
                    for batch in stored.iter_batches(row_groups=[group], columns=wanted.names):
                        low, high = max(partition.first - at, 0), min(partition.last - at, batch.num_rows)
                        if low < high:
                            part = batch.slice(low, high - low)
                            yield pa.RecordBatch.from_arrays(
                                [part.column(f.name).cast(f.type, safe=False) for f in wanted], schema=wanted)
                        at += batch.num_rows
                begin = end

    def commit(self, end: dict) -> None:
        pass


class TableFiles(DataSource):
    """Parquet files as a stream; the columns are those of the given schema or, without one, of the first file."""

    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> StructType:
        files = TableFilesReader(self.options, StructType())._list()
        if not files:
            raise ValueError("a table without files needs a schema")
        with _target(self.options["path"])[0].open_input_file(files[0].path) as opened:
            return from_arrow_schema(pq.read_schema(opened), prefer_timestamp_ntz=True)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return TableFilesReader(self.options, schema)


def stream_table(spark: SparkSession, path: str, offset_log: str, rows_per_batch: int, rows_per_partition: int,
                 schema: StructType | None = None) -> DataFrame:
    """The table's files as a stream; both paths may be any that Spark resolves. One offset log per query."""
    for session in (spark, SparkSession.getActiveSession() or spark):
        session.dataSource.register(TableFiles)
    reader = spark.readStream.format(SOURCE_NAME)
    if schema is not None:
        reader = reader.schema(schema)
    return (reader.option("path", qualified(spark, path)).option("offsetLog", qualified(spark, offset_log))
            .option("rowsPerBatch", rows_per_batch).option("rowsPerPartition", rows_per_partition).load())

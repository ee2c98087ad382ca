"""Turn a stored table into files that arrive in time order, for file streams."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkloom.functions.timestamps import as_instant
from sparkloom.operators.positions import global_row_number
from sparkloom.scratch import delete_path, list_files, new_dir, publish_file

LEAST_SLICES = 4
ROWS_PER_SLICE = 50_000_000
ROWS_PER_FILE = 5_000_000

#: The number of slices in SQL, from the same parameters.
SLICES_SQL = f"(select greatest({LEAST_SLICES}, (count(*) + {ROWS_PER_SLICE - 1}) // {ROWS_PER_SLICE}) from events)"


def slices_for(rows: int) -> int:
    """Micro-batches of bounded size, at least a few."""
    return max(LEAST_SLICES, -(-rows // ROWS_PER_SLICE))


@dataclass(frozen=True)
class Arrivals:
    """Staged files and how many of them make one slice (= one micro-batch)."""

    path: str
    schema: T.StructType
    files_per_slice: int


@dataclass(frozen=True)
class Cuts:
    """How rows numbered from 0 in time order fall into slices and files; all slices but short tables' last ones
    have the same number of rows, whatever their times."""

    rows: int
    slices: int
    rows_per_file: int

    @property
    def per_slice(self) -> int:
        return max(1, -(-self.rows // self.slices))

    @property
    def files(self) -> int:
        """Files of a slice."""
        return max(1, -(-self.per_slice // self.rows_per_file))

    @property
    def per_file(self) -> int:
        return -(-self.per_slice // self.files)

    def files_of(self, slice_number: int) -> int:
        """Files of this slice that hold rows; a slice at the end of the table may lack some."""
        inside = min(self.per_slice, max(0, self.rows - slice_number * self.per_slice))
        return -(-inside // self.per_file)


def dealt_to_files(numbered: DataFrame, cuts: Cuts) -> DataFrame:
    """Rows numbered from 1 by `__rn` with their `__slice` and `__file`, a partition for each file. Dealt by hash, several
    files would meet in a task, the more the larger the table."""
    number = F.col("__rn") - 1
    slice_number = F.floor(number / F.lit(cuts.per_slice)).cast("int")
    file_number = F.floor(F.pmod(number, F.lit(cuts.per_slice)) / F.lit(cuts.per_file)).cast("int")
    return (numbered.withColumn("__slice", slice_number).withColumn("__file", file_number)
            .repartitionById(cuts.slices * cuts.files, (F.col("__slice") * cuts.files + F.col("__file")).cast("int")))


def stage_arrivals(df: DataFrame, ts: str, path: str, slices: int | None = None,
                   rows_per_file: int = ROWS_PER_FILE, order: Sequence[str] = ()) -> Arrivals:
    """Write the table as slices of equal numbers of rows, oldest first, so file times follow event times.

    `ts` is zone-less in the table and written as an instant, which watermarks need. Rows are numbered by time and,
    where times are equal, by `order`; so a burst, even one at a single instant, is cut like any other rows. The
    numbered rows are written once, a file per task; then the files are published one by one by renaming them. Every
    slice has the same number of files, so that as many files per trigger give one slice per micro-batch; a last
    slice with fewer rows gets files without rows. Rising file times are checked. Rows without a time come last.
    """
    spark = df.sparkSession
    instants = as_instant(df, ts)
    rows = df.count()
    if not rows:
        instants.write.mode("append").parquet(path)
        return Arrivals(path, instants.schema, 1)
    cuts = Cuts(rows, slices or slices_for(rows), rows_per_file)
    # No task sorts or writes more rows than a file takes.
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_file))
    numbered = global_row_number(instants, [F.col(ts).asc_nulls_last(), *order], "__rn", ranges)
    staged = new_dir(spark, "staged")
    dealt_to_files(numbered, cuts).drop("__rn").write.partitionBy("__slice", "__file").parquet(staged)
    empty = new_dir(spark, "no-rows")
    spark.createDataFrame([], instants.schema).coalesce(1).write.parquet(empty)
    no_rows = [f for f in list_files(spark, empty) if f.path.endswith(".parquet")][0]
    newest = 0
    for s in range(-(-rows // cuts.per_slice)):
        time.sleep(0.005)  # file times have a resolution; equal ones would mix two slices
        times = []
        for f in range(cuts.files):
            folder = f"{staged}/__slice={s}/__file={f}"
            source = [part.path for part in list_files(spark, folder)] if f < cuts.files_of(s) else [no_rows.path]
            if len(source) != 1:
                raise RuntimeError(f"{folder} has {len(source)} files instead of one")
            times.append(publish_file(spark, source[0], f"{path}/slice-{s:06d}-{f:06d}.parquet", keep=f >= cuts.files_of(s)))
        if min(times) <= newest:
            raise RuntimeError(f"files of slice {s} are not newer than the ones before")
        newest = max(times)
    for made in (staged, empty):
        delete_path(spark, made)
    return Arrivals(path, instants.schema, cuts.files)


def stream_arrivals(spark: SparkSession, arrivals: Arrivals) -> DataFrame:
    """File stream with a declared schema that takes one slice per micro-batch."""
    return (spark.readStream.schema(arrivals.schema)
                 .option("maxFilesPerTrigger", arrivals.files_per_slice)
                 .parquet(arrivals.path))

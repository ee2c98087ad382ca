"""File scans: CSV, text, JSON, parquet, ORC; schema handling and tolerant reads."""

from __future__ import annotations

import functools
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def csv_inferred(spark: SparkSession, path: str, sampling_ratio: float | None = None) -> DataFrame:
    """Headered CSV with inferred types; a sampling ratio infers from a fraction of the rows."""
    reader = spark.read.options(header=True, inferSchema=True)
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def csv_declared(spark: SparkSession, path: str, schema: str | T.StructType,
                 header: bool = True) -> DataFrame:
    """CSV with a declared schema: no inference job."""
    return spark.read.schema(schema).option("header", header).csv(path)


def csv_headerless(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """CSV without header line; the default _c0, _c1, ... are renamed."""
    return spark.read.option("header", False).csv(path).toDF(*names)


def schema_to_string(schema: T.StructType) -> str:
    return schema.json()


def schema_from_string(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def schema_from_header(spark: SparkSession, path: str, separator: str = ",") -> T.StructType:
    """All-string schema from the first line of a CSV file; reads that line only."""
    header = spark.read.text(path).first()[0]
    return T.StructType([T.StructField(name.strip().strip('"'), T.StringType())
                         for name in header.split(separator)])


def json_permissive(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a malformed line is kept whole in _corrupt_record."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return (spark.read.schema(full)
                 .options(mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
                 .json(path))


def read_glob(spark: SparkSession, fmt: str, path: str, pattern: str) -> DataFrame:
    """Only the files of a mixed directory whose names match."""
    return spark.read.format(fmt).option("pathGlobFilter", pattern).load(path)


def parquet_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Union of the file schemas; a column missing in a file is null, a changed type is an error."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def parquet_existing(spark: SparkSession, paths: Sequence[str],
                     empty_schema: T.StructType | None = None) -> DataFrame:
    """Union of the paths that exist. Missing ones are skipped, every other error is raised."""
    found = []
    for path in paths:
        try:
            found.append(spark.read.parquet(path))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    if not found:
        if empty_schema is None:
            raise ValueError("none of the paths exists and no schema was given for an empty result")
        return spark.createDataFrame([], empty_schema)
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)


def source_files(df: DataFrame) -> DataFrame:
    return df.select(F.input_file_name().alias("file")).distinct()


def settings_like(spark: SparkSession, part: str) -> DataFrame:
    """Session settings whose name contains a text."""
    return spark.sql("SET -v").filter(F.col("key").contains(part))

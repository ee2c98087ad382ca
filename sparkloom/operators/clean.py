"""Cleaning: null handling, replacement, de-duplication, safe record parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by `order` (a total order). Combined on the map side, no window.

    Null keys form a group of their own, as in dropDuplicates.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def parse_records(lines: DataFrame, schema: T.StructType, value: str = "value",
                  separator: str = ",") -> DataFrame:
    """Text lines to typed columns: wrong field counts are dropped, fields trimmed, bad numbers null.

    The count of fields is tested by counting separators, so that a line is split only once.
    """
    separators = F.length(value) - F.length(F.replace(F.col(value), F.lit(separator), F.lit("")))
    complete = lines.filter(separators == (len(schema.fields) - 1) * len(separator))
    fields = F.split(F.col(value), _literal_pattern(separator), -1)
    columns = [F.trim(F.get("__fields", F.lit(i))).try_cast(field.dataType).alias(field.name)
               for i, field in enumerate(schema.fields)]
    return complete.select(fields.alias("__fields")).select(*columns)


def without_header(lines: DataFrame, header: str, value: str = "value") -> DataFrame:
    """Drop header lines wherever they landed (each file of a directory may have one)."""
    return lines.filter(F.col(value) != header)


def strip_quotes(column: Column) -> Column:
    return F.replace(column, F.lit('"'), F.lit(""))


def parse_json_blocks(blocks: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Blocks of JSON lines to rows: split, explode, parse; malformed lines go to _corrupt_record."""
    lines = blocks.select(F.explode(F.split(F.col(column), "\n")).alias("line"))
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json("line", with_corrupt,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    # inline, unlike `select("rec.*")`, keeps later filters from parsing each line a second time.
    return lines.select(F.inline(F.array(parsed)))


def keep_well_formed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def _literal_pattern(separator: str) -> str:
    """Regular expression for a literal; a single character keeps Java's fast split."""
    if len(separator) == 1:
        return separator if separator.isalnum() or separator in " ,;:\t" else "\\" + separator
    return "\\Q" + separator + "\\E"

"""Rows as INSERT statements, rendered by column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal(field: T.StructField) -> Column:
    """SQL-like literal of one column: long 2 -> 2L, timestamp -> ts:micros, string -> quoted.

    Quotes inside a string are doubled and a null is NULL, so every row gives a statement.
    """
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.LongType):
        text = F.concat(column.cast("string"), F.lit("L"))
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit("ts:"), F.unix_micros(column.cast("timestamp")).cast("string"))
    elif isinstance(field.dataType, T.StringType):
        text = F.concat(F.lit("'"), F.replace(column, F.lit("'"), F.lit("''")), F.lit("'"))
    else:
        raise TypeError(f"column {field.name}: type {field.dataType.simpleString()} is not supported")
    return F.coalesce(text, F.lit("NULL"))


def render_inserts(df: DataFrame, target: str, name: str = "statement") -> DataFrame:
    """One INSERT statement per row; an unsupported column type is an error before any job runs."""
    fields = df.schema.fields
    names = ", ".join(f.name for f in fields)
    values = F.concat_ws(", ", *[literal(f) for f in fields])
    return df.select(F.concat(F.lit(f"INSERT INTO TABLE {target} ({names}) VALUE ("), values,
                              F.lit(")")).alias(name))

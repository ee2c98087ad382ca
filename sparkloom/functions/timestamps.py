"""Time helpers. Input tables hold zone-less timestamps; streams need instants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_instant(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp"))


def as_ntz(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("timestamp_ntz")


def floor_to(column: Column | str, unit: str) -> Column:
    """Start of the minute, hour or day."""
    return F.date_trunc(unit, column)


def in_month(column: Column | str, year: int, month: int) -> Column:
    """Year-month test as a range on the bare column, so files and row groups can be skipped."""
    column = F.col(column) if isinstance(column, str) else column
    nxt = (year + month // 12, month % 12 + 1)
    start, end = f"{year:04d}-{month:02d}-01", f"{nxt[0]:04d}-{nxt[1]:02d}-01"
    return (column >= F.expr(f"timestamp_ntz'{start}'")) & (column < F.expr(f"timestamp_ntz'{end}'"))

"""UDFs, for the cases where the function itself is opaque. They take and give whole Arrow arrays."""

from __future__ import annotations

import socket
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRUCT_SCHEMA = T.StructType([T.StructField("first", T.LongType()),
                              T.StructField("second", T.LongType()),
                              T.StructField("third", T.LongType())])


@F.arrow_udf(T.LongType())
def plus_one(x: pa.Array) -> pa.Array:
    """Exact for every long; null stays null, an overflow is an error."""
    return pc.add_checked(x, pa.scalar(1, x.type))


@F.arrow_udf(T.LongType())
def divide_two_by(x: pa.Array) -> pa.Array:
    """2 div x as a total function: null where it cannot be computed."""
    whole = pa.types.is_integer(x.type)
    known = pc.if_else(pc.equal(x, pa.scalar(0, x.type)), pa.scalar(None, x.type), x)
    share = pc.divide(pa.scalar(2, x.type), known)
    if whole:
        return share.cast(pa.int64())
    return pc.trunc(pc.if_else(pc.is_finite(share), share, pa.scalar(None, x.type))).cast(pa.int64())


def safe_divide_two_by(x: Column) -> Column:
    """The same as an expression, which stays in generated code."""
    return F.when(x != 0, F.expr("2") / x).cast("long")


def describe(left: pa.Array, right: pa.Array) -> pa.Array:
    """left:right as text, a null written as None."""
    texts = [pc.fill_null(x.cast(pa.string()), "None") for x in (left, right)]
    return pc.binary_join_element_wise(*texts, ":")


@F.arrow_udf(T.StringType())
def describe_pair(left: pa.Array, right: pa.Array) -> pa.Array:
    """Called for every row, nulls included."""
    return describe(left, right)


def null_guarded(function: Callable[..., pa.Array], result: T.DataType) -> Callable[..., Column]:
    """A UDF that gives null for a null first argument; `function` never sees such rows.

    The guard is inside the UDF: around it, `when(x.isNotNull(), udf(x))` would not keep Spark from calling
    the function with nulls.
    """
    def call(*columns: pa.Array) -> pa.Array:
        given = pc.is_valid(columns[0])
        called = function(*[c.filter(given) for c in columns])
        place = pc.subtract(pc.cumulative_sum(given.cast(pa.int64())), 1)
        return called.take(pc.if_else(given, place, pa.scalar(None, pa.int64())))

    return F.arrow_udf(call, result)


describe_guarded = null_guarded(describe, T.StringType())


@F.arrow_udf(STRUCT_SCHEMA)
def powers(x: pa.Array) -> pa.Array:
    """x, its square and its cube; null gives nulls, an overflow is an error."""
    square = pc.multiply_checked(x, x)
    return pa.StructArray.from_arrays([x, square, pc.multiply_checked(square, x)], ["first", "second", "third"])


# Marked so that expanding the struct by fields does not run it once per field.
powers_once = powers.asNondeterministic()


@F.udf(returnType=T.StringType(), useArrow=True)
def _host_name():
    return socket.gethostname()


host_name = _host_name.asNondeterministic()

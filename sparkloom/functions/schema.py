"""Schema tools: renaming through all levels, CREATE TABLE text, JSON schema inference."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed type names of the two target systems.
CASSANDRA_TYPES = {"string": "text", "int": "int", "bigint": "bigint", "double": "double",
                   "boolean": "boolean", "timestamp": "timestamp"}
POSTGRES_TYPES = {"string": "VARCHAR (100)", "int": "INTEGER", "bigint": "BIGINT",
                  "double": "DOUBLE PRECISION", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def rename_nested(data_type: T.DataType, rename: Callable[[str], str]) -> T.DataType:
    """Same type with every struct field renamed, inside arrays and maps too."""
    if isinstance(data_type, T.StructType):
        return T.StructType([
            T.StructField(rename(f.name), rename_nested(f.dataType, rename), f.nullable, f.metadata)
            for f in data_type.fields])
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(rename_nested(data_type.elementType, rename), data_type.containsNull)
    if isinstance(data_type, T.MapType):
        return T.MapType(rename_nested(data_type.keyType, rename),
                         rename_nested(data_type.valueType, rename), data_type.valueContainsNull)
    return data_type


def with_renamed_schema(df: DataFrame, rename: Callable[[str], str]) -> DataFrame:
    """The frame with all names changed; nested names by a positional struct cast, no data is touched."""
    return df.select(*[F.col(f"`{f.name}`").cast(rename_nested(f.dataType, rename)).alias(rename(f.name))
                       for f in df.schema.fields])


def upper_names(df: DataFrame) -> DataFrame:
    return with_renamed_schema(df, str.upper)


# Digits that the whole-number types may have; each type is contained in those after it.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def keeps_values(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of one plain type is also one of the other."""
    a, b = source.simpleString(), target.simpleString()
    if a == b or isinstance(source, T.NullType):
        return True
    if a in _DIGITS and b in _DIGITS:
        return _DIGITS[a] <= _DIGITS[b]
    if isinstance(target, T.DecimalType):
        whole, scale = target.precision - target.scale, target.scale
        if isinstance(source, T.DecimalType):
            return source.precision - source.scale <= whole and source.scale <= scale
        return a in _DIGITS and _DIGITS[a] <= whole
    return (a, b) in {("float", "double"), ("tinyint", "float"), ("smallint", "float"), ("tinyint", "double"),
                      ("smallint", "double"), ("int", "double"), ("date", "timestamp_ntz")}


def _losses(source: T.DataType, target: T.DataType, at: str) -> list[str]:
    """Places where a conversion by name could change values."""
    if isinstance(source, T.StructType) and isinstance(target, T.StructType):
        known = {f.name.lower(): f for f in source.fields}
        return [loss for f in target.fields if f.name.lower() in known
                for loss in _losses(known[f.name.lower()].dataType, f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(source, T.ArrayType) and isinstance(target, T.ArrayType):
        return _losses(source.elementType, target.elementType, f"{at}[]")
    if isinstance(source, T.MapType) and isinstance(target, T.MapType):
        return (_losses(source.keyType, target.keyType, f"{at} keys")
                + _losses(source.valueType, target.valueType, f"{at} values"))
    return [] if keeps_values(source, target) else [f"{at}: {source.simpleString()} to {target.simpleString()}"]


def conform(df: DataFrame, target: str | T.StructType) -> DataFrame:
    """The frame brought to a target schema by name: columns and nested fields in the target's order, narrower
    types widened, nullable ones that are absent filled with nulls, others dropped.

    A missing field that may not be null, a nullable one where the target has none, and a type that could lose
    values are errors, raised before any row is read.
    """
    schema = T.StructType.fromDDL(target) if isinstance(target, str) else target
    losses = _losses(df.schema, schema, "")
    if losses:
        raise ValueError("values could be lost: " + "; ".join(losses))
    return df.to(schema)


def create_table_sql(schema: T.StructType, table: str, primary_key: str,
                     types: Mapping[str, str]) -> str:
    """CREATE TABLE text; a type without a mapping is an error."""
    columns = []
    for field in schema.fields:
        source = field.dataType.simpleString().removesuffix("_ntz")
        if source not in types:
            raise KeyError(f"no target type for {field.name}: {source}")
        suffix = " PRIMARY KEY" if field.name == primary_key else ""
        columns.append(f"{field.name} {types[source]}{suffix}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({','.join(columns)});"


def infer_json_schema(df: DataFrame, column: str | Column) -> str:
    """Schema of a JSON text column over all its rows, as a DDL type; malformed rows are ignored.

    One distributed aggregation; only the final type text reaches the driver. A column without any value
    gives an empty struct, a field that is always null a string.
    """
    text = F.col(column) if isinstance(column, str) else column
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(text)).alias("t")).first()["t"]
    if found is None or found == "VOID":
        return "STRUCT<>"
    # Names in backquotes are left alone, whatever they contain.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    parts[::2] = [re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT\b", "STRUCT", p)) for p in parts[::2]]
    return "".join(parts)

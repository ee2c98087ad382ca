"""Query registry: a key, a Spark query over the given tables and, where SQL can say it, an oracle."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.session import child_session

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}

_MODULES = ("sources", "sinks", "columns", "joins", "aggregates", "ordering", "scalars", "udfs",
            "layout", "streams")


def query(key: str, oracle: str | None = None,
          settings: Callable[[SparkSession], dict[str, str]] | None = None) -> Callable[[Query], Query]:
    """Register a query. It runs in a session of its own, with `settings`, so the caller's stays as it is."""
    def register(fn: Query) -> Query:
        if key in _queries:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Zone-less input timestamps are read as instants of this zone.
            own = {"spark.sql.session.timeZone": "UTC", **(settings(spark) if settings else {})}
            return fn(child_session(spark, own), str(sf_dir).rstrip("/"))

        _queries[key] = run
        if oracle:
            _oracles[key] = oracle
        return run
    return register


def load_all() -> None:
    for module in _MODULES:
        importlib.import_module(f"sparkloom.queries.{module}")


def queries() -> dict[str, Query]:
    load_all()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

"""Shared pieces of the registered queries and their DuckDB checks."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from encore.functions.dates import day_minus
from encore.session import scratch_path
from encore.sources.standins import standin, with_standins

# Analysis day of every registered query (last day of the driver's `events` table).
DAY = "20240130"
D1 = day_minus(DAY, 1)
D7 = day_minus(DAY, 7)
D30 = day_minus(DAY, 30)

QueryFn = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects ``name -> (spark query, DuckDB SQL or None)``."""

    def __init__(self) -> None:
        self.queries: dict[str, QueryFn] = {}
        self.oracle: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
        def deco(fn: QueryFn) -> QueryFn:
            if name in self.queries:
                raise ValueError(f"duplicate query {name}")
            self.queries[name] = fn
            if sql is not None:
                self.oracle[name] = sql
            return fn
        return deco

    def merge(self, other: "Registry") -> None:
        for k, v in other.queries.items():
            if k in self.queries:
                raise ValueError(f"duplicate query {k}")
            self.queries[k] = v
        self.oracle.update(other.oracle)


def S(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in table (see ``encore.sources.standins``)."""
    return standin(spark, sf_dir, name)


_SHARED: dict[tuple[str, str, str], DataFrame] = {}
_LOCK = threading.RLock()  # a shared table may rest on others


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries rest on, computed once per application and stored, as the
    daily jobs store it for the jobs after them."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        if key not in _SHARED:
            df = build()
            path = scratch_path(spark, f"shared-{name}")
            df.write.parquet(path)
            _SHARED[key] = spark.read.schema(df.schema).parquet(path)
        return _SHARED[key]


def sql_with(names: list[str], body: str) -> str:
    return with_standins(names, body)

"""Scans.  Day filters compare ``yyyyMMdd`` strings so they reach the scan as partition
filters (directory pruning) or parquet pushed filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.dates import check_day

DAY_COL = "data_dt"


def scan_table(spark: SparkSession, source: str, database: str | None = None) -> DataFrame:
    """A catalog table by name (in ``database`` when given), or a parquet path (``/`` or
    ``:`` in ``source``)."""
    if "/" in source or ":" in source:
        return spark.read.parquet(source)
    return spark.table(f"{database}.{source}" if database else source)


def scan_day(df: DataFrame, day: str, day_col: str = DAY_COL) -> DataFrame:
    """Rows of one day partition."""
    return df.where(F.col(day_col) == F.lit(check_day(day)))


def scan_day_range(df: DataFrame, start: str, end: str, day_col: str = DAY_COL) -> DataFrame:
    """Rows of ``[start, end]``, both ends inclusive."""
    return df.where(F.col(day_col).between(check_day(start), check_day(end)))


def scan_text_log(spark: SparkSession, path: str) -> DataFrame:
    """Raw log lines (one ``value`` column); globs and plain gzip files are accepted.
    Gzip is not splittable: land logs uncompressed or in many files for parallel reads."""
    return spark.read.text(path)

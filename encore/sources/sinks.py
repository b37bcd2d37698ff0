"""Sinks: day-partition overwrite, snapshot overwrite, keyed text fan-out, JDBC export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.dates import check_day
from encore.sources.scans import DAY_COL


def stamp_date(df: DataFrame, day: str, day_col: str = DAY_COL) -> DataFrame:
    """Prepend the analysis day as the first column."""
    return df.select(F.lit(check_day(day)).alias(day_col), *[F.col(c) for c in df.columns])


def write_day(df: DataFrame, path: str, day: str, day_col: str = DAY_COL) -> None:
    """Replace exactly one day partition (``path/data_dt=day``); other days stay.

    Dynamic partition overwrite makes a rerun of the same day idempotent and lets a job
    read earlier days of the table it writes."""
    out = df.drop(day_col).withColumn(day_col, F.lit(check_day(day)))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day_col).parquet(path))


def write_snapshot(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    df.write.mode("overwrite").parquet(path)


def fanout_by_key(df: DataFrame, key_col: str, value_col: str, path: str,
                  files_per_key: int | None = None) -> None:
    """One text output folder per key value (``path/key=...``), value only.

    Every task writes its own files, so two tasks with the same key never collide.
    Without ``files_per_key`` no shuffle is added, and each input task writes one file per
    key it sees. With it, rows are shuffled by (key, hash(value) mod ``files_per_key``):
    at most ``files_per_key`` files per key, and a hot key is split over that many tasks.
    The bucket is a hash of the row, not a random salt, so a retried task writes the same
    rows."""
    out = df.select(F.col(value_col).cast("string").alias("value"), F.col(key_col))
    if files_per_key:
        bucket = F.pmod(F.xxhash64("value"), F.lit(files_per_key))
        out = out.repartition(F.col(key_col), bucket)
    out.write.mode("overwrite").partitionBy(key_col).text(path)


def export_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None,
                mode: str = "overwrite", num_partitions: int | None = 8) -> None:
    """Write a mart to a relational table (overwrite replaces the whole table).

    Connection settings come from the caller.  Each Spark partition opens its own
    connection, so ``num_partitions`` (default 8; ``None`` keeps the DataFrame's
    partitioning) caps concurrent connections to the database; marts are small after
    aggregation."""
    out = df.repartition(num_partitions) if num_partitions else df
    out.write.mode(mode).jdbc(url, table, properties=dict(properties or {}))

"""Change ledger: which files each source day had when something was built from it.

A day's signature is a sum and an xor over hashes of (file name, size, time of change), made by
Spark from the file listing; no row of the table is read.  The ledger keeps, for each consumer
and source day, the signature that the consumer was built from.  A run compares: a day whose
files were added, rewritten or removed since has another signature, and is built anew with what
rests on it.  Signatures are taken before the build reads, so a file that changes meanwhile shows
in the next run.  Ledger rows are appended (a run that dies before keeps the old ones and builds
again), the newest row of a day counts, and many small appends are folded into one."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus
from encore.sources.scans import DAY_COL
from encore.sources.versions import publish_snapshot, version_path

LEDGER = "_ledger"
_SCHEMA = "consumer string, source string, data_dt string, signature string, built long"
GONE = "none"  # signature of a day without files


def _day_folders(spark: SparkSession, path: str, days: Iterable[str]) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for d in days:  # one look per day of the window, not a listing of all days of the table
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{DAY_COL}={check_day(d)}")
        if fs.exists(folder):
            found.append(f"{path}/{DAY_COL}={d}")
    return found


def file_manifest(spark: SparkSession, path: str, days: Iterable[str]) -> DataFrame:
    """(data_dt, file, size, changed) of the files of the named days of a day-partitioned table."""
    path = path.rstrip("/")
    folders = _day_folders(spark, path, days)
    if not folders:
        return spark.createDataFrame([], f"{DAY_COL} string, file string, size long, changed timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    day = F.regexp_extract("path", rf"/{DAY_COL}=(\d{{8}})/", 1)
    name = F.regexp_extract("path", rf"/{DAY_COL}=\d{{8}}/(.*)$", 1)
    return files.select(day.alias(DAY_COL), name.alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def day_signatures(spark: SparkSession, path: str, days: Iterable[str]) -> dict[str, str]:
    """Signature of every named day; one short row a day reaches the driver."""
    days = list(days)
    h = F.xxhash64("file", "size", "changed")
    rows = (file_manifest(spark, path, days).groupBy(DAY_COL)
            .agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 20)).alias("s")).collect())
    found = {r[DAY_COL]: f"{r['n']}:{r['size']}:{r['x']}:{r['s']}" for r in rows}
    return {d: found.get(d, GONE) for d in days}


class Ledger:
    """What each consumer was built from, under ``<root>/_ledger``."""

    def __init__(self, spark: SparkSession, root: str, fold_after: int = 50):
        self.spark, self.path, self.fold_after = spark, f"{root.rstrip('/')}/{LEDGER}", fold_after

    def _rows(self) -> DataFrame:
        """Newest row of each consumer, source and day: of the folded part and of what came after."""
        parts = [p for p in (version_path(self.spark, f"{self.path}/folded"), f"{self.path}/appended") if p]
        out = self.spark.createDataFrame([], _SCHEMA)
        for p in parts:
            try:
                out = out.unionByName(self.spark.read.schema(_SCHEMA).parquet(p))
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return out.groupBy("consumer", "source", DAY_COL).agg(F.max_by("signature", "built").alias("signature"), F.max("built").alias("built"))

    def built_from(self, consumer: str, source: str, days: Iterable[str]) -> dict[str, str]:
        rows = self._rows().where((F.col("consumer") == consumer) & (F.col("source") == source) & F.col(DAY_COL).isin(list(days)))
        return {r[DAY_COL]: r["signature"] for r in rows.collect()}

    def changed(self, consumer: str, source: str, now: dict[str, str]) -> list[str]:
        """Days that were built from other files than ``now``.  A day that the ledger does not know
        counts as changed only if there are files: nothing built from nothing is no change."""
        then = self.built_from(consumer, source, now)
        return sorted(d for d, s in now.items() if then.get(d, GONE) != s)

    def record(self, consumer: str, source: str, now: dict[str, str]) -> None:
        if not now:
            return
        rows = [(consumer, source, d, s, time.time_ns()) for d, s in sorted(now.items())]
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.path}/appended")
        self._fold()

    def _fold(self) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/appended")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        files = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
        if len(files) <= self.fold_after:
            return
        publish_snapshot(self._rows(), f"{self.path}/folded")
        for f in files:  # appended later than this listing stays; a row in both places counts once
            fs.delete(f, False)


def affected_days(changed: Iterable[str], until: str, back: int) -> list[str]:
    """Days up to ``until`` whose window ``[day-back, day]`` holds a changed day."""
    return sorted({day_minus(d, -k) for d in changed for k in range(back + 1) if day_minus(d, -k) <= until})

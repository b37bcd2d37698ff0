"""Atomic snapshots: a table is a series of whole versions, and a reader sees exactly one.

    <table>/v-000000000007-3f2a.../part-*.parquet    the rows of version 7
    <table>/_pointers/000000000007                    names that folder

A writer stores the rows under a fresh folder and, once all of them are there, puts the pointer
file with the next number in place by a rename that fails if the number is taken.  A job that
dies before leaves a folder that nothing points to, so readers keep the version before; of two
writers with the same number one fails and changes nothing.  Old versions are collected by count,
folders that no pointer names by age, so that a slow reader or writer of now is left alone."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

POINTERS = "_pointers"
KEEP = 2
ORPHAN_SECONDS = 24 * 3600


class VersionConflict(RuntimeError):
    """Another writer published the same version first."""


def _folder(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """(name, age in seconds) of what a folder holds; nothing if there is no such folder."""
    p, fs = _folder(spark, path)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), time.time() - s.getModificationTime() / 1000) for s in fs.listStatus(p)]


def _read_text(spark: SparkSession, path: str) -> str:
    p, fs = _folder(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, path: str) -> list[int]:
    """Published versions, oldest first."""
    return sorted(int(name) for name, _ in _listed(spark, f"{path}/{POINTERS}") if name.isdigit())


def version_path(spark: SparkSession, path: str, version: int | None = None) -> str | None:
    """Folder of a published version (the newest one if none is named); None if there is none."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    return f"{path}/{_read_text(spark, f'{path}/{POINTERS}/{version or known[-1]:012d}')}"


def read_snapshot(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest published version, or the one named."""
    folder = version_path(spark, path, version)
    if folder is None:
        raise FileNotFoundError(f"{path} has no published version" + ("" if version is None else f" {version}"))
    return spark.read.parquet(folder)


def publish_snapshot(df: DataFrame, path: str, keep: int = KEEP, expected: int | None = None) -> int:
    """Store ``df`` as the next version and return its number.

    ``df`` may read the version before: that one stays.  With ``expected`` the write only goes
    through if the newest version still is that one (0: none) when the pointer is set."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = expected if expected is not None else max(versions(spark, path), default=0)
    name = f"v-{before + 1:012d}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(f"{path}/{name}")
    _point(spark, path, before + 1, name)
    collect_versions(spark, path, keep)
    return before + 1


def _point(spark: SparkSession, path: str, version: int, name: str) -> None:
    target, fs = _folder(spark, f"{path}/{POINTERS}/{version:012d}")
    draft, _ = _folder(spark, f"{path}/{POINTERS}/.draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(name.encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    how = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(how, 1)
    options[0] = how.NONE  # never over a file that is there
    try:
        files.rename(draft, target, options)
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(target):
            raise VersionConflict(f"version {version} of {path} was published by another writer") from e
        raise


def collect_versions(spark: SparkSession, path: str, keep: int = KEEP, orphan_seconds: float = ORPHAN_SECONDS) -> list[str]:
    """Delete all versions but the newest ``keep``, and folders older than ``orphan_seconds``
    that no pointer names (left by writers that died).  Returns what was deleted."""
    known = versions(spark, path)
    old = known[:-keep] if keep > 0 else []
    named = {v: _read_text(spark, f"{path}/{POINTERS}/{v:012d}") for v in known}
    gone = []
    for v in old:  # the pointer first: no reader finds a version whose rows are going
        for name in (f"{POINTERS}/{v:012d}", named[v]):
            p, fs = _folder(spark, f"{path}/{name}")
            fs.delete(p, True)
        gone.append(named[v])
    for name, age in _listed(spark, path):
        if name.startswith("v-") and name not in named.values() and age > orphan_seconds:
            p, fs = _folder(spark, f"{path}/{name}")
            fs.delete(p, True)
            gone.append(name)
    return gone


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A folder that holds published versions, else the plain parquet table that lies there."""
    folder = version_path(spark, path)
    return spark.read.parquet(folder or path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True

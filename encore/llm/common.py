"""Helpers shared by the text operators: Arrow batches in bounded slices, word and span
hashes over a byte buffer in numpy, scratch tables in the shared folder."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.session import scratch_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SLICE_BYTES = 1 << 20  # text handled at once inside a task; a longer document is a slice of its own
BASE = np.uint64(0x9E3779B97F4A7C13)  # odd, 3 mod 8: multiplier of the rolling hash modulo 2**64
_POWERS: dict[str, np.ndarray] = {}


def importable(spark: SparkSession) -> None:
    """Python workers import this package by name; name its folder to them."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back (cuts the lineage;
    a lost executor re-reads files, it never recomputes)."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into row slices whose text column holds at most ``limit`` bytes (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each row; null is the empty text."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over all 64 bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


#: One random-looking 64-bit value for each byte.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE_BYTES + (1 << 16))
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, base in (("up", BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class RollingHash:
    """Polynomial hash modulo 2**64 of any span of a byte buffer, or of a sequence of 64-bit
    symbols, from one prefix sum."""

    def __init__(self, buffer: np.ndarray):
        up, self.down = _powers(len(buffer) + 1)
        self.prefix = np.zeros(len(buffer) + 1, dtype=np.uint64)
        values = BYTE_VALUES[buffer] if buffer.dtype == np.uint8 else buffer
        np.cumsum(values * up[: len(buffer)], out=self.prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64)
        return mix((self.prefix[ends] - self.prefix[starts]) * self.down[starts] + length * np.uint64(0x9FB21C651E98DF25))


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """White-space words of several documents laid out in one buffer (one space after each
    document).  ``doc`` gives each word's document, ``hash`` its 64-bit hash."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b" ".join(texts) + b" "
        self.buffer = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.buffer = LOWER[self.buffer]
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.text_end = np.cumsum(lengths + 1) - 1
        self.text_start = self.text_end - lengths
        space = _SPACE[self.buffer]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        self.rolling = RollingHash(self.buffer)
        self.hash = self.rolling.spans(self.start, self.end)
        self.doc = np.searchsorted(self.text_end, self.start)
        self.bounds = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self.count = np.diff(self.bounds)

    def __len__(self) -> int:
        return len(self.start)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, hash) of every n-gram that stays inside one document."""
        m = len(self) - n + 1
        if m <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        first = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        return first, gram_hash(self.hash, n)[first]


def gram_hash(symbols: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` symbols (Horner's rule over the whole array)."""
    m = len(symbols) - n + 1
    h = symbols[:m].copy()
    for k in range(1, n):
        h *= BASE
        h += symbols[k : k + m]
    return mix(h)


def per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def covered(first: np.ndarray, length: np.ndarray | int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a run [first, first + length)."""
    change = np.bincount(first, minlength=n + 1) - np.bincount(first + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def release(spark: SparkSession) -> None:
    """Let the JVM drop finished steps, so that Spark's cleaner removes their shuffle files."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame, name: str) -> DataFrame:
    """(v, root): each vertex of ``edges`` (columns a, b of one type) with the least vertex of
    its component, by alternating large-star and small-star steps.  A step is an aggregate and
    a join, so a vertex with many neighbours is never gathered anywhere."""
    spark = edges.sparkSession
    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return now.select(F.col("a").alias("v"), F.col("b").alias("root"))
        before = state
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        now = stored(small.select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
                     .unionAll(least.select("a", F.col("m").alias("b"))).distinct(), name)
        release(spark)

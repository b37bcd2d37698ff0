"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams.

Words are runs of ``[0-9a-z]`` and non-ASCII characters after lower-casing A-Z.  A window is
``n`` consecutive words of an item (the whole item where it has fewer).  Tasks scan every
window of each document against the sorted hash set and verify each hash hit word by word.

The benchmark is broadcast only while its text is under ``max_broadcast_bytes``; a larger one
is joined with the document windows by their 128-bit digests in a shuffle instead, with the
same result.

Edge cases: null or empty texts have no words, so they are never hit; an item without words
has no window.  An item with a null id still marks words, but no id is listed for it.  Each
input row, repeated or not, gives one output row.  Extra columns are ignored by
``contamination`` and kept as they are by ``decontaminate``."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import as_bytes, covered, importable, slices

WINDOW = 10
MAX_BROADCAST_BYTES = 16 << 20
SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, hits array<struct<start:int,stop:int>>")

# A-Z to a-z; every ASCII byte outside 0-9 and letters to a space; other bytes unchanged.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class WindowSet:
    """Distinct windows of the benchmark by length: sorted 64-bit hashes plus the word ids
    that verify a hit, and the items that contain each window."""

    def __init__(self, items: list[tuple[object, bytes | None]], n: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words(text)]
            size = min(n, len(ids))
            for i in range(len(ids) - size + 1 if size else 0):
                owners.setdefault(tuple(ids[i : i + size]), set()).add(None if item_id is None else str(item_id))
        rng = np.random.default_rng(20240130)
        self.factors = rng.integers(0, 2**63, size=max(n, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list[set]]] = {}
        for size in sorted({len(w) for w in owners}):
            table = [w for w in owners if len(w) == size]
            ids = np.array(table, dtype=np.int64)
            h = self.hashes(ids)
            order = np.argsort(h, kind="stable")
            self.by_length[size] = (h[order], ids[order], [owners[table[k]] for k in order])

    def hashes(self, ids: np.ndarray) -> np.ndarray:
        return ((ids.astype(np.uint64) + np.uint64(1)) * self.factors[: ids.shape[1]]).sum(axis=1, dtype=np.uint64)

    def matches(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window length, start positions, rows of the window table); -1 in ``ids`` never matches."""
        unknown = np.concatenate(([0], np.cumsum(ids < 0)))
        for size, (h, table, _) in self.by_length.items():
            if len(ids) < size:
                continue
            start = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(start):
                continue
            window = ids[start[:, None] + np.arange(size)]
            found = self.hashes(window)
            at = np.searchsorted(h, found)
            while len(start):
                live = at < len(h)
                live[live] = h[at[live]] == found[live]
                start, window, found, at = start[live], window[live], found[live], at[live]
                same = (table[at] == window).all(axis=1) if len(at) else np.zeros(0, dtype=bool)
                if same.any():
                    yield size, start[same], at[same]
                start, window, found, at = start[~same], window[~same], found[~same], at[~same] + 1


def _scan(known: WindowSet):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.vocabulary.get
        for batch in batches:
            for part in slices(batch, 1):
                ids: list[int] = []
                bounds = [0]
                for text in as_bytes(part.column(1)):
                    ids.extend([get(w, -1) for w in words(text)])
                    ids.append(-1)  # no window crosses documents
                    bounds.append(len(ids))
                yield _report(known, part.column(0), np.array(ids, dtype=np.int64), np.array(bounds))

    return run


def _report(known: WindowSet, doc_id: pa.Array, ids: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    hit = np.zeros(len(ids), dtype=bool)
    owners: dict[int, set] = {}
    for size, start, row in known.matches(ids):
        hit |= covered(start, size, len(ids))
        table = known.by_length[size][2]
        for d, r in {*zip((np.searchsorted(bounds, start, side="right") - 1).tolist(), row.tolist())}:
            owners.setdefault(d, set()).update(table[r])
    n_words = np.diff(bounds) - 1
    n_hit = np.diff(np.concatenate(([0], np.cumsum(hit)))[bounds])
    items, spans, digests = [], [], []
    nothing = hashlib.sha256(b"").hexdigest()
    for d in range(len(n_words)):
        if not n_hit[d]:
            items.append([]), spans.append([]), digests.append(nothing)
            continue
        listed = sorted(x for x in owners[d] if x is not None)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], hit[bounds[d] : bounds[d + 1]].view(np.int8)))))
        items.append(listed)
        spans.append([{"start": int(a), "stop": int(b)} for a, b in zip(edge[0::2], edge[1::2])])
        digests.append(hashlib.sha256(",".join(listed).encode()).hexdigest())
    return pa.record_batch({
        "doc_id": doc_id.cast(pa.int64()), "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array(digests, pa.string()),
        "contaminated": pa.array(n_hit > 0), "items": pa.array(items, pa.list_(pa.string())),
        "hits": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))})


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: word and hit counts, the items whose windows occur, and the hit
    word spans (end exclusive)."""
    spark = docs.sparkSession
    importable(spark)
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_broadcast_bytes:
        return _joined(docs, benchmark, n)
    items = [(r[0], (r[1] or "").encode()) for r in benchmark.select("item_id", "text").collect()]
    known = spark.sparkContext.broadcast(WindowSet(items, n))
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scan(known.value)(batches), SCHEMA)


def _windows_of_items(n: int):
    def run(batches):
        for batch in batches:
            out = {"digest": [], "size": [], "item": []}
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                w = words(text)
                size = min(n, len(w))
                for i in range(len(w) - size + 1 if size else 0):
                    out["digest"].append(xxhash.xxh3_128_digest(b" ".join(w[i : i + size])))
                    out["size"].append(size)
                    out["item"].append(None if item is None else str(item))
            yield pa.record_batch({"digest": pa.array(out["digest"], pa.binary()), "size": pa.array(out["size"], pa.int32()),
                                   "item": pa.array(out["item"], pa.string())})

    return run


def _windows_of_documents(lengths: list[int]):
    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 1 << 18):
                keys, sizes, starts, digests = [], [], [], []
                for key, text in zip(part.column(0).to_pylist(), as_bytes(part.column(1))):
                    w = words(text)
                    for size in lengths:
                        for i in range(len(w) - size + 1):
                            keys.append(key), sizes.append(size), starts.append(i)
                            digests.append(xxhash.xxh3_128_digest(b" ".join(w[i : i + size])))
                yield pa.record_batch({"key": pa.array(keys, pa.string()), "size": pa.array(sizes, pa.int32()),
                                       "start": pa.array(starts, pa.int32()), "digest": pa.array(digests, pa.binary())})

    return run


def _count_words(batches):
    for batch in batches:
        counts = [len(words(t)) for t in as_bytes(batch.column(2))]
        yield pa.record_batch({"doc_id": batch.column(0).cast(pa.int64()), "key": batch.column(1), "n_words": pa.array(counts, pa.int64())})


def _key() -> Column:
    return F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)


def _found(keyed: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """(key, start, size, item) of every benchmark window in the distinct texts."""
    known = benchmark.select("item_id", "text").mapInArrow(_windows_of_items(n), "digest binary, size int, item string").distinct()
    lengths = [r[0] for r in known.select("size").distinct().collect()]  # at most n values
    return (keyed.select("key", "text").dropDuplicates(["key"])
            .mapInArrow(_windows_of_documents(lengths), "key string, size int, start int, digest binary").join(known, ["digest", "size"]))


def _joined(docs: DataFrame, benchmark: DataFrame, n: int) -> DataFrame:
    """The same report through a shuffle join, for a benchmark too large to broadcast.  Rows
    with the same text share one scan (key: its SHA-256)."""
    keyed = docs.select("doc_id", _key().alias("key"), "text")
    found = _found(keyed, benchmark, n)
    hits = (found.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"),
                                     F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("runs")))
    merged = F.aggregate(
        "runs", F.array().cast("array<struct<start:int,stop:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["stop"] >= x["start"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1),
                                       F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"),
                                                        F.greatest(F.element_at(acc, -1)["stop"], x["stop"]).alias("stop")))))
        .otherwise(F.concat(acc, F.array(x))))
    counted = keyed.mapInArrow(_count_words, "doc_id long, key string, n_words long")
    none = F.array().cast("array<struct<start:int,stop:int>>")
    out = (counted.join(hits.select("key", "items", merged.alias("hits")), "key", "left")
           .withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).withColumn("hits", F.coalesce("hits", none)))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"])
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "items", "hits")


def _clean(known: WindowSet):
    def run(batches):
        get = known.vocabulary.get
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for part in slices(batch, text):
                keep = []
                for t in as_bytes(part.column(text)):
                    ids = np.array([get(w, -1) for w in words(t)], dtype=np.int64)
                    keep.append(next(known.matches(ids), None) is None)
                yield part.filter(pa.array(keep, pa.bool_()))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                  max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Documents in which no benchmark window occurs; every column is kept as it is."""
    spark = docs.sparkSession
    importable(spark)
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if size > max_broadcast_bytes:
        bad = _found(docs.select(_key().alias("key"), "text"), benchmark, n).select(F.col("key").alias("bad_key")).distinct()
        return docs.join(bad, _key() == F.col("bad_key"), "left_anti")
    items = [(r[0], (r[1] or "").encode()) for r in benchmark.select("item_id", "text").collect()]
    known = spark.sparkContext.broadcast(WindowSet(items, n))
    return docs.mapInArrow(lambda batches: _clean(known.value)(batches), docs.schema)

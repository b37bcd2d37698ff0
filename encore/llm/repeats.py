"""Windows that start at two places or more in the corpus, found without comparing pairs.

1. Every text is cut into fragments (``windows``).  A task counts equal fragments of its slice
   first and sends one row for each; rows meet by the fragment's key.
2. A fragment that occurs twice repeats as a whole.  A key with one fragment that occurs once
   holds nothing repeated.  Only keys with different fragments are open: one copy of each of
   those is sent to a shard, and the caller's index (suffix automaton, Burrows-Wheeler
   transform) says which windows of the shard occur again.
3. The marks of each text are gathered (at most as many as it has fragments and runs) and
   meet the texts by a 128-bit digest.

Copies of a text share a digest, so a third of all rows being equal costs one row per slice
in step 1 and nothing in step 2.  A key with more than ``HOT`` different fragments is not put
into one shard: its windows are counted one by one by digest, partially aggregated, which
gives the same answer.  Nothing is sampled, dropped or capped."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import RollingHash, Words, as_bytes, importable, release, slices, stored
from encore.llm.windows import Fragments, fragments

FOLD_BYTES = 4 << 20  # text in which equal fragments fold into one row before the shuffle
HOT = 20_000
SHARD_BYTES = 1 << 20
REDUCE_ROWS = 1 << 19
FULL, OPEN = 1, 2


@dataclass(frozen=True)
class Unit:
    """What a window is made of: ``words`` or ``bytes``, its length and the anchor's."""

    kind: str
    length: int
    k: int
    parts: int = 2


class Laid:
    """Texts of a slice laid out as symbols, with their fragments."""

    def __init__(self, texts: list[bytes], unit: Unit):
        self.unit = unit
        if unit.kind == "words":
            self.words = Words(texts)
            self.rolling = RollingHash(self.words.hash)
            self.bounds = self.words.bounds
            owner_end = self.bounds[self.words.doc + 1]
        else:
            sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
            self.bytes = np.frombuffer(b"".join(texts), dtype=np.uint8)
            self.rolling = RollingHash(self.bytes)
            self.bounds = np.concatenate(([0], np.cumsum(sizes)))
            owner_end = np.repeat(self.bounds[1:], sizes)
        self.size = int(self.bounds[-1])
        self.found: Fragments = fragments(self.rolling, self.size, owner_end, unit.length, unit.k, unit.parts)
        self.doc = np.searchsorted(self.bounds, self.found.first, side="right") - 1
        self.head = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # first fragment of each text
        self.ordinal = np.arange(len(self.doc)) - self.head[self.doc] if len(self.doc) else self.doc

    def content(self, start: int, stop: int) -> bytes:
        if self.unit.kind == "words":
            return b" ".join([self.words.buffer[a:b].tobytes() for a, b in zip(self.words.start[start:stop], self.words.end[start:stop])])
        return self.bytes[start:stop].tobytes()


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null as empty) and the text's digest in two numbers."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(7), "text"))


ROW = "route long, kind int, anchor long, frag long, n long, k1 long, k2 long, ord int"


def _rows(unit: Unit):
    """One row for each different fragment of a slice (kind 0); fragments that the slice holds
    twice are known to repeat, so their places (kind 1) need not meet by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, FOLD_BYTES):
                laid = Laid(as_bytes(part.column(0)), unit)
                f = laid.found
                if not len(f.first):
                    continue
                k1, k2 = (part.column(c).to_numpy()[laid.doc] for c in (1, 2))
                _, lead, back, n = np.unique(f.hash, return_index=True, return_inverse=True, return_counts=True)
                twice = np.flatnonzero(n[back] > 1)
                place = (k1[twice] ^ (laid.ordinal[twice] * np.int64(0x5851F42D4C957F2D))).astype(np.int64)
                none = np.zeros(len(twice), dtype=np.int64)
                yield pa.record_batch({
                    "route": np.concatenate((f.anchor[lead], place)),
                    "kind": np.concatenate((np.zeros(len(lead), np.int32), np.ones(len(twice), np.int32))),
                    "anchor": np.concatenate((f.anchor[lead], none)), "frag": np.concatenate((f.hash[lead], f.hash[twice])),
                    "n": np.concatenate((n, none)).astype(np.int64), "k1": np.concatenate((k1[lead], k1[twice])),
                    "k2": np.concatenate((k2[lead], k2[twice])),
                    "ord": np.concatenate((laid.ordinal[lead], laid.ordinal[twice])).astype(np.int32)})

    return run


JUDGED = "k1 long, k2 long, ord int, frag long, anchor long, n long, state int, ship boolean, hot boolean"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (kind, anchor, frag): which fragments repeat, which keys are open.
    Blocks are cut between anchors."""
    held: list[pa.Table] = []
    rows = 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= REDUCE_ROWS:
            block = pa.concat_tables(held)
            kind, anchor = block["kind"].to_numpy(), block["anchor"].to_numpy()
            edge = np.flatnonzero((anchor[1:] != anchor[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 1))
            cut = int(edge[-1]) + 1 if len(edge) else 0
            if cut:
                yield _judged(block.slice(0, cut))
            held, rows = [block.slice(cut)], block.num_rows - cut
    if rows:
        yield _judged(pa.concat_tables(held))


def _judged(block: pa.Table) -> pa.RecordBatch:
    col = {c: block[c].to_numpy() for c in ("kind", "anchor", "frag", "n", "k1", "k2", "ord")}
    known = col["kind"] == 1
    a, h = col["anchor"], col["frag"]
    new = np.concatenate(([True], (a[1:] != a[:-1]) | (h[1:] != h[:-1]) | known[1:]))
    group = np.cumsum(new) - 1
    total = np.bincount(group, weights=col["n"]).astype(np.int64)
    lead_anchor = np.concatenate(([True], (a[1:] != a[:-1]) | known[1:]))
    anchor_group = np.cumsum(lead_anchor) - 1
    different = np.bincount(anchor_group, weights=new).astype(np.int64)[anchor_group]
    n = total[group]
    full = known | (n > 1)
    contested = ~known & (different > 1)
    keep = np.flatnonzero(full | contested)
    ship = contested & new
    # A fragment that its slice holds twice has its places in rows of kind 1.
    state = np.where(known, FULL, np.where(col["n"] > 1, 0, np.where(full, FULL, OPEN)))
    return pa.record_batch({
        "k1": col["k1"][keep], "k2": col["k2"][keep], "ord": col["ord"][keep], "frag": h[keep], "anchor": a[keep], "n": n[keep],
        "state": state[keep].astype(np.int32), "ship": ship[keep], "hot": (ship & (different > HOT))[keep]})


def _shipped(unit: Unit, hot: bool):
    """Contents of the fragments of open keys (or, for hot keys, digests of their windows)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0, FOLD_BYTES):
                laid = Laid(as_bytes(part.column(0)), unit)
                wanted = part.column(1)
                items = wanted.flatten()
                doc = np.repeat(np.arange(len(wanted)), np.diff(wanted.offsets.to_numpy()))
                ordinal, frag, anchor, n = (items.field(c).to_numpy() for c in ("ord", "frag", "anchor", "n"))
                at = laid.head[doc] + ordinal
                first, last = laid.found.first[at], laid.found.last[at]
                if hot:
                    count = last - first + 1
                    owner = np.repeat(np.arange(len(at)), count)
                    off = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
                    start = first[owner] + off
                    half = unit.length // 2
                    yield pa.record_batch({"d1": laid.rolling.spans(start, start + half).astype(np.int64),
                                           "d2": laid.rolling.spans(start + half, start + unit.length).astype(np.int64),
                                           "frag": frag[owner], "off": off.astype(np.int32), "n": n[owner]})
                else:
                    body = [laid.content(int(i), int(j) + unit.length) for i, j in zip(first, last)]
                    yield pa.record_batch({"anchor": anchor, "frag": frag, "n": n, "content": pa.array(body, pa.binary())})

    return run


VERDICT = "frag long, a int, b int"


def _sharded(judge: Callable[[list[bytes], list[int]], list[np.ndarray]]):
    """Rows sorted by (anchor, frag) in shards of about ``SHARD_BYTES``, cut between anchors; the
    judge returns for each fragment which windows occur again."""

    def close(shard: list[tuple]) -> pa.RecordBatch:
        frags: list[int] = []
        runs: list[tuple[int, int]] = []
        for (_, frag, n, _), mask in zip(shard, judge([s[3] for s in shard], [s[2] for s in shard])):
            if n > 1:
                continue  # repeats as a whole; it was here for the others
            edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            runs += [(int(x), int(y) - 1) for x, y in zip(edge[0::2], edge[1::2])]
            frags += [frag] * (len(edge) // 2)
        return pa.record_batch({"frag": pa.array(frags, pa.int64()), "a": pa.array([x for x, _ in runs], pa.int32()),
                                "b": pa.array([y for _, y in runs], pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if shard and row[:2] == shard[-1][:2]:
                    continue  # the same fragment from a repeated row
                if size >= SHARD_BYTES and row[0] != shard[-1][0]:
                    yield close(shard)
                    shard, size = [], 0
                shard.append(row)
                size += len(row[3])
        if shard:
            yield close(shard)

    return run


def marked(docs: DataFrame, unit: Unit, judge: Callable[[list[bytes], list[int]], list[np.ndarray]], name: str, hot: int | None = None) -> DataFrame:
    """doc_id, text and ``marks``: array of (fragment ordinal, first and last window offset that
    repeats; -1 as last: all of it).  Null where nothing repeats."""
    importable(docs.sparkSession)
    texts = keyed(docs)
    rows = texts.select("text", "k1", "k2").mapInArrow(_rows(unit), ROW)
    judged = stored(rows.repartition("route").sortWithinPartitions("kind", "anchor", "frag").mapInArrow(_judge, JUDGED), f"{name}-judged")
    release(docs.sparkSession)

    ship = judged.where("ship").groupBy("k1", "k2").agg(  # at most the fragments of one text
        F.collect_list(F.struct("ord", "frag", "anchor", "n", "hot")).alias("wanted"))
    side = texts.select("text", "k1", "k2", "doc_id")

    def sent(is_hot: bool, schema: str) -> DataFrame:
        wanted = F.filter("wanted", lambda x: x["hot"] == is_hot)
        held = side.join(ship, ["k1", "k2"]).select("text", wanted.alias("wanted")).where(F.size("wanted") > 0)
        return held.mapInArrow(_shipped(unit, is_hot), schema)

    shards = sent(False, "anchor long, frag long, n long, content binary")
    verdict = (shards.repartition("anchor").sortWithinPartitions("anchor", "frag").mapInArrow(_sharded(judge), VERDICT))
    if judged.where("hot").limit(1).count():
        each = sent(True, "d1 long, d2 long, frag long, off int, n long").dropDuplicates(["frag", "off"])
        again = each.groupBy("d1", "d2").agg(F.sum("n").alias("total")).where("total > 1")
        verdict = verdict.unionByName(each.where("n = 1").join(again, ["d1", "d2"]).select("frag", F.col("off").alias("a"), F.col("off").alias("b")))
    opened = judged.where(F.col("state") == OPEN).select("k1", "k2", "ord", "frag").join(verdict, "frag").select("k1", "k2", "ord", "a", "b")
    whole = judged.where(F.col("state") == FULL).select("k1", "k2", "ord", F.lit(0).alias("a"), F.lit(-1).alias("b"))
    marks = whole.unionByName(opened).distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("ord", "a", "b")).alias("marks"))
    marks = stored(marks, f"{name}-marks")  # so that the shuffled texts of this step are gone before those of the next
    release(docs.sparkSession)
    return side.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks")


def removed(laid: Laid, marks: pa.ListArray) -> np.ndarray:
    """Which symbols of the slice a repeated window covers."""
    unit = laid.unit
    items = marks.flatten()
    if not len(items):
        return np.zeros(laid.size, dtype=bool)
    sizes = np.array([len(m) if m.is_valid else 0 for m in marks])
    doc = np.repeat(np.arange(len(marks)), sizes)
    ordinal, a, b = (items.field(c).to_numpy() for c in ("ord", "a", "b"))
    at = laid.head[doc] + ordinal
    first, last = laid.found.first[at], laid.found.last[at]
    start = first + a
    stop = np.where(b < 0, last, first + b) + unit.length
    change = np.bincount(start, minlength=laid.size + 1) - np.bincount(stop, minlength=laid.size + 1)
    return np.cumsum(change[: laid.size]) > 0

"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

A string of ``length`` bytes that starts at two places or more is removed everywhere.
``repeats`` brings the fragments that may share such strings into one shard.  There the
suffixes are sorted, and intervals of the transform are extended backwards breadth first: level
by level the common prefixes of neighbouring suffixes come out by increasing value.  The
search stops at ``length`` levels; neighbours without a value by then share at least
``length`` bytes, so both start a repeated string.

Edge cases: null and empty texts and texts shorter than ``length`` bytes keep everything.
Repeated rows are copies of each other, so they repeat.  Kept bytes may not be UTF-8, since a
removed run may end inside a character.  Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.common import as_bytes, slices
from encore.llm.repeats import Laid, Unit, marked, removed

LENGTH = 400
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_END = 0xFF  # between fragments; no byte of UTF-8


def suffix_order(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` bytes at least: eight bytes at once, then
    doubling, each time only where suffixes are still equal."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8))).astype(np.uint64)
    word = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | padded[k : k + n]
    order = np.argsort(word, kind="stable")
    s = word[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    width = 8
    while width < depth:
        closed = new & np.concatenate((new[1:], [True]))
        at = np.flatnonzero(~closed)  # places in the order of suffixes that are not alone
        if not len(at):
            break
        suffix = order[at]
        group = rank[suffix]
        beyond = rank[np.minimum(suffix + width, n)] + 1
        by = np.argsort(group * np.int64(n + 2) + beyond, kind="stable")
        suffix, group, beyond = suffix[by], group[by], beyond[by]
        order[at] = suffix
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (beyond[1:] != beyond[:-1])))
        new[at] = fresh
        rank[suffix] = np.maximum.accumulate(np.where(fresh, at, 0))
        width *= 2
    return order


def far_neighbours(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place j of the suffix order whether suffixes j-1 and j share ``length`` bytes."""
    n = len(data)
    bwt = data[order - 1]  # the byte before each suffix; the first suffix wraps around
    by = np.argsort(bwt, kind="stable")
    back = np.empty(n, dtype=np.int64)
    back[by] = np.arange(n)  # where the suffix goes when its byte is put in front
    edge = np.concatenate(([True], bwt[1:] != bwt[:-1]))
    run = np.cumsum(edge) - 1
    begin = np.flatnonzero(edge)
    end = np.concatenate((begin[1:], [n]))
    unset = np.ones(n + 1, dtype=bool)
    unset[[0, n]] = False
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):
        if not len(lo):
            break
        r0, r1 = run[lo], run[hi - 1]
        one = r0 == r1
        a, b = [back[lo[one]]], [back[hi[one] - 1] + 1]
        if not one.all():
            l, h, first = lo[~one], hi[~one], r0[~one]
            count = r1[~one] - first + 1
            owner = np.repeat(np.arange(len(l)), count)
            runs = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            start, stop = np.maximum(begin[runs], l[owner]), np.minimum(end[runs], h[owner])
            key = owner * 256 + bwt[start]
            sort = np.argsort(key, kind="stable")
            key, start, stop = key[sort], start[sort], stop[sort]
            head = np.concatenate(([True], key[1:] != key[:-1]))
            tail = np.concatenate((head[1:], [True]))
            a.append(back[start[head]])
            b.append(back[stop[tail] - 1] + 1)
        lo, hi = np.concatenate(a), np.concatenate(b)
        fresh = unset[hi]
        lo, hi = lo[fresh], hi[fresh]
        unset[hi] = False
    return unset[:n]


def repeated_starts(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For each fragment which of its windows of ``length`` bytes occur again in the shard."""
    data = np.frombuffer(b"\xff".join(contents) + b"\xff", dtype=np.uint8)
    order = suffix_order(data, length)
    far = far_neighbours(data, order, length)
    hit = np.zeros(len(data), dtype=bool)
    at = np.flatnonzero(far)
    hit[order[at]] = True
    hit[order[at - 1]] = True
    out, start = [], 0
    for c in contents:
        out.append(hit[start : start + max(0, len(c) - length + 1)])
        start += len(c) + 1
    return out


def judge(length: int):
    def run(contents: list[bytes], weights: list[int]) -> list[np.ndarray]:
        return repeated_starts(contents, length)

    return run


def _kept(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                laid = Laid(as_bytes(part.column(1)), unit)
                gone = removed(laid, part.column(2))
                before = np.concatenate(([0], np.cumsum(gone)))
                spans, kept = [], []
                for x, y in zip(laid.bounds[:-1], laid.bounds[1:]):
                    mask = gone[x:y]
                    spans.append(int(np.count_nonzero(mask[1:] & ~mask[:-1])) + bool(len(mask) and mask[0]))
                    kept.append(laid.bytes[x:y][~mask].tobytes())
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "n_bytes": pa.array(np.diff(laid.bounds), pa.int64()),
                    "n_removed": pa.array(np.diff(before[laid.bounds]), pa.int64()), "n_spans": pa.array(spans, pa.int64()),
                    "kept": pa.array(kept, pa.binary())})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: byte counts, removed runs and the bytes that stay."""
    unit = Unit("bytes", length, max(1, min(32, length // 4)))
    return marked(docs, unit, judge(length), "bytes").mapInArrow(_kept(unit), SCHEMA)

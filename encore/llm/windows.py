"""Fragments: a partition of all windows of a text into runs that can be compared by key.

Every window of ``length`` symbols holds an anchor: the ``k``-gram of least hash in it (the
leftmost of equal ones).  The anchor depends on the window's content alone, so equal windows
have equal anchors.  The windows that share one anchor occurrence start at consecutive
positions.  They are cut into ``parts`` runs by the anchor's offset in the window, so that the
windows of a run hold a longer common core than the ``k``-gram: the run's key.  The symbols a
run covers are a fragment.  Each window lies in exactly one fragment, and two equal windows
always lie in fragments with the same key."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from encore.llm.common import RollingHash, mix


@dataclass
class Fragments:
    """First and last window start of each fragment, its anchor's hash and its own hash."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray


def _sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` consecutive keys: block-wise prefix and suffix minima."""
    n = len(keys)
    pad = -n % width
    top = np.iinfo(np.uint64).max
    blocks = np.concatenate((keys, np.full(pad, top, dtype=np.uint64))).reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[: n - width + 1], up[width - 1 : n])


def fragments(rolling: RollingHash, size: int, owner_end: np.ndarray, length: int, k: int, parts: int) -> Fragments:
    """Fragments of a buffer of ``size`` symbols; ``owner_end[i]`` is the end of the text that
    holds symbol i (exclusive), so that no window crosses texts."""
    empty = np.zeros(0, dtype=np.int64)
    if size < length:
        return Fragments(empty, empty, empty, empty)
    at = np.arange(size - k + 1)
    keys = (rolling.spans(at, at + k) & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    chosen = (_sliding_argmin(keys, length - k + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    start = np.flatnonzero(np.arange(len(chosen)) + length <= owner_end[: len(chosen)])
    if not len(start):
        return Fragments(empty, empty, empty, empty)
    chosen = chosen[start]
    step = -(-(length - k + 1) // parts)
    part = (chosen - start) // step
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (part[1:] != part[:-1]) | (start[1:] != start[:-1] + 1)))
    head = np.flatnonzero(new)
    first = start[head]
    last = start[np.concatenate((head[1:], [len(start)])) - 1]
    # What every window with this anchor and part holds.
    core = chosen[head] - part[head] * step
    core_end = np.minimum(chosen[head] - (part[head] + 1) * step + 1 + length, core + length)
    anchor = rolling.spans(core, core_end) ^ mix(part[head].astype(np.uint64) + np.uint64(1))
    return Fragments(first, last, anchor.astype(np.int64), rolling.spans(first, last + length).astype(np.int64))

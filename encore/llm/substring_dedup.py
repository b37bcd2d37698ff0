"""Substring dedup with suffix automata of reference shards.

A word window that starts at two places or more is removed everywhere.  ``repeats`` brings the
fragments that may share windows into one reference shard; the shard's suffix automaton
counts the occurrences of every substring, and streaming each fragment through it gives, for
every word, the longest suffix that the shard holds: where the last ``length`` words occur
twice, the window that ends there is repeated.

The method names a broadcast of the automata to all documents.  The references are the corpus
itself here, so their number grows with it, and a broadcast of each shard to all documents
would cost shards times corpus; the fragments travel to the shard instead (see README).

Edge cases: null and empty texts and texts shorter than a window keep all words.  Repeated
rows are copies of each other, so their windows repeat.  Words are compared as they are.
Extra columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.common import as_bytes, slices
from encore.llm.repeats import Laid, Unit, marked, removed

LENGTH = 35
SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


class SuffixAutomaton:
    """Suffix automaton of several sequences with the number of places of each substring."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.places = [0]

    def _state(self, length: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.places.append(0)
        return len(self.length) - 1

    def _split(self, p: int, c: object, q: int) -> int:
        """A copy of state q for the strings that end p's longest one followed by c."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, symbols: list, weight: int) -> None:
        last = 0
        nxt, link, length, places = self.next, self.link, self.length, self.places
        for c in symbols:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            places[last] += weight

    def finish(self) -> None:
        """Sum the places of each state into its suffix link, longest first."""
        for s in np.argsort(np.array(self.length), kind="stable")[:0:-1].tolist():
            if self.link[s] >= 0:
                self.places[self.link[s]] += self.places[s]

    def repeated(self, symbols: list, size: int) -> np.ndarray:
        """For each window of ``size`` symbols whether it has two places or more."""
        out = np.zeros(max(0, len(symbols) - size + 1), dtype=bool)
        nxt, link, length, places = self.next, self.link, self.length, self.places
        state = held = 0
        for i, c in enumerate(symbols):
            while c not in nxt[state]:  # not for a sequence that was added
                state = link[state]
                if state < 0:
                    break
                held = length[state]
            if state < 0:
                state = held = 0
                continue
            state = nxt[state][c]
            held += 1
            while length[link[state]] >= size:
                state = link[state]
            held = min(held, length[state])
            if held >= size and places[state] > 1:
                out[i - size + 1] = True
        return out


def judge(size: int):
    def run(contents: list[bytes], weights: list[int]) -> list[np.ndarray]:
        ids: dict[bytes, int] = {}
        rows = [[ids.setdefault(w, len(ids)) for w in c.split(b" ")] for c in contents]
        shard = SuffixAutomaton()
        for row, weight in zip(rows, weights):
            shard.add(row, weight)
        shard.finish()
        return [shard.repeated(row, size) if weight == 1 else np.zeros(0, dtype=bool) for row, weight in zip(rows, weights)]

    return run


def _kept(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                laid = Laid(as_bytes(part.column(1)), unit)
                gone = removed(laid, part.column(2))
                keep = np.flatnonzero(~gone)
                cut = np.searchsorted(keep, laid.bounds)
                data = laid.words.buffer.tobytes()
                start, end = laid.words.start[keep].tolist(), laid.words.end[keep].tolist()
                kept = [b" ".join([data[start[i] : end[i]] for i in range(x, y)]) for x, y in zip(cut[:-1], cut[1:])]
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "n_words": pa.array(laid.words.count, pa.int64()),
                    "n_removed": pa.array(np.diff(np.concatenate(([0], np.cumsum(gone)))[laid.bounds]), pa.int64()),
                    "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: word counts and the words that no repeated window covers."""
    unit = Unit("words", length, max(1, min(8, length // 4)))
    return marked(docs, unit, judge(length), "words").mapInArrow(_kept(unit), SCHEMA)

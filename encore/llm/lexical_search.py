"""Ranked lexical search of many queries at once by common-subexpression evaluation.

Every item (query) is a sum of term impacts over its term multiset, so items that share terms
share parts of their sums.  The plan mines them: the terms of an item stand in one order (terms
of many items first), pairs of neighbours that several items hold become a node, again and again,
until no pair is shared.  A node is the sum of two earlier rows, so the nodes form a DAG.  For a
block of documents the rows of the terms are filled once, each node is added up once, level by
level, and each item adds its remaining few rows.

Data movement: the documents are tokenised once into a forward index of the items' vocabulary
(written, a fraction of the text); document frequencies are partial sums of tasks; every task
keeps its best documents of each item, and only those are shuffled.  The items are broadcast only
in blocks of a checked size: a larger query set is searched block by block, with the same result.

Edge cases: null and empty texts have no terms; such an item has no result, such a document is in
none and is not counted.  Equal scores go by document id, a null id last.  Each row is a document
or an item of its own, whatever its id; copies of an item's text are searched once.  Without
documents or items there are no rows.  Other columns are ignored."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.llm.common import as_bytes, importable, slices, stored

DEPTH = 10
MAX_BROADCAST_BYTES = 16 << 20
CELLS = 1 << 22  # sums held at once while a block of documents is scored

# A-Z to a-z; every ASCII byte outside digits and letters to a space; other bytes unchanged.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


class QueryPlan:
    """Vocabulary of the items and the DAG that adds up their scores.  Rows below ``n_terms`` are
    terms, row ``n_terms + k`` is ``left[k] + right[k]``; ``rows[i]`` are the rows of item i."""

    def __init__(self, texts: list[bytes]):
        self.vocabulary: dict[bytes, int] = {}
        lists = [[self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms(x)] for x in texts]
        self.n_terms = len(self.vocabulary)
        held = Counter(t for x in lists for t in set(x))
        rows = [sorted(x, key=lambda t: (-held[t], t)) for x in lists]
        pairs: list[tuple[int, int]] = []
        while True:
            holders = Counter(p for x in rows for p in {*zip(x, x[1:])})
            shared = {p: n for p, n in holders.items() if n > 1}
            if not shared:
                break
            names: dict[tuple[int, int], int] = {}
            rows = [self._fold(x, shared, names, self.n_terms + len(pairs)) for x in rows]
            pairs += names
        rows, pairs = self._inlined(rows, pairs)
        self.rows = rows
        self.left, self.right = (np.array([p[k] for p in pairs], dtype=np.int64) for k in range(2))
        level = [0] * (self.n_terms + len(pairs))
        for k, (a, b) in enumerate(pairs):
            level[self.n_terms + k] = 1 + max(level[a], level[b])
        depth = np.array(level[self.n_terms :], dtype=np.int64)
        self.levels = [np.flatnonzero(depth == d) for d in range(1, int(depth.max(initial=0)) + 1)]
        filled = [k for k, x in enumerate(rows) if x]
        self.items = np.array(filled, dtype=np.int64)
        self.flat = np.array([r for k in filled for r in rows[k]], dtype=np.int64)
        self.offsets = np.concatenate(([0], np.cumsum([len(rows[k]) for k in filled])))[:-1].astype(np.int64)

    @staticmethod
    def _fold(x: list[int], shared: dict[tuple[int, int], int], names: dict[tuple[int, int], int], base: int) -> list[int]:
        """Replace pairs that are held by more items than the pairs that overlap them."""
        weight = [shared.get(p, 0) for p in zip(x, x[1:])]
        out, k = [], 0
        while k < len(x):
            if k < len(weight) and weight[k] and (k + 1 >= len(weight) or weight[k] >= weight[k + 1]):
                out.append(base + names.setdefault((x[k], x[k + 1]), len(names)))
                k += 2
            else:
                out.append(x[k])
                k += 1
        return out

    def _inlined(self, rows: list[list[int]], pairs: list[tuple[int, int]]) -> tuple[list[list[int]], list[tuple[int, int]]]:
        """Nodes that only one place uses save nothing: put their parts in that place if it is an item."""
        n, uses = self.n_terms, Counter(r for x in rows for r in x)
        uses.update(r for p in pairs for r in p)

        def opened(x: list[int]) -> list[int]:
            out, todo = [], list(reversed(x))
            while todo:
                r = todo.pop()
                if r >= n and uses[r] == 1:
                    todo += reversed(pairs[r - n])
                else:
                    out.append(r)
            return out

        rows = [opened(x) for x in rows]
        used, todo = set(), [r for x in rows for r in x if r >= n]
        while todo:
            r = todo.pop()
            if r not in used:
                used.add(r)
                todo += [s for s in pairs[r - n] if s >= n]
        name = {r: n + k for k, r in enumerate(sorted(used))}
        return [[name.get(r, r) for r in x] for x in rows], [tuple(name.get(s, s) for s in pairs[r - n]) for r in sorted(used)]

    def additions(self) -> int:
        """Row additions for one block of documents."""
        return len(self.left) + sum(max(0, len(x) - 1) for x in self.rows)

    def scores(self, impact: np.ndarray) -> np.ndarray:
        """Items x documents from terms x documents."""
        sums = np.empty((self.n_terms + len(self.left), impact.shape[1]), dtype=np.int64)
        sums[: self.n_terms] = impact
        for nodes in self.levels:
            sums[self.n_terms + nodes] = sums[self.left[nodes]] + sums[self.right[nodes]]
        return np.add.reduceat(sums[self.flat], self.offsets, axis=0) if len(self.flat) else np.zeros((0, impact.shape[1]), dtype=np.int64)


def _indexed(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, size = vocabulary.get, max(1, len(vocabulary))
        for batch in batches:
            for part in slices(batch, 1):
                found = [terms(x) for x in as_bytes(part.column(1))]
                n = np.array([len(x) for x in found], dtype=np.int64)
                ids = np.fromiter((get(w, -1) for x in found for w in x), dtype=np.int64, count=int(n.sum()))
                key = (np.repeat(np.arange(len(n)), n) * size + ids)[ids >= 0]
                key, tf = np.unique(key, return_counts=True)
                doc, term = np.divmod(key, size)
                offsets = pa.array(np.searchsorted(doc, np.arange(len(n) + 1)), pa.int32())
                rows = pa.record_batch({"doc_id": part.column(0).cast(pa.int64()), "n": pa.array(n),
                                        "terms": pa.ListArray.from_arrays(offsets, pa.array(term, pa.int32())),
                                        "tfs": pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))})
                yield rows.filter(pa.array(n > 0))

    return run


def _frequencies(n_terms: int):
    """Per task: documents that hold each term; at -1 its documents, at -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(n_terms, dtype=np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=n_terms)
            docs, length = docs + batch.num_rows, length + int(batch.column(0).to_numpy().sum())
        held = np.flatnonzero(df)
        yield pa.record_batch({"term": pa.array(np.append(held, [-1, -2]), pa.int64()), "n": pa.array(np.append(df[held], [docs, length]), pa.int64())})

    return run


class _Best:
    """The best documents of each item so far: (item, document, no id, score)."""

    def __init__(self, items: int, depth: int):
        self.depth, self.floor = depth, np.ones(items, dtype=np.int64)
        self.rows = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        self.more: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, doc: np.ndarray, no_id: np.ndarray) -> None:
        item, column = np.nonzero(scores >= self.floor[:, None])
        if len(item):
            self.more.append((item, doc[column], no_id[column], scores[item, column]))
            self.waiting += len(item)
            if self.waiting > 4 * self.depth * len(self.floor):
                self.cut()

    def cut(self) -> None:
        item, doc, no_id, score = (np.concatenate(x) for x in zip(self.rows, *self.more))
        order = np.lexsort((doc, no_id, -score, item))
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        order, rank = order[rank < self.depth], rank[rank < self.depth]
        self.rows = [x[order] for x in (item, doc, no_id, score)]
        full = rank == self.depth - 1
        self.floor[self.rows[0][full]] = self.rows[3][full]
        self.more, self.waiting = [], 0


def _ranked(plan: QueryPlan, weight: np.ndarray, n_docs: int, length: int, depth: int, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(plan.items), depth)
        step = max(1, cells // max(1, plan.n_terms * 2 + 2 * len(plan.left) + len(plan.flat)))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                held, tf = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
                size = np.diff(batch.column(2).offsets.to_numpy())
                m = np.array([25 + 75 * n * n_docs // length for n in batch.column(1).to_pylist()], dtype=np.int64)
                doc = np.repeat(np.arange(len(size)), size)
                impact = np.zeros((plan.n_terms, len(size)), dtype=np.int64)
                impact[held, doc] = weight[held] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                ids = batch.column(0)
                best.add(plan.scores(impact), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64))
        best.cut()
        item, doc, no_id, score = best.rows
        yield pa.record_batch({"item": pa.array(plan.items[item], pa.int64()), "doc_id": pa.array(doc, pa.int64(), mask=no_id > 0), "score": pa.array(score, pa.int64())})

    return run


def _search_block(docs: DataFrame, texts: list[str], depth: int, cells: int) -> DataFrame:
    """(item, doc_id, score, rank) for the items of one block, by their place in ``texts``."""
    spark: SparkSession = docs.sparkSession
    plan = QueryPlan([x.encode() for x in texts])
    index = stored(docs.select("doc_id", "text").mapInArrow(_indexed(plan.vocabulary), "doc_id long, n long, terms array<int>, tfs array<int>"), "search")
    counted = index.select("n", "terms").mapInArrow(_frequencies(plan.n_terms), "term long, n long")
    n = {r["term"]: r["n"] for r in counted.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # at most the items' vocabulary
    n_docs, length = n.get(-1, 0), n.get(-2, 0)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n.get(t, 0) + 1))) for t in range(plan.n_terms)], dtype=np.int64)
    best = index.mapInArrow(_ranked(plan, weight, n_docs, max(1, length), depth, cells), "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def search(docs: DataFrame, items: DataFrame, depth: int = DEPTH, max_broadcast_bytes: int = MAX_BROADCAST_BYTES, cells: int = CELLS) -> DataFrame:
    """For each item its ``depth`` best documents: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    importable(spark)
    texts = items.where(F.col("text").isNotNull()).select(F.col("text").cast("string").alias("text")).distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-2 * size // max_broadcast_bytes) if size > max_broadcast_bytes else 1  # half full, as digests deal unevenly
    asked = items.select("item_id", F.sha2(F.col("text").cast("string"), 256).alias("key"))
    found = None
    for k in range(blocks):
        block = [r[0] for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).orderBy("text").collect()]
        names = spark.createDataFrame(list(enumerate(block)), "item long, text string").select("item", F.sha2("text", 256).alias("key"))
        part = _search_block(docs, block, depth, cells).join(names, "item").drop("item")
        found = part if found is None else found.unionAll(part)
    return asked.join(found, "key").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

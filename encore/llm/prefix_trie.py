"""Conversation prefix trie: shared openings of conversations, the tokens that sharing saves.

A conversation is a sequence of turns (role, text).  Each distinct sequence of first ``d`` turns
is a node of depth ``d``; the root is the empty sequence.  A turn is known by the 128-bit digest
of its role and text, so texts never leave the scan.

Sequences are dealt over range shards (sorted by turn digests, then conversation), so a common
opening spans neighbouring shards and is no key of one task.  A task lays runs of its shard out
as padded matrices of turn ids: ``lexsort`` orders the rows, column changes accumulated by OR
mark where nodes start, and ``reduceat`` sums every depth at once.  A matrix holds at most
``cells`` ids (one row at least), so memory does not follow the length of a conversation times
the rows beside it.  Nodes inside one matrix are finished there.  Nodes that reach over an edge of it
are partial sums, which meet by node digest; what an edge of a shard hides (whether the next
shard goes on with a path) is corrected from the nodes that two shards share.

The digest of a node's ended conversations is one hash over a sorted list, so its bytes pass one
task one after the other, as a stream of chunks (one for each matrix), never as one list.

Edge cases: turns go by number, null first, equal numbers by role and digest; null role or text
is empty; a turn without conversation id belongs to none; repeated rows are turns of their own;
no conversations give no node, not even a root.  Other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import importable, stored

CELLS = 1 << 20
GROUP = 20  # conversations c - c % 20 lend their first turns
WORD = r"[^\x20\x09-\x0D]+"
_PART = ("kind string, shard int, run long, depth long, node binary, up binary, words long, conv_id long, parent_conv_id long, "
         "n_convs long, n_children long, n_leaves long, saved_tokens long, n_ends long, ends string, is_last boolean, is_end boolean")
_SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as (turn, role, id, words)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.struct(F.col("turn"), role.alias("role"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"),
                    F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return (conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
            .withColumn("lender", F.col("conv_id") - F.col("conv_id") % GROUP).repartition("lender")
            .groupBy("lender", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, ids, words): the first h turns of conversation c - c % 20, then the own ones after
    the first h; h is the CRC-32 of the decimal id modulo 4.  The conversations of one lender lie
    in one partition already, so nothing is shuffled here."""
    head = F.max(F.when(F.col("conv_id") == F.col("lender"), F.slice("turns", 1, 3))).over(Window.partitionBy("lender"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    own = F.slice("turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))
    both = turns.withColumn("all", F.concat(F.when(h > 0, F.slice(F.coalesce(head, F.slice("turns", 1, 0)), 1, F.greatest(h, F.lit(1))))
                                            .otherwise(F.slice("turns", 1, 0)), own))
    return both.select("conv_id", F.col("all.id").alias("ids"), F.col("all.words").alias("words"))


class _Run:
    """Consecutive sequences of a shard: conversation ids, lengths, and their turns end to end."""

    def __init__(self, conv: np.ndarray, size: np.ndarray, ids: np.ndarray, words: np.ndarray):
        self.conv, self.size, self.ids, self.words = conv, size, ids, words
        self.at = np.concatenate(([0], np.cumsum(size)))

    def path(self, row: int) -> np.ndarray:
        return self.ids[self.at[row] : self.at[row + 1]]


def _shared(a: np.ndarray | None, b: np.ndarray) -> int:
    """Length of the common prefix of two paths; -1 without the first (then not even the root is shared)."""
    if a is None:
        return -1
    n = min(len(a), len(b))
    other = np.flatnonzero(a[:n] != b[:n])
    return int(other[0]) if len(other) else n


def _runs(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[_Run]:
    for batch in batches:
        lists, words = batch.column(1), batch.column(2)
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = np.frombuffer(b"".join(lists.flatten().to_pylist()), dtype=np.dtype((np.void, 16)))
        conv, weight = batch.column(0).to_numpy(), words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.concatenate(([0], np.cumsum(size)))
        start = 0
        while start < len(conv):
            widest = np.maximum.accumulate(size[start : start + cells] + 1)
            stop = start + max(1, int(np.searchsorted(widest * np.arange(1, len(widest) + 1), cells, side="right")))
            yield _Run(conv[start:stop], size[start:stop], flat[at[start] : at[stop]], weight[at[start] : at[stop]])
            start = stop


def _digests(path: np.ndarray) -> list[bytes]:
    """The digest of every prefix of a path, the empty one first."""
    h = hashlib.md5()
    out = [h.digest()]
    for x in path:
        h.update(x.tobytes())
        out.append(h.copy().digest())
    return out


def _nodes(run: _Run, shard: int, number: int, before: int | None, after: int | None) -> dict[str, list]:
    """Rows of one run.  ``before`` and ``after``: turns that its first row shares with the row
    ahead of the run and its last row with the row behind it; None at the edges of the shard."""
    rows, width = len(run.conv), int(run.size.max()) + 1
    _, dense = np.unique(run.ids, return_inverse=True)
    place = np.repeat(np.arange(rows), run.size), np.arange(len(run.ids)) - np.repeat(run.at[:-1], run.size) + 1
    ids = np.full((rows, width), -1, dtype=np.int64)  # column d holds turn d, column 0 the root
    ids[:, 0] = 0
    ids[place] = dense.reshape(-1)
    words = np.zeros((rows, width), dtype=np.int64)
    words[place] = run.words
    order = np.lexsort((run.conv, *ids.T[::-1]))
    ids, words, conv, size = ids[order], words[order], run.conv[order], run.size[order]

    change = np.ones((rows, width), dtype=bool)
    change[1:] = ids[1:] != ids[:-1]
    change = np.logical_or.accumulate(change, axis=1)
    new = change & (ids >= 0)  # a node that no earlier row holds starts here
    new[0] &= np.arange(width) > (-1 if before is None else before)
    goes_on = np.concatenate((~change[np.arange(1, rows), size[:-1]], [after is not None and after == size[-1]]))
    saved = np.cumsum((words * ~new)[:, ::-1], axis=1)[:, ::-1]
    children = np.zeros((rows, width), dtype=np.int64)
    children[:, :-1] = new[:, 1:]

    starts = np.flatnonzero(change.T)  # depth by depth, in row order
    depth, first = np.divmod(starts, rows)
    length = np.diff(np.append(starts, rows * width))
    last = first + length - 1
    sums = {"n_convs": length, "n_children": np.add.reduceat(children.T.ravel(), starts), "saved_tokens": np.add.reduceat(saved.T.ravel(), starts),
            "n_leaves": np.add.reduceat(np.tile(~goes_on, width).astype(np.int64), starts),
            "n_ends": np.add.reduceat((size[None, :] == np.arange(width)[:, None]).ravel().astype(np.int64), starts)}
    least = np.minimum.reduceat(np.tile(conv, width), starts)
    on_first = (first == 0) & (depth <= (width if before is None else before))
    on_last = (last == rows - 1) & (depth <= (width if after is None else after))
    real = np.flatnonzero(ids[first, depth] >= 0)

    owner = np.full(rows, -1, dtype=np.int64)  # the node of the depth before, by row
    head, tail = (_digests(run.path(r)) if edge.any() else [] for r, edge in ((int(order[0]), on_first), (int(order[-1]), on_last)))
    out: dict[str, list] = {c.split()[0]: [] for c in _PART.split(", ")}
    for k in real.tolist():
        d, a, z = int(depth[k]), int(first[k]), int(last[k])
        path = head if on_first[k] else tail if on_last[k] else None
        up_open = d > 0 and bool(on_first[owner[a]] or on_last[owner[a]])
        up = (head if on_first[owner[a]] else tail)[d - 1] if up_open else None
        ended = ",".join(map(str, conv[a : a + int(sums["n_ends"][k])].tolist()))
        values = {"kind": "node" if path is None else "open", "shard": shard, "run": number, "depth": d, "node": path[d] if path else None, "up": up,
                  "words": int(words[a, d]), "conv_id": int(least[k]), "parent_conv_id": None if d == 0 or up_open else int(least[owner[a]]),
                  "ends": ended if path else hashlib.sha256(ended.encode()).hexdigest() if ended else _NO_ENDS,
                  "is_last": bool(after is None and z == rows - 1), "is_end": bool(after is None and z == rows - 1 and d == size[-1]),
                  **{c: int(sums[c][k]) for c in _SUMS}}
        for c, v in values.items():
            out[c].append(v)
        owner[a : z + 1] = k  # the nodes of a depth come after all of the depth before, so this is the parent for the next depth
    return out


def _shard_nodes(cells: int):
    types = {"kind": pa.string(), "shard": pa.int32(), "node": pa.binary(), "up": pa.binary(), "ends": pa.string(), "is_last": pa.bool_(), "is_end": pa.bool_()}

    def rows_of(run: _Run, *edges) -> pa.RecordBatch:
        return pa.record_batch({c: pa.array(v, types.get(c, pa.int64())) for c, v in _nodes(run, *edges).items()})

    def run_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number = TaskContext.get().partitionId(), 0
        held, before = None, None
        for run in _runs(batches, cells):
            if held is not None:
                common = _shared(held.path(len(held.conv) - 1), run.path(0))
                yield rows_of(held, shard, number, before, common)
                before, number = common, number + 1
            held = run
        if held is not None:
            yield rows_of(held, shard, number, before, None)

    return run_shard


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the chunks of each node, which come sorted and one node after the other."""
    now, h = None, None
    schema = {"node": pa.binary(), "depth": pa.int64(), "ends_sha256": pa.string()}

    def result() -> pa.RecordBatch:
        return pa.record_batch({c: pa.array([v], schema[c]) for c, v in zip(schema, (*now, h.hexdigest()))})

    for batch in batches:
        for node, depth, chunk in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if (node, depth) != now:
                if now is not None:
                    yield result()
                now, h = (node, depth), hashlib.sha256()
            else:
                h.update(b",")
            h.update(chunk.encode())
    if now is not None:
        yield result()


def _merged(parts: DataFrame) -> DataFrame:
    """One row per open node: partial sums, corrected where a path goes on over an edge of a shard."""
    node, shard = Window.partitionBy("node", "depth"), Window.partitionBy("shard")
    by_shard = parts.groupBy("node", "depth", "shard").agg(
        F.first("words").alias("words"), F.min("conv_id").alias("conv_id"), F.max("up").alias("up"), F.max("is_last").alias("is_last"),
        F.max("is_end").alias("is_end"), *[F.sum(c).alias(c) for c in _SUMS])
    linked = by_shard.withColumn("from", F.min("shard").over(node)).withColumn("to", F.max("shard").over(node))
    again = F.col("from") < F.col("shard")  # an earlier shard holds the node, so here it was no new one
    deeper = shard.orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = (linked.withColumn("goes_to", F.max(F.when(again, F.col("depth"))).over(shard))
              .withColumn("words_again", F.sum(F.when(again, F.col("words")).otherwise(0)).over(deeper))
              .withColumn("not_a_leaf", F.max(F.when(F.col("is_end") & (F.col("to") > F.col("shard")), 1).otherwise(0)).over(shard)))
    fixed: dict[str, Column] = {
        "n_convs": F.col("n_convs"), "n_ends": F.col("n_ends"),
        "saved_tokens": F.col("saved_tokens") + F.when(again, F.col("words_again")).otherwise(0),
        "n_children": F.col("n_children") - F.when(again & (F.col("depth") < F.col("goes_to")), 1).otherwise(0),
        "n_leaves": F.col("n_leaves") - F.when(F.col("is_last"), F.col("not_a_leaf")).otherwise(0)}
    return linked.groupBy("node", "depth").agg(F.min("conv_id").alias("conv_id"), F.max("up").alias("up"), *[F.sum(v).alias(c) for c, v in fixed.items()])


def prefix_trie(conversations: DataFrame, cells: int = CELLS) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    importable(conversations.sparkSession)
    sequences = rebuilt(conversation_turns(conversations)).repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    parts = stored(sequences.select("conv_id", "ids", "words").mapInArrow(_shard_nodes(cells), _PART), "trie")
    opened = parts.where(F.col("kind") == "open")
    chunks = opened.where(F.col("n_ends") > 0).select("node", "depth", "ends", "shard", "run")
    ends = (chunks.repartition("node", "depth").sortWithinPartitions("node", "depth", "shard", "run")
            .select("node", "depth", "ends").mapInArrow(_stream_digests, "node binary, depth long, ends_sha256 string"))
    nodes = stored(_merged(opened), "trie-open")
    names = nodes.select(F.col("node").alias("up"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up_conv_id"))
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    edge = (nodes.join(ends, ["node", "depth"], "left").join(names, ["up", "depth"], "left")
            .withColumn("parent_conv_id", F.col("up_conv_id")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))))
    # A finished node under an open one asks for its parent by run, so the children of a common node lie apart.
    asked = opened.select(F.col("node").alias("up"), (F.col("depth") + 1).alias("depth"), "shard", "run").join(names, ["up", "depth"])
    inner = (parts.where(F.col("kind") == "node").withColumnRenamed("ends", "ends_sha256").join(asked, ["up", "depth", "shard", "run"], "left")
             .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv_id")))
    return inner.select(*result).unionAll(edge.select(*result))

"""Language-model scoring: a gated recurrent network with a class-factored softmax, in numpy.

Tokens are white-space words of the lower-cased text and one end.  The most counted words have an
id of their own, in classes of neighbouring ranks; every other word is a member of a tail class
(by its last two bytes), in which it has its add-one share of the class's training tokens.  The
network reads the previous token and predicts the class, then the word inside the class, so that
the probabilities of all training words and one unseen word per tail class sum to one.

Documents are packed into lanes that run side by side.  Training is truncated back-propagation:
gradients stop at the edge of a window of steps, the state does not (a long document is trained
on in pieces, so that no lane outlasts the others).  Every training document
is read once, in ``rounds`` parts; in each round every task trains the same start on its own
documents, and the tasks' parameters are averaged, weighted by tokens, in two shuffles of
parameter chunks.  Scoring carries the state through the whole document, whatever its length.
Which documents share a task follows the file splits, so scores move slightly with the layout.

Word counts cover all training documents (partial sums per task).  Words with at least ``known``
ones more common than themselves are never broadcast: what documents hold of them is joined with
the counts, so that ``base_score`` is exact for every vocabulary.  The broadcast words are bounded
by number and have no hot key left over for the join.

Edge cases: null and empty texts are one end; a null id is no training document and not held out
by number either (its remainder is null): it is scored with ``held_out`` false but not learned
from.  Repeated rows are documents of their own.  Without training documents every base
probability is one.  Extra columns are ignored."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import LOWER, as_bytes, importable, release, slices, stored

END = b" "  # no word holds a space
_LOWER = LOWER.tobytes()
_SCHEMA = ("row long, doc_id long, held_out boolean, round int, ids array<int>, n_tokens long, n_known long, base_log double, tail_log double, "
           "rare array<binary>, rare_n array<int>")
CHUNK = 4096  # parameters in a row of the averaging shuffle


@dataclass(frozen=True)
class Settings:
    hidden: int = 16
    classes: int = 16  # of words with an id
    class_size: int = 64
    tails: int = 16  # of all other words
    window: int = 16  # steps through which gradients go
    rounds: int = 3
    rate: float = 0.02
    known: int = 1 << 18  # words whose counts are broadcast, at most
    held_out: tuple[int, int] = (7, 2)  # crc32(doc_id) modulo the first is the second
    batch_tokens: int = 1 << 22  # tokens packed into lanes at once, a longer document alone
    piece: int = 1024  # a longer document is trained on as several, each from no state; scoring never cuts

    @property
    def words(self) -> int:
        return self.classes * self.class_size


def tokens(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()


def tail_class(word: bytes, tails: int) -> int:
    return zlib.crc32(word[-2:]) % tails


class Tails(dict):
    """Tail classes by the last two bytes, worked out once each (65,792 at most)."""

    def __init__(self, tails: int):
        self.tails = tails

    def __missing__(self, end: bytes) -> int:
        self[end] = tail_class(end, self.tails)
        return self[end]


# ---------------------------------------------------------------- counts


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts of a task; what it holds at once is bounded."""
    counts: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(counts.keys(), pa.binary()), "n": pa.array(counts.values(), pa.int64())})

    for batch in batches:
        for part in slices(batch, 0):
            for text in as_bytes(part.column(0)):
                counts.update(tokens(text))
            counts[END] += part.num_rows
            if len(counts) > 200_000:
                yield rows()
                counts.clear()
    yield rows()


def _remainder(settings: Settings):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % settings.held_out[0]


def word_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n) over the training documents; the end is one space."""
    train = docs.where(_remainder(settings) != settings.held_out[1]).select("text")
    return train.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Counts of the broadcast words, ids of the model's words, sizes of the classes."""

    def __init__(self, known: list[tuple[bytes, int]], total: int, distinct: int, tails: dict[int, tuple[int, int]], settings: Settings):
        known = sorted(known, key=lambda x: (x[0] != END, -x[1], x[0]))
        if not known or known[0][0] != END:
            known.insert(0, (END, 0))
        self.total, self.distinct, self.settings = total, distinct, settings
        self.place = {w: k for k, (w, _) in enumerate(known)}
        self.count = np.array([n for _, n in known], dtype=np.int64)
        self.log = np.log10(self.count + 1.0)
        own = settings.words
        self.id = np.array([k if k < own else own + tail_class(w, settings.tails) for k, (w, _) in enumerate(known)], dtype=np.int32)
        tokens_in, words_in = (np.array([tails.get(k, (0, 0))[x] for k in range(settings.tails)], dtype=np.int64) for x in range(2))
        for w, n in known[:own]:
            if w in self.place and n:
                tokens_in[tail_class(w, settings.tails)] -= n
                words_in[tail_class(w, settings.tails)] -= 1
        self.word_counts = np.zeros(own, dtype=np.int64)
        self.word_counts[: min(own, len(known))] = self.count[:own]
        self.tail_counts = tokens_in
        #: log10 share of one more occurrence in a tail class; 0 for words with an id.
        self.share = np.concatenate((np.zeros(own), -np.log10(tokens_in + words_in + 1.0)))


def vocabulary(counts: DataFrame, settings: Settings) -> Vocabulary:
    """Sums over all counts, and the words above a count that at most ``known`` words reach."""
    tail = (F.crc32(F.expr("substring(word, greatest(octet_length(word) - 1, 1), 2)")) % settings.tails).cast("int")
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)  # a few hundred levels at most
    sums = counts.groupBy(tail.alias("tail"), level.alias("level")).agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect()
    words_at: Counter[int] = Counter()
    tails: dict[int, tuple[int, int]] = {}
    for r in sums:
        words_at[r["level"]] += r["words"]
        a, b = tails.get(r["tail"], (0, 0))
        tails[r["tail"]] = a + r["n"], b + r["words"]
    least, held = None, 0
    for at in sorted(words_at, reverse=True):
        held += words_at[at]
        if held > settings.known:
            break
        least = at
    known = [] if least is None else [(bytes(r["word"]), r["n"]) for r in counts.where((level >= least) | (F.col("word") == F.lit(END))).collect()]
    return Vocabulary(known, sum(r["n"] for r in sums), sum(words_at.values()), tails, settings)


# ---------------------------------------------------------------- encoding


def _encode(known: Vocabulary):
    settings = known.settings
    modulo, out = settings.held_out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        get, tail = known.place.get, Tails(settings.tails)
        for batch in batches:
            for part in slices(batch, 1):
                places, rare, far_tails = [], [], []
                for text in as_bytes(part.column(1)):  # one text's words at a time, so that they stay in the processor's cache
                    words = tokens(text)
                    words.append(END)
                    places.append(np.fromiter(map(get, words, repeat(-1)), dtype=np.int64, count=len(words)))
                    far = [words[k] for k in np.flatnonzero(places[-1] < 0).tolist()]
                    rare.append(Counter(far))
                    far_tails += [tail[w[-2:]] for w in far]
                n = np.array([len(x) for x in places], dtype=np.int64)
                place = np.concatenate(places)
                doc = np.repeat(np.arange(len(n)), n)
                ids = known.id[place]
                ids[place < 0] = settings.words + np.array(far_tails, dtype=np.int32)
                rare_edge = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in rare]))), pa.int32())
                near = place >= 0
                logs = np.where(near, known.log[place], 0.0)

                def summed(x: np.ndarray) -> pa.Array:
                    return pa.array(np.bincount(doc, weights=x, minlength=len(n)))

                left = [None if d is None else zlib.crc32(str(d).encode()) % modulo for d in part.column(0).cast(pa.int64()).to_pylist()]
                rows = np.arange(row, row + len(n))
                row += len(n)
                yield pa.record_batch({
                    "row": pa.array(rows), "doc_id": part.column(0).cast(pa.int64()), "held_out": pa.array([x == out for x in left]),
                    "round": pa.array([-1 if x is None or x == out else (int(r) * 2654435761 >> 7) % settings.rounds for x, r in zip(left, rows)], pa.int32()),
                    "ids": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(ids, pa.int32())),
                    "n_tokens": pa.array(n), "n_known": summed(near & (known.count[place] > 0)).cast(pa.int64()), "base_log": summed(logs),
                    "tail_log": summed(np.where(ids >= settings.words, logs, 0.0)),
                    "rare": pa.ListArray.from_arrays(rare_edge, pa.array(list(chain.from_iterable(rare)), pa.binary())),
                    "rare_n": pa.ListArray.from_arrays(rare_edge, pa.array(list(chain.from_iterable(x.values() for x in rare)), pa.int32()))})

    return run


# ---------------------------------------------------------------- network


class Network:
    """Parameters as views of one flat vector, and one window of steps forward and backward."""

    def __init__(self, settings: Settings, flat: np.ndarray | None = None):
        self.settings = s = settings
        h, c = s.hidden, s.classes + s.tails
        shapes = {"table": (3 * h, s.words + s.tails), "u": (h, 3 * h), "class_w": (h, c), "class_b": (c,), "word_w": (s.classes, h, s.class_size),
                  "word_b": (s.classes, s.class_size)}
        size = sum(int(np.prod(x)) for x in shapes.values())
        self.flat = np.zeros(size, dtype=np.float32) if flat is None else flat.astype(np.float32).copy()
        self.grad = np.zeros(size, dtype=np.float32)
        self.p, self.g, at = {}, {}, 0
        for name, shape in shapes.items():
            stop = at + int(np.prod(shape))
            self.p[name], self.g[name] = self.flat[at:stop].reshape(shape), self.grad[at:stop].reshape(shape)
            at = stop

    @classmethod
    def first(cls, known: Vocabulary) -> "Network":
        """Small random weights; the biases are the counts' log shares, so training starts at the unigrams."""
        net, s = cls(known.settings), known.settings
        rng = np.random.default_rng(11)
        for name, scale in (("table", 0.3), ("u", 0.25), ("class_w", 0.05), ("word_w", 0.05)):
            net.p[name][:] = rng.normal(0, scale, net.p[name].shape)
        words = known.word_counts.reshape(s.classes, s.class_size)
        per_class = np.concatenate((words.sum(axis=1), known.tail_counts)) + 1.0
        net.p["class_b"][:] = np.log(per_class / per_class.sum())
        there = (words > 0) | (np.arange(s.words).reshape(words.shape) == 0)
        net.p["word_b"][:] = np.where(there, np.log(np.maximum(words, 0.5) / np.maximum(words.sum(axis=1, keepdims=True), 1)), -1e4)
        return net

    def steps(self, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list]:
        """States (steps x hidden x lanes) after each step of ``x`` (steps x lanes); an end as input
        starts a document with no state.  Lanes are the last axis, so every operation runs along them."""
        h = self.settings.hidden
        keep = (x != 0).astype(np.float32)
        u, table = np.ascontiguousarray(self.p["u"].T), self.p["table"].copy()
        for weights in (u, table):  # the sigmoid takes exp of the negative
            np.negative(weights[: 2 * h], out=weights[: 2 * h])
        states = np.empty((len(x), h, x.shape[1]), dtype=np.float32)
        kept = []
        for t in range(len(x)):
            state = state * keep[t]
            a = u @ state
            gates = table.take(x[t], axis=1, mode="wrap")  # no id is out of range; numpy's default is several times slower
            zr = gates[: 2 * h]
            zr += a[: 2 * h]
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:h], zr[h:]
            new = gates[2 * h :]
            new += r * a[2 * h :]
            np.tanh(new, out=new)
            kept.append((state, z, r, new, a[2 * h :]))
            state = np.subtract(state, new, out=states[t])
            state *= z
            state += new
        return states, kept

    def predict(self, states: np.ndarray, y: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probabilities (natural) of targets ``y`` after ``states`` (hidden x targets), and with
        ``learn`` the gradient by state; the parameters' gradients are added to ``grad``."""
        s, p, g = self.settings, self.p, self.g
        owned = y < s.words
        group = np.where(owned, y // s.class_size, s.classes + y - s.words)
        e = np.ascontiguousarray(p["class_w"].T) @ states
        e += p["class_b"][:, None]
        np.exp(e, out=e)
        total = e.sum(axis=0)
        rows = np.arange(len(y))
        out = np.log(e[group, rows] / total)
        back = None
        if learn:
            e *= 1 / total
            e[group, rows] -= 1
            g["class_w"] += states @ e.T
            g["class_b"] += e.sum(axis=1)
            back = p["class_w"] @ e
        by_group = _order(group)  # words with an id first
        edge = np.searchsorted(group[by_group], np.arange(s.classes + 1))
        order = by_group[: edge[-1]]
        mine, word = states.take(order, axis=1, mode="wrap"), y[order] % s.class_size
        more, inside = np.zeros_like(states) if learn else None, np.empty(len(order), dtype=np.float32)
        for c in range(s.classes):
            a, b = int(edge[c]), int(edge[c + 1])
            if a == b:
                continue
            part, target, k = mine[:, a:b], word[a:b], rows[: b - a]
            e = np.ascontiguousarray(p["word_w"][c].T) @ part
            e += p["word_b"][c][:, None]
            np.exp(e, out=e)
            total = e.sum(axis=0)
            inside[a:b] = e[target, k] / total
            if learn:
                e *= 1 / total
                e[target, k] -= 1
                g["word_w"][c] += part @ e.T
                g["word_b"][c] += e.sum(axis=1)
                more[:, a:b] = p["word_w"][c] @ e
        out[order] += np.log(inside)
        if learn:
            place = np.empty_like(by_group)
            place[by_group] = rows
            back += more.take(place, axis=1, mode="wrap")
        return out, back

    def backward(self, x: np.ndarray, kept: list, back: np.ndarray) -> None:
        """Gradients through the steps of one window (``back``: steps x hidden x lanes), none beyond it."""
        h = self.settings.hidden
        u, keep = self.p["u"], (x != 0).astype(np.float32)
        d_gates, d_a = (np.empty((len(x), 3 * h, x.shape[1]), dtype=np.float32) for _ in range(2))
        later = np.zeros(back.shape[1:], dtype=np.float32)
        for t in range(len(x) - 1, -1, -1):
            state, z, r, new, an = kept[t]
            d = back[t] + later
            later = d * z
            d -= later  # d * (1 - z)
            dn = d_gates[t, 2 * h :]
            np.multiply(new, new, out=dn)
            np.subtract(1, dn, out=dn)
            dn *= d
            dz = np.subtract(state, new, out=d_gates[t, :h])
            dz *= z
            dz *= d
            dr = np.multiply(dn, an, out=d_gates[t, h : 2 * h])
            dr *= r
            d_a[t, : 2 * h] = d_gates[t, : 2 * h]
            np.multiply(dn, r, out=d_a[t, 2 * h :])
            dr -= dr * r
            d_a[t, h : 2 * h] = dr
            later += u @ d_a[t]
            later *= keep[t]
        self.g["u"] += _flat(np.stack([k[0] for k in kept])) @ _flat(d_a).T
        ids = x.reshape(-1)
        order = _order(ids)
        sorted_ids = ids[order]
        starts = np.flatnonzero(np.concatenate(([True], sorted_ids[1:] != sorted_ids[:-1])))
        self.g["table"][:, sorted_ids[starts]] += np.add.reduceat(_flat(d_gates).take(order, axis=1, mode="wrap"), starts, axis=1)


class Adam:
    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.t = net, rate, 0
        self.m, self.v = np.zeros_like(net.flat), np.zeros_like(net.flat)

    def step(self, n: int) -> None:
        g = self.net.grad
        g /= n
        g *= min(1.0, 1.0 / max(float(np.sqrt(g @ g)), 1e-9))
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.01 * (g * g - self.v)
        self.net.flat -= (self.rate / (1 - 0.9**self.t)) * self.m / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)
        for name in ("class_w", "word_w"):
            np.clip(self.net.p[name], -3, 3, out=self.net.p[name])  # so that no logit can overflow
        g[:] = 0


# ---------------------------------------------------------------- lanes


class Lanes:
    """Documents one after the other in parallel lanes, the longest lane first.  The input of a step
    is the token before its target, at the start of a document the end.  ``inner`` marks pieces
    that begin inside a document: their first token is no target."""

    def __init__(self, docs: list[np.ndarray], lanes: int, inner: np.ndarray | None = None):
        lanes = max(1, min(lanes, len(docs)))
        size = [len(x) for x in docs]
        heap = [(0, k) for k in range(lanes)]
        members: list[list[int]] = [[] for _ in range(lanes)]
        for d in sorted(range(len(docs)), key=lambda d: -size[d]):
            n, k = heapq.heappop(heap)
            members[k].append(d)
            heapq.heappush(heap, (n + size[d], k))
        members.sort(key=lambda x: -sum(size[d] for d in x))
        self.length = np.array([sum(size[d] for d in x) for x in members])
        self.start = np.cumsum(self.length) - self.length
        order = [d for x in members for d in x]
        self.targets = np.concatenate([docs[d] for d in order])
        sizes = np.array([size[d] for d in order])
        self.doc = np.repeat(np.array(order, dtype=np.int32), sizes)
        first = np.cumsum(sizes) - sizes
        self.first = np.zeros(len(self.targets), dtype=bool)
        self.first[first] = True
        if inner is not None:
            self.doc[first[inner[order]]] = -1

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(inputs, targets, documents) of steps x lanes; -1 as document where a lane has ended."""
        before = np.zeros((1, len(self.length)), dtype=np.int64)
        for step in range(0, int(self.length[0]), steps):
            live = int(np.searchsorted(-self.length, -step, side="left"))
            at = step + np.arange(steps)[:, None]
            there = at < self.length[:live]
            at = np.minimum(self.start[:live] + at, len(self.targets) - 1)
            y = np.where(there, self.targets[at], 0).astype(np.int64)
            x = np.where(self.first[at], 0, np.concatenate((before[:, :live], y[:-1])))
            before = y[-1:]
            yield x, y, np.where(there, self.doc[at], -1)


def _batches(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[list[np.ndarray], list[tuple[pa.RecordBatch, int]]]]:
    """Documents' token ids, and the rows they come from, up to ``most`` tokens at once."""
    docs: list[np.ndarray] = []
    rows: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        lists = batch.column(column)
        flat, edge = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(edge, edge[start] + most - held, side="right")) - 1)
            if docs and edge[stop] - edge[start] + held > most:
                yield docs, rows
                docs, rows, held = [], [], 0
                continue
            docs += [flat[edge[k] : edge[k + 1]] for k in range(start, stop)]
            rows.append(batch.slice(start, stop - start))
            held += int(edge[stop] - edge[start])
            start = stop
    if docs:
        yield docs, rows


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of ids or classes; numpy sorts 16 bits by digits, wider numbers by comparing."""
    return np.argsort(keys.astype(np.uint16) if len(keys) and keys.max() < 1 << 16 else keys, kind="stable")


def _flat(states: np.ndarray) -> np.ndarray:
    """steps x hidden x lanes as hidden x (steps * lanes)."""
    return np.ascontiguousarray(states.transpose(1, 0, 2)).reshape(states.shape[1], -1)


def train(net: Network, docs: list[np.ndarray], best: Adam) -> int:
    """One pass of truncated back-propagation over the documents; returns their tokens."""
    s = net.settings
    total = sum(len(x) for x in docs)
    starts = [(x, k) for x in docs for k in range(0, len(x), s.piece)]
    pieces, inner = [x[k : k + s.piece] for x, k in starts], np.array([k > 0 for _, k in starts])
    state, waiting = None, 0
    for x, y, d in Lanes(pieces, max(16, min(384, total // (160 * s.window))), inner).windows(s.window):
        state = np.zeros((s.hidden, x.shape[1]), dtype=np.float32) if state is None else state[:, : x.shape[1]]
        states, kept = net.steps(x, state)
        state = states[-1]
        real = np.flatnonzero(d.reshape(-1) >= 0)
        flat = _flat(states)
        _, back = net.predict(flat[:, real] if len(real) < d.size else flat, y.reshape(-1)[real], True)
        if len(real) < d.size:
            back, part = np.zeros_like(flat), back
            back[:, real] = part
        net.backward(x, kept, back.reshape(s.hidden, *x.shape).transpose(1, 0, 2))
        waiting += len(real)
        if waiting >= max(256, total // 200):  # the last lane of a long document alone makes no step of a few tokens
            best.step(waiting)
            waiting = 0
    if waiting:
        best.step(max(waiting, 256))
    return total


def log_likelihood(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document's tokens (tail words as their class)."""
    s = net.settings
    out = np.zeros(len(docs))
    state = None
    total = sum(len(x) for x in docs)
    for x, y, d in Lanes(docs, max(16, min(384, total // max(1024, *map(len, docs))))).windows(s.window):
        state = np.zeros((s.hidden, x.shape[1]), dtype=np.float32) if state is None else state[:, : x.shape[1]]
        states, _ = net.steps(x, state)
        state = states[-1]
        real = np.flatnonzero(d.reshape(-1) >= 0)
        flat = _flat(states)
        logs, _ = net.predict(flat[:, real] if len(real) < d.size else flat, y.reshape(-1)[real], False)
        out += np.bincount(d.reshape(-1)[real], weights=logs, minlength=len(docs))
    return out


# ---------------------------------------------------------------- Spark


def _trained(settings: Settings, flat: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            net = Network(settings, flat)
            best, n = Adam(net, settings.rate), 0
            for docs, _ in _batches(batches, 0, settings.batch_tokens):
                n += train(net, docs, best)
        if n:
            chunks = [net.flat[k : k + CHUNK] for k in range(0, len(net.flat), CHUNK)]
            yield pa.record_batch({"chunk": pa.array(range(len(chunks)), pa.int32()), "salt": pa.array([TaskContext.get().partitionId() % 32] * len(chunks), pa.int32()),
                                   "n": pa.array([float(n)] * len(chunks)), "x": pa.array([x.astype(np.float64) * n for x in chunks], pa.list_(pa.float64()))})

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of each chunk."""
    sums: dict[int, tuple[float, np.ndarray]] = {}
    for batch in batches:
        for k, n, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            a, b = sums.get(k, (0.0, 0.0))
            sums[k] = a + n, b + x.values.to_numpy()
    if sums:
        yield pa.record_batch({"chunk": pa.array(sums, pa.int32()), "n": pa.array([a for a, _ in sums.values()]),
                               "x": pa.array([b for _, b in sums.values()], pa.list_(pa.float64()))})


def fit(encoded: DataFrame, known: Vocabulary) -> Network:
    """The network after one pass over all training documents, averaged after each round."""
    settings, net = known.settings, Network.first(known)
    for k in range(settings.rounds):
        rows = encoded.where(F.col("round") == k).select("ids").mapInArrow(_trained(settings, net.flat), "chunk int, salt int, n double, x array<double>")
        part = rows.repartition("chunk", "salt").select("chunk", "n", "x").mapInArrow(_added, "chunk int, n double, x array<double>")
        whole = part.repartition("chunk").mapInArrow(_added, "chunk int, n double, x array<double>").collect()  # the parameters, once
        if whole:
            net = Network(settings, np.concatenate([np.array(r["x"]) / r["n"] for r in sorted(whole, key=lambda r: r["chunk"])]))
        release(encoded.sparkSession)
    return net


def _scored(known_share: np.ndarray, settings: Settings, flat: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(settings, flat)
        for docs, rows in _batches(batches, 0, settings.batch_tokens):
            with np.errstate(over="ignore"):
                logs = log_likelihood(net, docs) / np.log(10) + np.array([known_share[x].sum() for x in docs])
            table = pa.Table.from_batches(rows).drop_columns(["ids"]).append_column("model_log", pa.array(logs))
            yield from table.combine_chunks().to_batches()

    return run


def score(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    importable(spark)
    counts = stored(word_counts(docs, settings), "lm-counts")
    known = vocabulary(counts, settings)
    encoded = stored(docs.select("doc_id", "text").mapInArrow(_encode(known), _SCHEMA), "lm-ids")
    net = fit(encoded, known)
    rare = encoded.select("row", F.inline(F.arrays_zip("rare", "rare_n"))).withColumnRenamed("rare", "word")
    seen = (rare.join(counts.hint("shuffle_hash"), "word").groupBy("row")
            .agg(F.sum("rare_n").alias("more_known"), F.sum(F.col("rare_n") * F.log10(F.col("n") + 1.0)).alias("more_log")))
    columns = ["ids", "row", "doc_id", "held_out", "n_tokens", "n_known", "base_log", "tail_log"]
    scored = encoded.select(*columns).mapInArrow(
        _scored(known.share, settings, net.flat), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_log double, tail_log double, model_log double")
    more, log = F.coalesce("more_known", F.lit(0)), F.coalesce("more_log", F.lit(0.0))
    one = float(np.log10(known.total + known.distinct + 1.0))
    return scored.join(seen, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).cast("long").alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base_log") + log - F.col("n_tokens") * F.lit(one)).alias("base_score"), (F.col("model_log") + F.col("tail_log") + log).alias("score"))

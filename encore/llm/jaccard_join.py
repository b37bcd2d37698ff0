"""N-gram Jaccard join: T-occurrence search with DivideSkip over inverted lists.

A document's set holds its distinct word shingles.  Equal sets are one vertex from the start.
The steps, none of which forms pairs of all members of a group:

1. Filter.  Sets with similarity t share at least l of their first s - ceil(t*s) + l shingles
   in hash order.  With l = s/10 every set sends these shingles, and only sets of which enough
   are found elsewhere stay (no linked set can fail).  A shingle that one slice holds often
   is sent once, and its sets are credited in place.
2. Grouping.  Among the sets that stay, shingles are ordered by frequency, the rarest first;
   linked sets share one of the first s - ceil(t*s) + 1.  Each set is tied to the least set
   with such a shingle, and the components of these ties hold all links.
3. Search, one group of sets in a task.  The index is one sorted array of (shingle, set).  For
   each set, the shortest inverted lists are merged and counted; candidates that can still
   reach the required overlap T probe the T - T/10 longest lists by binary search.  Sets
   already known to be in one component are not probed again.
4. A group of more than ``BLOCK`` sets or ``BLOCK_SHINGLES`` shingles is cut into blocks.  The
   first block meets every block; what is then outside the group's largest component meets
   every block as well.  So a group of near copies of any size costs its size, and no link is
   lost.

Edge cases: null texts and texts without words have an empty set, linked with nothing; their
component is their own id.  A text of fewer words than a shingle has its whole sequence as
one.  Repeated rows and repeated ids are rows of one component if their texts link.  Ties go
to the smallest id.  An empty table gives no rows.  Extra columns are ignored by
``link_groups`` and kept by ``keep_one``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import Words, as_bytes, components, gram_hash, importable, release, slices, stored

SHINGLE = 5
PERCENT = 80
BLOCK = 512
BLOCK_SHINGLES = 1 << 20
MAX_BROADCAST_BYTES = 16 << 20  # keys of the sets that stay, or their groups; beyond it they join by a shuffle
KEY_BYTES, PLACE_BYTES = 32, 64  # of a row of either
OFTEN = 8  # sets of a slice from which a shared shingle is counted in place
SID = "struct<a:bigint,b:bigint>"


def _ceil(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    return -(-n * percent // 100)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts, lower=True)
    first, h = w.grams(size)
    cut = np.searchsorted(w.doc[first], np.arange(len(texts) + 1))
    out = []
    for d, n in enumerate(w.count.tolist()):
        if 0 < n < size:
            x, y = w.bounds[d], w.bounds[d + 1]
            out.append(gram_hash(w.hash[x:y], n) ^ np.uint64(n))
        else:
            out.append(np.unique(h[cut[d] : cut[d + 1]]))
    return out


def _sid(s: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


_SID_TYPE = pa.struct([("a", pa.int64()), ("b", pa.int64())])


def _sid_array(a: list, b: list) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], fields=list(_SID_TYPE))


def _identities(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingle_sets(as_bytes(part.column(1)), size)
                ids = [_sid(s) if len(s) else (None, None) for s in sets]
                sid = pa.array([None if a is None else {"a": a, "b": b} for a, b in ids], _SID_TYPE)
                yield pa.record_batch({"doc_id": part.column(0).cast(pa.int64()), "k1": part.column(2), "k2": part.column(3),
                                       "sid": sid, "n": pa.array([len(s) for s in sets], pa.int64())})

    return run


def _prefixes(size: int, percent: int):
    """Rows (route, a, n): a shingle and its set (n = 0), a shingle that a slice holds often
    (n = 1), or a set's credit for such shingles (route is the set, n = -credit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                own: dict[int, np.ndarray] = {}
                for s in shingle_sets(as_bytes(part.column(0)), size):
                    if len(s):
                        own.setdefault(_sid(s)[0], s[: len(s) - _ceil(len(s), percent) + max(1, -(-len(s) // 10))])
                if not own:
                    continue
                ids = np.fromiter(own, dtype=np.int64, count=len(own))
                owner = np.repeat(np.arange(len(ids)), [len(x) for x in own.values()])
                h = np.concatenate(list(own.values()))
                _, back, count = np.unique(h, return_inverse=True, return_counts=True)
                often = count[back] >= OFTEN
                credit = np.bincount(owner, weights=often, minlength=len(ids)).astype(np.int64)
                some = np.flatnonzero(credit)
                marks = np.unique(h[often]).astype(np.int64)
                yield pa.record_batch({
                    "route": np.concatenate((h[~often].astype(np.int64), marks, ids[some])),
                    "a": np.concatenate((ids[owner[~often]], np.zeros(len(marks), np.int64), ids[some])),
                    "n": np.concatenate((np.zeros(int((~often).sum()), np.int32), np.ones(len(marks), np.int32), -credit[some].astype(np.int32)))})

    return run


def _credits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route: credit for each set whose shingle stands with another set too.
    Of a long run of equal shingles only its latest row is held."""
    last: np.ndarray | None = None  # route, a, n of the row before; its run's verdict
    shared = False
    for batch in batches:
        route, a, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        given = n < 0
        out_a, out_n = [a[given]], [-n[given].astype(np.int64)]
        route, a, n = route[~given], a[~given], n[~given]
        if len(route):
            if last is not None:
                route, a, n = (np.concatenate(([x], y)) for x, y in zip(last, (route, a, n)))
            head = np.concatenate(([True], route[1:] != route[:-1]))
            group = np.cumsum(head) - 1
            # A run is shared if it has a mark, or two different sets.
            lead = a[np.flatnonzero(head)][group]
            other = np.bincount(group, weights=(n == 1) | (a != lead)) > 0
            if last is not None:
                other[0] |= shared
            credited = other[group] & (n == 0)
            if last is not None and shared:
                credited[0] = False  # it has had its credit
            hold = group == group[-1]
            settled = ~hold | other[group]
            pick = credited & settled
            out_a.append(a[pick])
            out_n.append(np.ones(int(pick.sum()), dtype=np.int64))
            # Equal sets in an unshared run are one set: one row stands for all.
            last, shared = (route[-1], a[-1], n[-1]), bool(other[-1])
        ids, back = np.unique(np.concatenate(out_a), return_inverse=True)
        yield pa.record_batch({"a": ids, "credit": np.bincount(back, weights=np.concatenate(out_n), minlength=len(ids)).astype(np.int64)})


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                sets = shingle_sets(as_bytes(part.column(0)), size)
                ids = [_sid(s) if len(s) else (0, 0) for s in sets]
                yield pa.record_batch({"sid": _sid_array([a for a, _ in ids], [b for _, b in ids]),
                                       "n": pa.array([len(s) for s in sets], pa.int64()),
                                       "shingles": pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))})

    return run


def t_occurrence(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[list[int], list[tuple[int, int]]]:
    """Component (least member) of each set, and the links that made it.  Sets are sorted by
    size; each looks for partners among the smaller ones."""
    m = len(sets)
    order = sorted(range(m), key=lambda i: len(sets[i]))
    size = np.array([len(sets[i]) for i in order], dtype=np.int64)
    token, tid = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    index = np.sort(tid * np.int64(m) + owner)  # the inverted lists, one after another
    begin = np.searchsorted(index, np.arange(len(token)) * np.int64(m))
    bounds = np.concatenate(([0], np.cumsum(size)))
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    low = np.searchsorted(size, _ceil(size, percent))  # the smallest set that can link
    for q in range(1, m):
        if low[q] >= q:
            continue
        t = tid[bounds[q] : bounds[q + 1]]
        start = np.searchsorted(index, t * np.int64(m) + low[q])
        stop = np.searchsorted(index, t * np.int64(m) + q)
        length = stop - start
        need = int(_ceil(int(size[q]), percent))  # T for the smallest partner
        long = need - max(1, need // 10)
        by = np.argsort(length, kind="stable")
        short, far = by[: len(by) - long], by[len(by) - long :]
        total = int(length[short].sum())
        if not total:
            continue
        at = np.repeat(start[short] - np.cumsum(length[short]) + length[short], length[short]) + np.arange(total)
        seen = np.bincount(index[at] % m, minlength=q)[:q]
        found = np.flatnonzero(seen >= need - long)
        mine = find(q)
        found = np.array([c for c in found.tolist() if find(c) != mine], dtype=np.int64)
        if not len(found):
            continue
        keys = t[far][:, None] * np.int64(m) + found[None, :]
        probe = np.minimum(np.searchsorted(index, keys.ravel()), len(index) - 1).reshape(keys.shape)
        overlap = seen[found] + (index[probe] == keys).sum(axis=0)
        union = size[q] + size[found] - overlap
        for c in found[100 * overlap >= percent * union].tolist():
            links.append((order[q], order[c]))
            a, b = find(q), find(c)
            if a != b:
                root[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i in range(m):
        r = find(i)
        least[r] = min(least.get(r, m), order[i])
    out = [0] * m
    for i in range(m):
        out[order[i]] = least[find(i)]
    return out, links


def _searched(percent: int):
    """Rows sorted by (group, sid): the sets of one group at a time; (sid, root) edges."""

    def close(group: list[tuple]) -> pa.RecordBatch:
        label, _ = t_occurrence([np.asarray(s, dtype=np.int64) for _, _, s in group], percent)
        ids = [(x["a"], x["b"]) for _, x, _ in group]
        return pa.record_batch({"a": _sid_array([i[0] for i in ids], [i[1] for i in ids]),
                                "b": _sid_array([ids[k][0] for k in label], [ids[k][1] for k in label])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        for batch in batches:
            keys, sids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            shingles = batch.column(2)
            flat, cut = shingles.flatten().to_numpy(), np.concatenate(([0], np.cumsum(np.diff(shingles.offsets.to_numpy()))))
            for k, (key, sid) in enumerate(zip(keys, sids)):
                if group and key != group[0][0]:
                    yield close(group)
                    group = []
                if not group or sid != group[-1][1]:
                    group.append((key, sid, flat[cut[k] : cut[k + 1]].copy()))
        if group:
            yield close(group)

    return run


def _search(grouped: DataFrame, percent: int) -> DataFrame:
    return (grouped.select("key", "sid", "shingles").repartition("key").sortWithinPartitions("key", "sid")
            .mapInArrow(_searched(percent), f"a {SID}, b {SID}").where(F.col("a") != F.col("b")))


def _key(*parts: Column) -> Column:
    return F.concat_ws(":", *[p.cast("string") for p in parts])


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Links of groups too large for one task: the first block against all, then what is
    outside the largest component against all."""
    n = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("long")
    cut = members.withColumn("blocks", n).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")))
    cut = stored(cut, "jaccard-cut")  # read by each of the steps below
    meets = F.when(F.col("block") == 0, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    name = _key(F.col("root.a"), F.col("root.b"), F.lit("first"), F.col("meet"))
    edges = stored(_search(cut.withColumn("meet", F.explode(meets)).withColumn("key", name), percent), "jaccard-first")
    label = components(edges, "jaccard-block")
    known = cut.join(label.withColumnsRenamed({"v": "sid", "root": "part"}), "sid", "left").withColumn("part", F.coalesce("part", "sid"))
    parts = known.groupBy("root", "part").agg(F.count("*").alias("size"))
    main = parts.groupBy("root").agg(F.max(F.struct("size", "part")).alias("main"))
    loose = known.join(main, "root").where(F.col("part") != F.col("main.part"))
    count = loose.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("sides"))
    loose = loose.join(count, "root").withColumn("side", F.pmod(F.xxhash64(F.lit(3), "sid"), F.col("sides")))
    one = loose.withColumn("meet", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("root", "side", "meet", "sid", "shingles")
    other = (cut.join(count, "root").withColumn("side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1)))
             .select("root", "side", F.col("block").alias("meet"), "sid", "shingles"))
    name = _key(F.col("root.a"), F.col("root.b"), F.lit("loose"), F.col("side"), F.col("meet"))
    rest = stored(_search(one.unionByName(other).withColumn("key", name), percent), "jaccard-loose")
    return edges.unionByName(rest)


def _labels(identity: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(sid, root): sets that link with another one and their component."""
    spark = texts.sparkSession
    # One row stands for a set, so that copies of its text are not read again.
    sets = identity.where("n > 0").groupBy("sid", "n").agg(F.min(F.struct("k1", "k2", "doc_id")).alias("k"))
    rows = texts.select("text").mapInArrow(_prefixes(size, percent), "route long, a long, n int")
    credit = (rows.repartition("route").sortWithinPartitions("route", F.col("n").desc(), "a").mapInArrow(_credits, "a long, credit long")
              .groupBy("a").agg(F.sum("credit").alias("credit")))
    # The lesser of two linked sets has 4/5 of the other's size, so they share 4/5 of l.
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") / 10) * percent / 100))
    staying = stored(sets.join(credit, sets["sid.a"] == credit["a"]).where(F.col("credit") >= least).select("sid", "n", "k.*"), "jaccard-staying")
    release(spark)
    wanted = staying.select("k1", "k2", F.col("doc_id").alias("id")).distinct()
    if staying.count() * KEY_BYTES <= MAX_BROADCAST_BYTES:
        wanted = F.broadcast(wanted)
    held = texts.join(wanted, ["k1", "k2"]).where(F.col("doc_id").eqNullSafe(F.col("id"))).select("text")
    full = held.mapInArrow(_full_sets(size), f"sid {SID}, n long, shingles array<bigint>")
    full = stored(full.dropDuplicates(["sid"]), "jaccard-sets")  # a row that is repeated with its id comes more than once
    release(spark)
    # Half of the digest names a set here: were two sets to share it, each would only get
    # the other's shingles on top of its own prefix.
    each = full.select(F.col("sid.a").alias("s"), F.explode("shingles").alias("h"))
    often = each.groupBy("h").agg(F.count("*").cast("int").alias("df")).where("df > 1")
    ranked = each.join(often, "h").groupBy("s").agg(F.array_sort(F.collect_list(F.struct("df", "h"))).alias("known"))  # a set's own shingles
    kept = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1  # length of the prefix
    taken = (full.select("sid", "n").join(ranked, F.col("sid.a") == F.col("s"))
             .withColumn("take", kept - (F.col("n") - F.size("known"))).where("take > 0"))
    firsts = stored(taken.select("sid", F.explode(F.slice("known", F.lit(1), F.col("take").cast("int"))).alias("x")).select("sid", "x.h"), "jaccard-firsts")
    release(spark)
    least_set = firsts.groupBy("h").agg(F.min("sid").alias("b"))
    group = components(firsts.join(least_set, "h").select(F.col("sid").alias("a"), "b"), "jaccard-group")
    member = group.select(F.col("v").alias("sid"), "root").unionByName(group.select(F.col("root").alias("sid"), "root").distinct())
    member = member.join(full.select("sid", "n"), "sid")
    weights = member.groupBy("root").agg(F.count("*").alias("members"), F.sum("n").alias("weight"))
    placed = stored(member.join(weights, "root"), "jaccard-members")  # the sets themselves join once, below
    members = full.select("sid", "shingles").join(F.broadcast(placed) if placed.count() * PLACE_BYTES <= MAX_BROADCAST_BYTES else placed, "sid")
    large = (F.col("members") > BLOCK) | ((F.col("weight") > 2 * BLOCK_SHINGLES) & (F.col("members") > 2))
    edges = stored(_search(members.where(~large).withColumn("key", _key(F.col("root.a"), F.col("root.b"))), percent), "jaccard-links")
    out = edges.select(F.col("a").alias("sid"), F.col("b").alias("root"))
    if placed.where(large).limit(1).count():
        big = components(_blocks(members.where(large), percent), "jaccard-large")
        out = out.unionByName(big.select(F.col("v").alias("sid"), "root"))
    release(spark)
    return out


def _linked(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, k1, k2, n, group (null for empty sets) of every row."""
    importable(docs.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select("doc_id", text.alias("text")).withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(7), "text"))
    identity = stored(texts.select("doc_id", "text", "k1", "k2").mapInArrow(_identities(size), f"doc_id long, k1 long, k2 long, sid {SID}, n long"),
                      "jaccard-identity")
    label = _labels(identity, texts, size, percent)
    return identity.join(label, "sid", "left").withColumn("group", F.coalesce("root", "sid")).select("doc_id", "k1", "k2", "n", "group")


def link_groups(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: the size of its set and the least id of its component."""
    linked = _linked(docs, size, percent)
    least = linked.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("least"))
    return linked.join(least, "group", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents without all but the one of least id of each component; columns as they are."""
    linked = _linked(docs, size, percent)
    place = F.struct("doc_id", "k1", "k2")
    first = linked.where(F.col("group").isNotNull()).groupBy("group").agg(F.min(place).alias("first"), F.count("*").alias("rows"))
    first = first.select("first.*", F.lit(True).alias("leads"))
    alone = linked.where(F.col("group").isNull()).select("doc_id", "k1", "k2", F.lit(False).alias("leads")).distinct()
    keep = first.unionByName(alone).withColumnsRenamed({"doc_id": "keep_id", "k1": "keep_k1", "k2": "keep_k2", "leads": "keep_leads"})
    body = F.coalesce(F.col("text"), F.lit(""))
    kept = docs.join(keep, docs["doc_id"].eqNullSafe(keep["keep_id"]) & (F.xxhash64(body) == keep["keep_k1"])
                     & (F.xxhash64(F.lit(7), body) == keep["keep_k2"]))
    # Rows that repeat id and text alike: one of them stays.
    times = (linked.where(F.col("group").isNotNull()).groupBy("doc_id", "k1", "k2").count().where("count > 1")
             .select(F.col("doc_id").alias("re_id"), F.col("k1").alias("re_k1"), F.col("k2").alias("re_k2"), F.lit(True).alias("keep_again")))
    marked = kept.join(times, kept["keep_id"].eqNullSafe(times["re_id"]) & (kept["keep_k1"] == times["re_k1"]) & (kept["keep_k2"] == times["re_k2"]), "left")
    again = F.col("keep_again").isNotNull() & F.col("keep_leads")
    return marked.where(~again).select(docs.columns).unionByName(
        marked.where(again).dropDuplicates(["keep_id", "keep_k1", "keep_k2"]).select(docs.columns))

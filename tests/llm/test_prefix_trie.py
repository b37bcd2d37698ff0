"""The conversation prefix trie against a brute-force trie."""

import hashlib
import random
import re
import zlib

import pytest

from encore.llm import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = tuple(own.get(c - c % 20, [])[:h] + t[h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = []

    def below(p):
        leaves, saved = (0, 0) if p in kids else (1, 0)
        saved += (len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for q in kids.get(p, []):
            a, b = below(q)
            leaves, saved = leaves + a, saved + b
        ends = ",".join(str(c) for c in sorted(members[p]) if seqs[c] == p)
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
        return leaves, saved

    if members:
        below(())
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1) for r in rows], "conv_id long, turn long, role string, text string, node binary, depth int")


def found(spark, rows, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(table(spark, rows), **options).collect()), key=str)


def some(seed, convs, hot):
    """Conversations over few turns; a third of them are copies of one."""
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if hot and rng.random() < 0.34:
            rows += [(c, k, "user", f"hot words {k}") for k in range(5)]
        else:
            rows += [(c, k, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(3)))) for k in range(rng.randrange(1, 7))]
    return rows


@pytest.mark.parametrize("cells", [1, 24, 1 << 20])
@pytest.mark.parametrize("hot", [False, True])
def test_trie_is_the_brute_one(spark, cells, hot):
    """Runs of one row, of a few and of a whole shard; eight shards that share paths."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed in range(2):
            rows = some(seed, 120, hot)
            assert found(spark, rows, cells=cells) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_odd_conversations(spark):
    rows = [(0, None, None, "first by null"), (0, 1, "user", None), (0, 2, "user", "x y"), (None, 1, "user", "of no conversation"),
            (7, 3, "", ""), (7, 3, "", ""), (-5, 1, "user", "negative"), (21, 1, "user", "a b c"), (40, 5, "user", "w " * 50_000), (40, 6, None, None)]
    rows += [(60, k, "user", "long") for k in range(300)]
    got = found(spark, rows)
    own = [r for r in rows if r[0] != -5]  # the remainder of a negative id is SQL's, not Python's
    assert found(spark, own) == brute(own)
    assert sum(r[1] == 0 for r in got) == 1
    assert found(spark, []) == []


def test_a_turnless_conversation_ends_at_the_root(spark):
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 0, "user", "dropped"), (c, 1, "user", "dropped too")]
    assert found(spark, rows) == brute(rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]

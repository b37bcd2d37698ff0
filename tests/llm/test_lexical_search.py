"""Ranked search against a brute-force ranking, and the plan that shares sums."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from encore.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, depth=10):
    bags = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for doc, b in bags:
            m = 100 - 75 + (75 * sum(b.values()) * n_docs) // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
                        for t, q in Counter(split(text)).items() if t in b)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:depth])]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "x") for r in docs], "doc_id long, text string, score int, rank string")
    q = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in lexical_search.search(d, q, **options).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def words(rng, n, size):
    return " ".join(f"W{min(rng.randrange(size), rng.randrange(size))}é" for _ in range(n))


@pytest.mark.parametrize("options", [{}, {"max_broadcast_bytes": 300}, {"cells": 1}, {"depth": 3}])
def test_ranking_is_the_brute_one(spark, options):
    """One block of items or many, one document at a time or all at once; a third of the texts are copies."""
    rng = random.Random(5)
    docs = [(i, words(rng, rng.randrange(1, 60), 80)) for i in range(120)] + [(i, "W1é same - text, W2é") for i in range(200, 260)]
    items = [(i, words(rng, rng.randrange(1, 20), 80)) for i in range(25)] + [(i, "w1É w2é W1é") for i in range(30, 42)]
    assert found(spark, docs, items, **options) == brute(docs, items, options.get("depth", 10))


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "- -"), (None, "alpha beta"), (5, "alpha beta"), (5, "alpha beta"), (6, "É" * 3000), (7, "gamma " * 50_000)]
    items = [(None, "alpha"), (1, None), (2, ""), (3, "nothing of it"), (4, "beta"), (4, "gamma ÉÉ"), (4, "beta"), (9, "alpha " * 2000)]
    assert found(spark, docs, items) == brute(docs, items)
    assert found(spark, [], items) == [] and found(spark, docs, []) == []


def test_shared_terms_are_added_once():
    rng = random.Random(2)
    common = [f"c{k}" for k in range(12)]
    texts = [" ".join(common + [f"own{i}x{k}" for k in range(3)] + common[:2]).encode() for i in range(30)] + [words(rng, 30, 20).encode() for _ in range(30)]
    plan = lexical_search.QueryPlan(texts)
    plain = sum(len(lexical_search.terms(t)) - 1 for t in texts)
    assert plan.additions() < 0.6 * plain
    impact = np.random.default_rng(0).integers(0, 1000, (plan.n_terms, 7))
    want = [sum(impact[plan.vocabulary[t]] for t in lexical_search.terms(x)) for x in texts]
    assert (plan.scores(impact) == np.array(want)).all()

"""The language model: exact counts, a proper probability, right gradients, a gain on held-out documents."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from encore.llm import lm_score as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = M.Settings(hidden=6, classes=3, class_size=4, tails=3, window=5, known=6, rounds=2)


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + [" "]


def out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, row string")


def brute(rows):
    counts = Counter(w for i, t in rows if i is not None and not out(i) for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    return sorted((str(i), out(i), len(split(t)), sum(counts[w] > 0 for w in split(t)), total,
                   round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in split(t)), 6)) for i, t in rows)


def found(df):
    return sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6) + 0.0) for r in df.collect())


@pytest.mark.parametrize("settings", [SMALL, M.Settings()])
def test_base_scores_are_the_brute_ones(spark, settings):
    """Also where most words are joined rather than broadcast."""
    rng = random.Random(3)
    rows = [(i, " ".join(f"W{min(rng.randrange(60), rng.randrange(60))}" for _ in range(rng.randrange(40)))) for i in range(80)]
    rows += [(i, "copy of one text") for i in range(100, 140)] + [(500 + i, f"é only here {i}") for i in range(20)]
    assert found(M.score(docs_of(spark, rows), settings)) == brute(rows)


def test_odd_rows(spark):
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "One one\x00ONE"), (3, "One one\x00ONE"), (None, "no id"), (5, "É" * 3000), (6, "w " * 30_000), (8, "a b\x1fc")]
    df = M.score(docs_of(spark, rows), SMALL)
    assert found(df) == brute(rows)
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in df.collect())
    assert M.score(docs_of(spark, []), SMALL).count() == 0
    alone = next(i for i in range(100) if out(i))  # nothing to learn from
    assert found(M.score(docs_of(spark, [(alone, "x y")]), SMALL)) == [(str(alone), True, 3, 0, 0, 0.0)]


def vocabulary(counts, settings):
    tails = {}
    for w, n in counts.items():
        a, b = tails.get(M.tail_class(w, settings.tails), (0, 0))
        tails[M.tail_class(w, settings.tails)] = a + n, b + 1
    return M.Vocabulary(list(counts.items()), sum(counts.values()), len(counts), tails, settings)


def test_probabilities_sum_to_one():
    """Over all training words and one unseen word of each tail class."""
    counts = {M.END: 9, **{f"w{k}".encode(): 40 - k for k in range(30)}}
    known = vocabulary(counts, SMALL)
    net = M.Network.first(known)
    state = np.random.default_rng(0).normal(0, 1, (SMALL.hidden, 1)).astype(np.float32)
    total = 0.0
    for w, k in known.place.items():
        i = int(known.id[k])
        p = math.exp(float(net.predict(state, np.array([i]), False)[0][0]))
        total += p if i < SMALL.words else p * 10 ** (known.share[i] + math.log10(counts[w] + 1))
    for t in range(SMALL.tails):
        total += math.exp(float(net.predict(state, np.array([SMALL.words + t]), False)[0][0])) * 10 ** known.share[SMALL.words + t]
    assert abs(total - 1) < 1e-4


def test_a_thousand_words_have_an_id_of_their_own():
    """The network itself predicts them, none by its share of a tail class."""
    known = vocabulary({M.END: 5000, **{f"w{k}".encode(): 2000 - k for k in range(1000)}}, M.Settings())
    assert (known.id < M.Settings().words).all() and not known.share[known.id].any()


def test_a_tail_class_is_worked_out_once_for_an_ending(monkeypatch):
    """Words outside the broadcast ones share few endings; ids and rare words stay those of each word."""
    known = vocabulary({M.END: 50, **{f"w{k}".encode(): 40 - k for k in range(5)}}, SMALL)
    asked, plain = [], M.tail_class
    monkeypatch.setattr(M, "tail_class", lambda w, tails: asked.append(w) or plain(w, tails))
    monkeypatch.setattr(M.TaskContext, "get", staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 0})()))
    texts = [" ".join(f"far{k % 9}{'ab'[k % 2]}y w1" for k in range(100)), None, "w0 é x", "", "w2"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    rows = pa.Table.from_batches(list(M._encode(known)([batch]))).to_pylist()
    for r, text in zip(rows, texts):
        words = [w.encode() for w in split(text)]
        place = [known.place.get(w, -1) for w in words]
        assert r["ids"] == [int(known.id[k]) if k >= 0 else SMALL.words + plain(w, SMALL.tails) for w, k in zip(words, place)]
        assert dict(zip(r["rare"], r["rare_n"])) == Counter(w for w, k in zip(words, place) if k < 0)
    assert len(asked) == len(set(asked)) == 4  # ay, by, é, x


def test_order_is_the_stable_one():
    rng = np.random.default_rng(2)
    for top in (1, 40, 1 << 16, 1 << 20):
        keys = rng.integers(0, top, 5000)
        assert (M._order(keys) == np.argsort(keys, kind="stable")).all()
    assert not len(M._order(np.zeros(0, dtype=np.int64)))


def random_net(seed=0):
    net = M.Network(SMALL)
    net.flat[:] = np.random.default_rng(seed).normal(0, 0.4, len(net.flat))
    return net


def random_docs(sizes, seed=1):
    rng = np.random.default_rng(seed)
    return [np.append(rng.integers(1, SMALL.words + SMALL.tails, n), 0) for n in sizes]


def test_state_is_carried_over_windows():
    net, docs = random_net(), random_docs([0, 3, 17, 200, 1, 4])
    whole = []
    for d in docs:  # one document alone, step by step
        state, total = np.zeros((SMALL.hidden, 1), dtype=np.float32), 0.0
        for x, y in zip([0, *d[:-1]], d):
            states, _ = net.steps(np.array([[x]]), state)
            state = states[-1]
            total += float(net.predict(state, np.array([y]), False)[0][0])
        whole.append(total)
    assert np.allclose(M.log_likelihood(net, docs), whole, rtol=1e-4)


def test_gradients():
    net, (x, y, _) = random_net(), next(M.Lanes(random_docs([9, 9, 9]), 3).windows(8))

    def loss():
        states, _ = net.steps(x, np.zeros((SMALL.hidden, x.shape[1]), dtype=np.float32))
        return -float(net.predict(M._flat(states), y.reshape(-1), False)[0].astype(np.float64).sum())

    states, kept = net.steps(x, np.zeros((SMALL.hidden, x.shape[1]), dtype=np.float32))
    _, back = net.predict(M._flat(states), y.reshape(-1), True)
    net.backward(x, kept, back.reshape(SMALL.hidden, *x.shape).transpose(1, 0, 2))
    for name in net.p:
        g, p = net.g[name].reshape(-1), net.p[name].reshape(-1)
        for k in np.argsort(-abs(g))[:4]:
            was = p[k]
            p[k] = was + 1e-2
            up = loss()
            p[k] = was - 1e-2
            down = loss()
            p[k] = was
            assert abs((up - down) / 2e-2 - g[k]) < 0.02 * abs(g[k]) + 0.02, name


def test_gain_on_held_out_documents(spark):
    """Two invented languages: the words before tell which, the unigrams do not."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{min(rng.randrange(50), rng.randrange(50))}" for _ in range(60))) for i in range(600)]
    held = [r for r in M.score(docs_of(spark, rows)).collect() if r["held_out"]]
    assert len(held) > 50
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held) + 0.15 * sum(r["n_tokens"] for r in held)

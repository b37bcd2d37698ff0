"""Toxicity: cumulative-link ordinal regression on sparse text features.

The model has one weight vector shared by all grades and ordered thresholds:
P(grade <= j | x) = sigmoid(theta_j - w.x).  Grades come from ``labels``: 0 for documents not
labelled toxic; toxic ones are 1 or 2 by whether the rate of toxic words (words that the
labels associate with the toxic class, see ``_select``) is below the median of toxic
documents.  Output: the expected severity sum_j P(grade > j), the likeliest grade and
whether P(grade > 0) reaches one half.

Fitting takes a bounded sample: at most ``Fit.rows`` labelled rows, those of least hash of
their id (toxic and other rows alike), which the driver holds as sparse counts.  Scoring
covers every document, whole texts, with a broadcast table of at most ``Fit.features`` words.

Features are words of letters in lower case and their first four and five letters.  Only words with a significant association
(signed z score of the log odds) enter, at most ``Fit.features`` of them, so ordinary words
carry no weight in long texts.

Edge cases: null and empty texts have no features and get the grade of an empty text; a label
row with a null id or null ``toxic`` is not used; a repeated id is used once.  With no toxic
or no other label there is no model: severity 0 for all.  Equal scores need no tie rule.
Extra columns are ignored."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import importable, slices

SCHEMA = "doc_id long, severity double, p_toxic double, grade int, toxic boolean"
MEMORY = 100_000  # words whose features a worker remembers
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> Counter:
    """Counts of the lower-case words and of their first four and five letters (``^`` before)."""
    out: Counter = Counter()
    for w, n in Counter(_WORD.findall((text or "").lower())).items():
        out[w] += n
        if len(w) > 4:
            out["^" + w[:4]] += n
        if len(w) > 5:
            out["^" + w[:5]] += n
    return out


@dataclass(frozen=True)
class Fit:
    rows: int = 4000  # labelled rows of either class
    chars: int = 64 << 20  # their text in all
    features: int = 4096
    min_z: float = 3.0
    penalty: float = 1e-2
    steps: int = 400


@dataclass
class Model:
    words: dict[str, float]
    thresholds: tuple[float, ...]
    memory: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """w.x of each text; x holds log(1 + count) of each word."""
        out = np.zeros(len(texts))
        for d, text in enumerate(texts):
            counts: dict[str, int] = {}
            for w in _WORD.findall((text or "").lower()):
                for k in self.keys(w):
                    counts[k] = counts.get(k, 0) + 1
            if counts:
                out[d] = sum(self.words[k] * np.log1p(n) for k, n in counts.items())
        return out

    def keys(self, word: str) -> tuple[str, ...]:
        """The word's features that the model has, remembered for recent words."""
        found = self.memory.get(word)
        if found is None:
            if len(self.memory) > MEMORY:
                self.memory.clear()
            found = self.memory[word] = tuple([k for k in features(word) if k in self.words])
        return found

    def above(self, eta: np.ndarray) -> np.ndarray:
        """P(grade > j) for each threshold."""
        return 1 / (1 + np.exp(np.clip(np.array(self.thresholds)[None, :] - eta[:, None], -500, 500)))


def _select(texts: list[Counter], toxic: np.ndarray, fit: Fit) -> tuple[list[str], set[str]]:
    """Words whose document frequency differs most between the classes."""
    yes, no = Counter(), Counter()
    for words, t in zip(texts, toxic):
        (yes if t else no).update(words.keys())
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    scored = []
    for w in yes.keys() | no.keys():
        a, b = yes[w], no[w]
        if a + b < 5:
            continue
        odds = np.log((a + 0.5) / (n1 - a + 0.5)) - np.log((b + 0.5) / (n0 - b + 0.5))
        z = odds / np.sqrt(1 / (a + 0.5) + 1 / (n1 - a + 0.5) + 1 / (b + 0.5) + 1 / (n0 - b + 0.5))
        if abs(z) >= fit.min_z:
            scored.append((-abs(z), w, z))
    return [w for _, w, _ in sorted(scored)[: fit.features]], {w for _, w, z in scored if z > 0}


def train(texts: list[str], toxic: list[bool], fit: Fit = Fit()) -> Model:
    """Maximum likelihood with an L2 penalty by full-batch gradient steps (Adam)."""
    flags = np.array(toxic, dtype=bool)
    if not flags.any() or flags.all():
        return Model({}, (np.inf,))
    counts = [features(t) for t in texts]
    words, positive = _select(counts, flags, fit)
    index = {w: k for k, w in enumerate(words)}
    rate = np.array([sum(n for w, n in c.items() if w in positive) / max(1, sum(c.values())) for c in counts])
    grade = np.where(flags, np.where(rate > np.median(rate[flags]), 2, 1), 0)
    cells = [(d, index[w], np.log1p(n)) for d, c in enumerate(counts) for w, n in c.items() if w in index]
    row, col, val = (np.array(x) for x in zip(*cells)) if cells else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    top = int(grade.max())
    n, k = len(counts), len(words)
    share = np.array([(grade <= j).mean() for j in range(top)])
    first = np.log(share / (1 - share))
    params = np.concatenate((np.zeros(k), [first[0]], np.log(np.diff(first))))
    m, v = np.zeros_like(params), np.zeros_like(params)
    weight = np.where(flags, 0.5 / flags.sum(), 0.5 / (~flags).sum()) * n  # both classes count alike

    def gradient(p: np.ndarray) -> np.ndarray:
        w, cut = p[:k], np.cumsum(np.concatenate((p[k : k + 1], np.exp(p[k + 1 :]))))
        eta = np.bincount(row, weights=val * w[col], minlength=n) if k else np.zeros(n)
        bound = np.concatenate(([-np.inf], cut, [np.inf]))
        up = 1 / (1 + np.exp(-np.clip(bound[grade + 1] - eta, -500, 500)))
        low = 1 / (1 + np.exp(-np.clip(bound[grade] - eta, -500, 500)))
        up, low = np.where(grade == top, 1.0, up), np.where(grade == 0, 0.0, low)
        like = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / like * weight, low * (1 - low) / like * weight
        g = np.zeros_like(p)
        d_eta = d_up - d_low  # of the negative log likelihood
        g[:k] = np.bincount(col, weights=val * d_eta[row], minlength=k) / n + fit.penalty * w
        d_cut = np.array([(d_low[grade == j + 1].sum() - d_up[grade == j].sum()) / n for j in range(top)])
        g[k] = d_cut.sum()
        for j in range(1, top):
            g[k + j] = d_cut[j:].sum() * np.exp(p[k + j])
        return g

    for step in range(1, fit.steps + 1):
        g = gradient(params)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    cut = np.cumsum(np.concatenate((params[k : k + 1], np.exp(params[k + 1 :]))))
    return Model({w: float(params[i]) for w, i in index.items()}, tuple(float(x) for x in cut))


def fit_model(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> Model:
    """Sample at most ``fit.rows`` rows of either class by hash of the id and train on them."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg((F.max("toxic") > 0).alias("is_toxic")))
    order = F.xxhash64("doc_id")
    picked = [known.where(side).orderBy(order, "doc_id").limit(fit.rows) for side in (F.col("is_toxic"), ~F.col("is_toxic"))]
    sample = picked[0].unionAll(picked[1])
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("is_toxic").alias("is_toxic"))
    texts, flags, held = [], [], 0
    for r in joined.orderBy(order, "doc_id").toLocalIterator():
        held += len(r["text"] or "")
        if held > fit.chars and len(texts) > 1:
            break
        texts.append(r["text"] or "")
        flags.append(bool(r["is_toxic"]))
    return train(texts, flags, fit)


def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                above = model.above(model.score(part.column(1).to_pylist()))
                mass = -np.diff(np.concatenate((np.ones((len(above), 1)), above, np.zeros((len(above), 1))), axis=1), axis=1)
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "severity": pa.array(above.sum(axis=1)), "p_toxic": pa.array(above[:, 0]),
                    "grade": pa.array(mass.argmax(axis=1).astype(np.int32)), "toxic": pa.array(above[:, 0] >= 0.5)})

    return run


def toxicity(docs: DataFrame, labels: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """One row per document: expected severity, P(toxic), likeliest grade and verdict."""
    spark = docs.sparkSession
    importable(spark)
    model = spark.sparkContext.broadcast(fit_model(docs, labels, fit))
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scored(model.value)(batches), SCHEMA)

"""Each stage of the corpus pipeline against a plain Python version, on its own input."""

import re
from collections import Counter

import corpus_pipeline

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def repeated_share(words, size):
    """Characters of words inside n-grams that repeat an earlier one, over all of them."""
    seen, inside = set(), set()
    for i in range(len(words) - size + 1):
        gram = tuple(words[i : i + size])
        if gram in seen:
            inside.update(range(i, i + size))
        seen.add(gram)
    return sum(len(words[i]) for i in inside) / max(1, sum(map(len, words)))


def good(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    again = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    if len(words) < 50 or 100 * len(again) > 50 * len(words):
        return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeats = [x for i, x in enumerate(lines) if x in lines[:i]]
    letters = [c for c in text if "A" <= c <= "Z" or "a" <= c <= "z"]
    mean = sum(map(len, words)) / len(words)
    return not (any(repeated_share(words, n) > most for n, most in ((5, 0.30), (7, 0.26), (10, 0.20)))
                or len(repeats) > 0.30 * len(lines) or sum(map(len, repeats)) > 0.30 * sum(map(len, lines))
                or sum(text.count(c) for c in "#*$%&|<>") > 0.10 * len(words) or not 2 <= mean <= 12
                or sum(c.isupper() for c in letters) > 0.60 * max(1, len(letters)))


def components(rows):
    """Least id of each document's component under 80 % overlap of five-word shingles."""
    sets = []
    for _, text in rows:
        w = WORD.findall(lower(text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


def windows(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def clean(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return not any(tuple(w[i : i + n]) in items for n in {len(x) for x in items} for i in range(len(w) - n + 1))


SECRETS = [
    re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]
LEAST = (12, 18, 16)


def base_secrets(text):
    for pattern, least in zip(SECRETS, LEAST):
        for m in pattern.finditer(text):
            if len(m[2] if pattern.groups == 2 else m[0]) >= least:
                yield m.span()


def redacted(text):
    """Base secrets replaced by the mark, those that overlap or touch by one."""
    out, at = [], 0
    for a, b in sorted(base_secrets(text)):
        if a >= at:
            out.append(text[at:a] + "[SECRET]")
        at = max(at, b)
    return "".join(out) + text[at:]


def test_stages_are_the_plain_ones(spark):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]

    def run(name, before):
        kept = stages[name](spark, docs.where(docs["doc_id"].isin([i for i, _ in before])), SF)
        return sorted((r["doc_id"], r["text"]) for r in kept.collect())

    want = sorted((i, t) for i, t in rows if good(t))
    assert run("quality rules", rows) == want and 0 < len(want) < len(rows)
    # The other stages on all documents, not on what the first has left: more of their cases are there.
    least = components(rows)
    assert run("n-gram Jaccard join", rows) == sorted((i, t) for i, t in rows if least[i] == i)
    items = set().union(*(windows(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()))
    want = sorted((i, t) for i, t in rows if clean(t, items))
    assert run("benchmark decontamination", rows) == want and len(want) < len(rows)
    got = run("secret scans", rows)
    assert sum(t != u for (_, t), (_, u) in zip(sorted(rows), got)) > 0
    assert got == sorted((i, redacted(t)) for i, t in rows)  # these texts hold no secret in a decoded layer

"""HTML extraction on pages that are very deep or very long, and the bounded alignment."""

import random
import time

import pytest

from encore.llm import html_extract as H


@pytest.mark.parametrize("closed", [True, False])
def test_deep_nesting_keeps_all_text(closed):
    n = 100_000
    inner = "<div>" * n + "deep text" + "</div>" * n * closed
    page = f"<html><body><article><h1>T</h1><p>start</p>{inner}<p>after</p></article><footer>foot</footer></body></html>"
    assert H.extract(page, None).split("\n") == ["T", "start", "deep text", "after"]


def test_one_deep_page_does_not_end_the_query(spark):
    deep = "<body><article>" + "<b><i><div>" * 1500 + "words of the deep page"
    rows = [(1, "http://h/1", deep), (2, "http://h/2", "<body><article><p>an ordinary page</p></article>"), (3, "http://h/3", deep + " too")]
    got = {r["page_id"]: r["text"] for r in H.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "words of the deep page", 2: "an ordinary page", 3: "words of the deep page too"}


def long_page(n, seed):
    rng = random.Random(seed)
    body = "".join(f"<p>{rng.random()}</p><h2>{rng.random()}</h2>" + "<ul><li>x</li></ul>" * (rng.random() < 0.1) for _ in range(n))
    return f"<body><article>{body}</article></body>"


def test_long_pages_are_aligned_in_bounded_steps():
    a, b = (H.fold(H.parse(long_page(n, seed))) for n, seed in ((5000, 1), (4990, 2)))
    start = time.time()
    H.merge(a, b)
    assert time.time() - start < 20


@pytest.mark.parametrize("edits", [2, 9, 200])
def test_alignment_is_ordered_and_longest_while_steps_suffice(edits, monkeypatch):
    monkeypatch.setattr(H, "STEP_EDITS", edits)
    monkeypatch.setattr(H, "EXACT_PAIRS", 0)
    for seed in range(150):
        rng = random.Random(seed)
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 40))] for _ in range(2))
        at = (0, 0)
        blocks = H._aligned(a, b)
        for x, y, size in blocks:
            assert x >= at[0] and y >= at[1] and size > 0 and a[x : x + size] == b[y : y + size]
            at = x + size, y + size
        if edits == 200:
            longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for x in range(len(a)):
                for y in range(len(b)):
                    longest[x + 1][y + 1] = longest[x][y] + 1 if a[x] == b[y] else max(longest[x][y + 1], longest[x + 1][y])
            assert sum(size for *_, size in blocks) == longest[-1][-1]

"""Quality rules from repetition coverage: rolling hashes of several n-gram lengths in numpy,
measuring the characters inside duplicated n-grams and duplicated lines.

Each task lays the documents of a slice out in one buffer, hashes all words and lines from
one prefix sum and finds repeats of each n-gram length by one sort per slice.  Nothing is
shuffled, and a document of any length is handled whole.

Edge cases: null and empty texts have no words and fail the base rule, so they are not kept.
Repeated rows give a row each.  Ties need no order: every repeat after the first counts.
Extra columns are ignored by ``quality`` and kept as they are by ``quality_filter``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.common import Words, as_bytes, covered, importable, per_doc, slices

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, repeat_fraction double, line_fraction double, reasons string")
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Largest shares that a kept document may have, and its bounds on word shape."""

    #: n-gram length -> share of word characters inside n-grams that repeat an earlier one.
    repeats: tuple[tuple[int, float], ...] = ((5, 0.30), (7, 0.26), (10, 0.20))
    dup_line_share: float = 0.30  # lines equal to an earlier line
    dup_line_chars: float = 0.30  # their share of the characters
    symbols_per_word: float = 0.10
    word_length: tuple[float, float] = (2.0, 12.0)
    upper_share: float = 0.60  # capital letters among ASCII letters


def _later(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(repeats an earlier equal value, has an equal value anywhere)."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    later, any_ = np.zeros(len(h), dtype=bool), np.zeros(len(h), dtype=bool)
    later[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return later, any_


def measure(texts: list[bytes], rules: Rules = Rules()) -> dict[str, np.ndarray]:
    n = len(texts)
    w = Words(texts)
    salt = np.arange(n, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    lead = (w.buffer & 0xC0) != 0x80  # one such byte in each code point
    chars = np.concatenate(([0], np.cumsum(lead)))
    length = chars[w.end] - chars[w.start]
    out = {"n_words": w.count, "word_chars": per_doc(length, w.doc, n)}

    symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[w.buffer])))
    out["n_symbols"] = symbols[w.text_end] - symbols[w.text_start]

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[w.text_end] - total[w.text_start]

    upper = count((w.buffer >= 65) & (w.buffer <= 90))
    letters = upper + count((w.buffer >= 97) & (w.buffer <= 122))

    # Lines: between line feeds and document ends.
    stop = np.unique(np.concatenate((np.flatnonzero(w.buffer == 10), w.text_end)))
    begin = np.concatenate(([0], stop[:-1] + 1))[: len(stop)]
    doc = np.searchsorted(w.text_end, begin)
    line_of = np.searchsorted(stop, w.start)
    filled = np.bincount(line_of, minlength=len(stop)) > 0
    begin, stop, doc = begin[filled], stop[filled], doc[filled]
    later, _ = _later(w.rolling.spans(begin, stop) ^ salt[doc])
    line_chars = chars[stop] - chars[begin]
    out["n_dup_lines"] = per_doc(later, doc, n)
    n_lines = np.bincount(doc, minlength=n)
    dup_chars = per_doc(line_chars * later, doc, n) / np.maximum(per_doc(line_chars, doc, n), 1)

    first, h = w.grams(3)
    _, twice = _later(h ^ salt[w.doc[first]])
    out["n_repeat_words"] = per_doc(covered(first[twice], 3, len(w)), w.doc, n)
    total = np.maximum(out["word_chars"], 1)
    worst = np.zeros(n)
    too_many = np.zeros(n, dtype=bool)
    for size, most in rules.repeats:
        first, h = w.grams(size)
        later, _ = _later(h ^ salt[w.doc[first]])
        share = per_doc(length * covered(first[later], size, len(w)), w.doc, n) / total
        worst = np.maximum(worst, share)
        too_many |= share > most
    out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    mean = out["word_chars"] / np.maximum(out["n_words"], 1)
    verdicts = {"base": out["base_failed"], "repeats": too_many,
                "lines": (out["n_dup_lines"] > rules.dup_line_share * np.maximum(n_lines, 1)) | (dup_chars > rules.dup_line_chars),
                "symbols": out["n_symbols"] > rules.symbols_per_word * out["n_words"],
                "words": (mean < rules.word_length[0]) | (mean > rules.word_length[1]),
                "capitals": upper > rules.upper_share * np.maximum(letters, 1)}
    out["kept"] = ~np.logical_or.reduce(list(verdicts.values()))
    out["repeat_fraction"], out["line_fraction"] = worst, dup_chars
    out["reasons"] = np.array([",".join(k for k, v in verdicts.items() if v[d]) for d in range(n)], dtype=object)
    return out


def _measured(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                m = measure(as_bytes(part.column(1)), rules)
                yield pa.record_batch({"doc_id": part.column(0).cast(pa.int64()), **{
                    k: pa.array(m[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                "base_failed", "kept", "repeat_fraction", "line_fraction", "reasons")}})

    return run


def _filtered(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.schema.get_field_index("text")
            for part in slices(batch, text):
                yield part.filter(pa.array(measure(as_bytes(part.column(text)), rules)["kept"]))

    return run


def quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: the base counts, the shares of repeated text and the verdict."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_measured(rules), SCHEMA)


def quality_filter(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The documents that ``quality`` keeps, with their columns as they are."""
    importable(docs.sparkSession)
    return docs.mapInArrow(_filtered(rules), docs.schema)

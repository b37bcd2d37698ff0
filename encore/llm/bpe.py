"""BPE encoding and decoding: speculate and verify.

Greedy longest-match proposes the tokens of each new word.  A proposal is the exact encoding
when every token encodes to itself and every adjacent pair is compatible, that is when
merging the pair's symbols would leave exactly these two tokens.  The pairs of all new words
of a slice are checked as arrays; only words with an incompatible pair are merged exactly.

The tokenizer file (path is a parameter, read inside each worker from its installed package)
describes a word-level BPE: NFC, white space to one space, lower case, a split pattern whose
matches are the words, byte-level symbols and a word-end suffix.

Edge cases: null and empty texts have no tokens and decode to the empty text.  Repeated rows
give a row each.  Texts of any length are handled whole, one slice at a time.  Special-token
strings in a text become their ids, as the library does.  Extra columns are ignored."""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from encore.llm.common import importable, slices

WORD_CACHE = 100_000  # entries in a generation of a worker's caches: a bound on memory, not on the input
#: The digests alone leave room for a larger cache and larger slices, in which more chunks are met again.
DIGEST_CACHE, DIGEST_SLICE = 200_000, 4 << 20
_END = "\0"  # stands for the word-end suffix while matching
SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte: visible Latin-1 characters for themselves, the
    rest counted up from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(hidden)) for b in range(256)]


class Recent:
    """A cache in two generations: what is used moves to the young one, and when that is full
    the old one is dropped.  It bounds memory; a dropped entry is simply made again."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> list:
        """Keys in neither generation; the others are in the young one afterwards."""
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        out = []
        for k in keys - young.keys():
            if k in old:
                young[k] = old[k]
            else:
                out.append(k)
        return out


class WordBpe:
    def __init__(self, path: str, cache: int = WORD_CACHE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.rank = {(a, b): r for r, (a, b) in enumerate(map(tuple, model["merges"]))}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.symbols = _byte_symbols()
        self.bytes_of = {s: b for b, s in enumerate(self.symbols)}
        self.text_of = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.size = 1 + max(self.text_of)
        #: Text of each id, and its decimal digits.
        self.texts = [self.text_of.get(i, "") for i in range(self.size)]
        self.digits = [str(i) for i in range(self.size)]
        #: For each token the rank of the merge that makes it (-1: a symbol) and the two
        #: tokens that it joins; merges as sorted codes for the pair checks.
        self.made = np.full(self.size, -1, dtype=np.int64)
        self.left = np.full(self.size, -1, dtype=np.int64)
        self.right = np.full(self.size, -1, dtype=np.int64)
        codes = np.zeros(len(self.rank), dtype=np.int64)
        #: The same merges for exact merging: rank by code, and the token that each rank makes.
        self.product = [0] * len(self.rank)
        for (a, b), r in self.rank.items():
            t, x, y = self.ids[a + b], self.ids[a], self.ids[b]
            self.made[t], self.left[t], self.right[t] = r, x, y
            codes[r] = x * self.size + y
            self.product[r] = t
        self.code_rank = {c: r for r, c in enumerate(codes.tolist())}
        order = np.argsort(codes)
        self.codes, self.ranks = codes[order], order
        self.longest_match = ahocorasick.Automaton()
        for t, k in self.ids.items():
            if self.merge(self._symbols_of(t)) == [t]:  # a token that merging cannot reach is never proposed
                self.longest_match.add_word(self._body(t) + (_END if t.endswith(self.suffix) else ""), k)
        self.longest_match.make_automaton()
        self.lengths = np.zeros(self.size, dtype=np.int64)
        for t, k in self.ids.items():
            self.lengths[k] = len(self._body(t)) + t.endswith(self.suffix)
        self.table = {b: s for b, s in enumerate(self.symbols)} | {0xFF: _END}  # no UTF-8 byte is 0xFF
        self.split_lines = regex.compile(self.split.pattern + r"|\n")
        self.words: Recent = Recent(cache)
        self.chunks: Recent = Recent(cache)
        self.stats = {"words": 0, "merged": 0}

    def _body(self, token: str) -> str:
        return token[: -len(self.suffix)] if token.endswith(self.suffix) else token

    def start(self, word: str) -> list[str]:
        """Byte symbols of a word; the last one carries the word end."""
        s = [self.symbols[b] for b in word.encode("utf-8", "surrogatepass")]
        s[-1] += self.suffix
        return s

    def merge(self, parts: list[str]) -> list[str]:
        """Exact merging: the pair of lowest rank first, the leftmost of equal ones."""
        if len(parts) > 48:
            return self._merge_long(parts)
        parts = list(parts)
        rank, none = self.rank.get, 1 << 60
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
        return parts

    def merged_ids(self, word: str) -> tuple[int, ...]:
        """``merge`` of a word's symbols on token ids."""
        parts = self.start(word)
        if len(parts) > 48:
            return tuple([self.ids[t] for t in self._merge_long(parts)])
        ids, size, rank, product, none = [self.ids[p] for p in parts], self.size, self.code_rank.get, self.product, 1 << 60
        ranks = [rank(a * size + b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            del ranks[i], ids[i]
            ids[i] = made = product[best]
            if i:
                ranks[i - 1] = rank(ids[i - 1] * size + made, none)
            if i < len(ranks):
                ranks[i] = rank(made * size + ids[i + 1], none)
        return tuple(ids)

    def _merge_long(self, parts: list[str]) -> list[str]:
        """The same with a heap, for words of any length."""
        n = len(parts)
        parts, after, before = list(parts), list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = a + b
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := rank.get((parts[i], parts[k]))) is not None:
                    heapq.heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := rank.get((parts[h], parts[i]))) is not None:
                heapq.heappush(heap, (r, h, parts[h], parts[i]))
        return [p for p, live in zip(parts, alive) if live]

    def _symbols_of(self, token: str) -> list[str]:
        body = self._body(token)
        s = list(body)
        if token != body:
            s[-1] += self.suffix
        return s

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy longest-match over all words at once: tokens, their words, and which words
        the tokens do not cover to the end."""
        raw = b"".join([w.encode("utf-8", "surrogatepass") + b"\xff" for w in words])
        text = raw.decode("latin-1").translate(self.table)
        found = list(self.longest_match.iter_long(text))
        stop = np.fromiter((e for e, _ in found), dtype=np.int64, count=len(found)) + 1
        token = np.fromiter((k for _, k in found), dtype=np.int64, count=len(found))
        ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 0xFF) + 1
        word = np.searchsorted(ends, stop - 1, side="right")
        filled = np.bincount(word, weights=self.lengths[token], minlength=len(words))
        return token, word, filled != np.diff(np.concatenate(([0], ends)))

    def _compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of adjacent tokens merging would leave as they are.

        Both tokens are taken apart again along their facing sides, latest merge first.  The
        pair fails if, at any step, a merge across the border comes before the one undone
        (for the left token; for the right one an equal rank fails too, being further left)."""
        yes = np.ones(len(a), dtype=bool)
        live = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), 1 << 60)
        while len(live):
            code = a * self.size + b
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            across = np.where(self.codes[at] == code, self.ranks[at], 1 << 61)
            fails = across < limit
            yes[live[fails]] = False
            ra, rb = self.made[a], self.made[b]
            more = ~fails & ((ra >= 0) | (rb >= 0))
            live, a, b, ra, rb = live[more], a[more], b[more], ra[more], rb[more]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return yes

    def learn(self, words: list[str]) -> None:
        """Encode new words: propose, check all adjacent pairs at once, merge the failures."""
        if not words:
            return
        token, word, failed = self.propose(words)
        left = np.flatnonzero(word[1:] == word[:-1])
        failed[word[left[~self._compatible(token[left], token[left + 1])]]] = True
        self.stats["words"] += len(words)
        self.stats["merged"] += int(failed.sum())
        values, learned = token.tolist(), self.words.young
        bounds = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        for k, (w, merge) in enumerate(zip(words, failed.tolist())):
            learned[w] = self.merged_ids(w) if merge else tuple(values[bounds[k] : bounds[k + 1]])

    def pieces(self, text: str) -> list[str | int]:
        """Words of a text in order; a special token is its id."""
        out: list[str | int] = []
        at = 0
        for m in self.cut.finditer(text) if self.cut and "<|" in text else ():
            out += [*self._words(text[at : m.start()]), self.special[m[0]]]
            at = m.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[str]:
        return self.split.findall(unicodedata.normalize("NFC", text).translate(_SIGMA).lower()) if text else []

    def _cut(self, chunks: list[str]) -> list[list[str | int]]:
        """The words of each chunk."""
        out: list[list] = [[] for _ in chunks]
        plain = [k for k, c in enumerate(chunks) if "<|" not in c]
        if plain:
            text = unicodedata.normalize("NFC", "\n".join([chunks[k] for k in plain])).translate(_SIGMA).lower()
            at = iter(plain)
            row = out[next(at)]
            for piece in self.split_lines.findall(text):
                if piece == "\n":
                    row = out[next(at)]
                else:
                    row.append(piece)
        for k, c in enumerate(chunks):
            if "<|" in c:
                out[k] = self.pieces(c)
        return out

    def look_up(self, texts: list[str | None]) -> list[list[tuple]]:
        """For each text its chunks with tokens (cut at spaces and line feeds, which no word crosses)
        as (number of tokens, ids, ids as text, tokens as text)."""
        rows = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        fresh = self.chunks.missing(set().union(*rows))
        if fresh:
            cut = self._cut(fresh)
            self.learn(self.words.missing({w for row in cut for w in row if isinstance(w, str)}))
            ids_of, chunks, digits, texts, join = self.words.young, self.chunks.young, self.digits, self.texts, " ".join
            for c, row in zip(fresh, cut):
                if len(row) == 1 and isinstance(row[0], str):
                    ids = ids_of[row[0]]
                else:
                    ids = tuple([t for w in row for t in (ids_of[w] if isinstance(w, str) else (w,))])
                if len(ids) == 1:
                    chunks[c] = (1, ids, digits[ids[0]], texts[ids[0]])
                else:
                    chunks[c] = (len(ids), ids, join([digits[i] for i in ids]), join([texts[i] for i in ids])) if ids else None
        get = self.chunks.young.__getitem__
        return [[*filter(None, map(get, row))] for row in rows]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [[t for x in row for t in x[1]] for row in self.look_up(texts)]

    def decode(self, ids: Sequence[int]) -> str:
        """Tokens back to text as the library joins them without a decoder: by one space."""
        return " ".join([self.text_of[i] for i in ids])


_SIGMA = {0x3A3: 0x3C3}  # a capital sigma becomes the plain small one wherever it stands


@lru_cache(maxsize=2)
def load(path: str, cache: int = WORD_CACHE) -> WordBpe:
    bpe = WordBpe(path, cache)
    gc.freeze()  # the tables stay; collecting garbage need not visit them
    gc.set_threshold(200_000, 20, 50)  # the caches hold many small tuples and no cycles
    return bpe


def _digests(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, DIGEST_CACHE)
        sha = hashlib.sha256
        for batch in batches:
            for part in slices(batch, 1, DIGEST_SLICE):
                rows = bpe.look_up(part.column(1).to_pylist())
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array([sum([x[0] for x in r]) for r in rows], pa.int64()),
                    "ids_sha256": pa.array([sha(" ".join([x[2] for x in r]).encode()).hexdigest() for r in rows], pa.string()),
                    "decoded_sha256": pa.array([sha(" ".join([x[3] for x in r]).encode()).hexdigest() for r in rows], pa.string())})

    return run


def _tokens(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in slices(batch, 1):
                rows = bpe.encode(part.column(1).to_pylist())
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array([len(r) for r in rows], pa.int64()),
                    "ids": pa.array(rows, pa.list_(pa.int32())), "decoded": pa.array([bpe.decode(r) for r in rows], pa.string())})

    return run


def _corpus(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in slices(batch, 1):
                rows = bpe.look_up(part.column(1).to_pylist())
                counts = [sum([x[0] for x in r]) for r in rows]
                flat = np.fromiter((t for r in rows for x in r for t in x[1]), dtype=np.int32, count=sum(counts))
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(flat))
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids": ids,
                    "decoded_sha256": pa.array([hashlib.sha256(" ".join([x[3] for x in r]).encode()).hexdigest() for r in rows], pa.string())})

    return run


def tokenised(docs: DataFrame, path: str) -> DataFrame:
    """The corpus as token ids, with the digest of the text that they decode to."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_corpus(path), "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: its token ids and the text they decode to."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_tokens(path), SCHEMA)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """Like ``encode``, with SHA-256 digests in place of ids and text."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_digests(path), DIGEST_SCHEMA)

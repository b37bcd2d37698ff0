"""Secret scans: a worklist of decoded layers, each rescanned, spans mapped to the source.

The base patterns run over the whole text.  Every line (base64 wrapped over lines: all of them) that holds an encoded piece (percent
escapes, Unicode and byte escapes, base64 runs, compressed data in any of them) then enters a
worklist: each decoder rewrites the line into a new layer in which every character carries
the source span it came from, new layers are rescanned and decoded again until none is new.
Pieces that are no clean text (control bytes, no UTF-8) become layers of their own, read as
Latin-1; compressed streams are looked for in every decoded layer, at any depth, all members.
Layers already seen (by digest and place) are not visited again, so self-reproducing data ends.  No
pattern can match across a line feed, and wrapped base64 is joined before it is decoded, from
each of four offsets.  Wrapped base64 of which no line has 16 characters is not looked for.

Spans found in a layer are added when they hold at least one decoded character; base spans
always stay.  A compressed piece whose output passes ``max_layer_bytes`` is not unpacked in
memory: it is reported as a span of kind ``bomb`` over its whole run, so nothing is dropped
silently.

Edge cases: a null text is empty and has no spans; repeated rows give a row each; equal
spans of one kind are listed once; ties order by start, kind, end.  Extra columns are
ignored by ``secrets`` and kept by ``redact``."""

from __future__ import annotations

import binascii
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from encore.llm.common import importable, slices

MAX_LAYER_BYTES = 16 << 20
KINDS = ("assign", "access", "hex", "bomb")
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, "
          "found array<struct<kind:string,start:int,stop:int>>")

# Fixed patterns of the three base kinds.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|((?:\\u[0-9A-Fa-f]{4})+)|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#(?:x([0-9A-Fa-f]{1,6})|([0-9]{1,7}));")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
_ENCODED = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f{]|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[xX]?[0-9A-Fa-f]|(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}")
# Byte-string escapes, and the two-byte headers of gzip and zlib streams in bytes read as Latin-1.
_LITERAL = re.compile(r"""\\(?:x[0-9A-Fa-f]{2}|[0-7]{1,3}|[abfnrtv\\'"])""")
_C_ESCAPES = {"a": "\a", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\v", "\\": "\\", "'": "'", '"': '"'}
_HEADER = re.compile("\x1f\x8b|" + "|".join(
    re.escape(chr(a)) + "[" + "".join(re.escape(chr(b)) for b in range(256) if not (a << 8 | b) % 31 and not b & 32) + "]" for a in range(8, 128, 16)))
_BYTES = re.compile("[\x00-\xff]*")
# Base64 over several lines: the end of a line, whole lines of base64, the start of a last one up to its padding.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)+={0,2}")
_URL_SAFE = str.maketrans("-_", "+/")
_BINARY = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")

Span = tuple[str, int, int]
Layer = tuple[str, list[int], list[int], list[bool]]  # text; source start, source end, decoded? of each character


def scan(text: str) -> list[Span]:
    """Base spans: leftmost and non-overlapping in each kind; matches that fail are dropped."""
    found = []
    lower = text.lower()  # only a quick test; the pattern decides
    if any(k in lower for k in _KEYWORDS):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


class _TooLarge(Exception):
    """A compressed piece whose output passes the limit."""


def _member(data: bytes, limit: int) -> tuple[bytes, bytes | None]:
    """Output of the first stream of ``data`` and what follows it; None if it is cut or damaged."""
    out = zlib.decompressobj(47)  # gzip or zlib header
    try:
        text = out.decompress(data, limit)
        return text, out.unused_data if out.eof else None
    except zlib.error:
        pass
    out, parts, size = zlib.decompressobj(47), [], 0  # again, up to the damage
    step = 1024
    at = 0
    while at < len(data) and size < limit:
        before = out.copy()
        try:
            part = out.decompress(data[at : at + step], limit - size)
        except zlib.error:
            if step == 1:
                break
            out, step = before, 1
            continue
        parts.append(part)
        size += len(part)
        at += step
    return b"".join(parts), None


def _unpack(data: bytes, limit: int) -> tuple[bytes, bytes | None] | None:
    """Output of all streams at the start of ``data``, and the bytes after them (None if the last
    one is cut or damaged); None if there is no output.  Raises if it passes the limit."""
    parts: list[bytes] = []
    size = 0
    rest: bytes | None = data
    while rest and _HEADER.match(rest[:2].decode("latin-1")):
        text, after = _member(rest, limit - size + 1)
        size += len(text)
        if size > limit:
            raise _TooLarge
        if after is None and not text:
            break  # only looks like a header
        parts.append(text)
        rest = after if after is None else after.lstrip(b"\0")
    return (b"".join(parts), rest) if size else None


def _text(data: bytes) -> str | None:
    """Clean text; other bytes are a layer of their own."""
    try:
        text = data.decode()
    except UnicodeDecodeError:
        return None
    return None if not text or _BINARY.search(text) else text


def _percent(m: re.Match) -> list[tuple[int, int, str]]:
    """Decoded bytes with the offsets of their escapes; patterns and further escapes are ASCII, so bytes do."""
    return [(3 * i, 3 * i + 3, c) for i, c in enumerate(bytes.fromhex(m[0].replace("%", "")).decode("latin-1"))]


def _literal(m: re.Match) -> list[tuple[int, int, str]]:
    """An escape of a byte string."""
    code = m[0][1:]
    char = chr(int(code[1:], 16)) if code[0] == "x" else chr(int(code, 8) & 255) if code[0] in "01234567" else _C_ESCAPES[code]
    return [(0, len(m[0]), char)]


def _unicode(m: re.Match) -> list[tuple[int, int, str]]:
    if m[2]:
        units = [int(x, 16) for x in m[2].split("\\u")[1:]]
        out, i = [], 0
        while i < len(units):
            pair = 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units) and 0xDC00 <= units[i + 1] < 0xE000
            code = 0x10000 + ((units[i] - 0xD800) << 10) + units[i + 1] - 0xDC00 if pair else units[i]
            out.append((6 * i, 6 * (i + 1 + pair), "\ufffd" if 0xD800 <= code < 0xE000 else chr(code)))
            i += 1 + pair
        return out
    code = int(m[1] or m[3] or m[4] or m[5] or "0", 16) or int(m[6] or 0)
    return [(0, len(m[0]), chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "\ufffd")]


def _bytes(body: str) -> bytes:
    """Base64 without padding; a last character that holds no whole byte is left out."""
    body = body.translate(_URL_SAFE)
    body = body[:-1] if len(body) % 4 == 1 else body
    return binascii.a2b_base64(body + "=" * (-len(body) % 4))


def _whole(data: bytes, a: int, b: int) -> Layer:
    """A layer of bytes that all come from the source span [a, b)."""
    return data.decode("latin-1"), [a] * len(data), [b] * len(data), [True] * len(data)


class _Decoder:
    """The decoders of one worklist; pieces that are no clean text become layers of their own."""

    def __init__(self, limit: int):
        self.limit = limit
        self.bombs: list[Span] = []

    def steps(self, layer: Layer) -> Iterator[Layer]:
        own: list[Layer] = []
        rewritten = [_rewrite(layer, _PERCENT, _percent), _rewrite(layer, _UNICODE, _unicode)]
        if "\\x" in layer[0]:
            rewritten.append(_rewrite(layer, _LITERAL, _literal))
        rewritten.append(_rewrite(layer, _BASE64, lambda m: self._base64(m, layer, own)))
        yield from (x for x in rewritten if x is not None)
        yield from own
        yield from _joined(layer)
        if True in layer[3]:
            yield from self._packed(layer)

    def _inflated(self, data: bytes, a: int, b: int) -> tuple[bytes, bytes | None] | None:
        """As ``_unpack``; a piece that passes the limit is noted and has neither output nor rest."""
        try:
            return _unpack(data, self.limit)
        except _TooLarge:
            self.bombs.append(("bomb", a, b))
            return b"", None

    def _base64(self, m: re.Match, layer: Layer, own: list[Layer]) -> list[tuple[int, int, str]] | None:
        _, start, stop, _ = layer
        body = m[0].rstrip("=")
        data = _bytes(body)
        if _HEADER.match(data[:2].decode("latin-1")):
            a, b = min(start[m.start() : m.end()]), max(stop[m.start() : m.end()])
            done = self._inflated(data, a, b)
            if done == (b"", None):
                return None
            text = _text(done[0]) if done and done[1] == b"" else None
            if text:
                return [(0, len(m[0]), c) for c in text]
        text = _text(data) if len(body) % 4 != 1 else None
        if text is None:
            at = range(m.start(), m.start() + len(body))
            own.append(_spread(data, [start[i] for i in at], [stop[i] for i in at]))
            return None
        out, at = [], 0
        for c in text:
            size = len(c.encode())
            out.append((at // 3 * 4 + at % 3, min(len(m[0]), (at + size - 1) // 3 * 4 + (at + size - 1) % 3 + 2), c))
            at += size
        return out

    def _packed(self, layer: Layer) -> Iterator[Layer]:
        """The output of compressed streams that start anywhere in a layer."""
        text, start, stop, new = layer
        done = 0
        for m in _HEADER.finditer(text):
            i = m.start()
            if i < done or True not in new[i : i + 16]:
                continue
            try:
                zlib.decompressobj(47).decompress(text[i : i + 64].encode("latin-1", "ignore"), 64)
            except zlib.error:
                if text[i] != "\x1f":
                    continue  # ordinary characters
            end = _BYTES.match(text, i).end()
            data = text[i:end].encode("latin-1")
            found = self._inflated(data, min(start[i:end]), max(stop[i:end]))
            if found is None:
                continue
            out, rest = found
            if not out:
                done = end
                continue
            if rest is not None:  # what follows stays in this layer
                end = done = end - len(rest)
            yield _whole(out, min(start[i:end]), max(stop[i:end]))


def _spread(data: bytes, start: list[int], stop: list[int]) -> Layer:
    """Bytes of base64 characters that come from the given source spans."""
    at = [k // 3 * 4 + k % 3 for k in range(len(data))]
    return data.decode("latin-1"), [start[i] for i in at], [stop[i + 1] for i in at], [True] * len(data)


def _joined(layer: Layer) -> Iterator[Layer]:
    """Base64 wrapped over lines as one piece.  A word before the first line may have joined the
    run, so it is decoded from each of its first four characters."""
    text, start, stop, _ = layer
    if "\n" not in text:
        return
    for m in _WRAPPED.finditer(text):
        at = [i for i in range(m.start(), m.end()) if text[i] not in "=\r\n\t\x20"]
        if len(at) < 16:
            continue
        body = "".join([text[i] for i in at])
        a, b = [start[i] for i in at], [stop[i] for i in at]
        for k in range(4):
            yield _spread(_bytes(body[k:]), a[k:], b[k:])


def _rewrite(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every piece that the decoder accepts replaced; None if there is none."""
    text, start, stop, new = layer
    chars: list[str] = []
    a: list[int] = []
    b: list[int] = []
    n: list[bool] = []
    done = 0
    for m in pattern.finditer(text):
        pieces = decode(m)
        if not pieces:
            continue
        chars.append(text[done : m.start()])
        a += start[done : m.start()]
        b += stop[done : m.start()]
        n += new[done : m.start()]
        for i, j, c in pieces:
            chars.append(c)
            a.append(start[m.start() + i])
            b.append(stop[m.start() + j - 1])
        n += [True] * len(pieces)
        done = m.end()
    if not done:
        return None
    chars.append(text[done:])
    return "".join(chars), a + start[done:], b + stop[done:], n + new[done:]


def layers(line: str, offset: int, limit: int = MAX_LAYER_BYTES) -> tuple[list[Layer], list[Span]]:
    """Every decoded layer of a line, and the pieces too large to unpack."""
    work: list[Layer] = [(line, list(range(offset, offset + len(line))), list(range(offset + 1, offset + len(line) + 1)), [False] * len(line))]
    # Equal bytes from different places are different layers: each has spans of its own.
    seen = {_digest(work[0])}
    out: list[Layer] = []
    decoder = _Decoder(limit)
    while work:
        for made in decoder.steps(work.pop()):
            key = _digest(made)
            if key not in seen:
                seen.add(key)
                out.append(made)
                work.append(made)
    return out, decoder.bombs


def _digest(layer: Layer) -> tuple[bytes, int, int]:
    text, start, stop, _ = layer
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest(), min(start, default=0), max(stop, default=0)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def _units(text: str) -> Iterator[tuple[int, int]]:
    """Lines with an encoded piece; lines that share wrapped base64 are one unit."""
    wrapped = iter(_WRAPPED.finditer(text) if "\n" in text else ())
    run = next(wrapped, None)
    end = -1
    for m in _ENCODED.finditer(text):
        if m.start() < end:
            continue
        start = text.rfind("\n", 0, m.start()) + 1
        end = text.find("\n", m.start())
        end = len(text) if end < 0 else end
        while run and run.end() <= start:
            run = next(wrapped, None)
        while run and run.start() < end:
            start = min(start, text.rfind("\n", 0, run.start()) + 1)
            if run.end() > end:
                end = text.find("\n", run.end())
                end = len(text) if end < 0 else end
            run = next(wrapped, None)
        yield start, end


def find(text: str | None, limit: int = MAX_LAYER_BYTES) -> tuple[list[Span], list[Span], int]:
    """(base spans, all spans, number of decoded layers); offsets in code points."""
    if not text:
        return [], [], 0
    base = sorted(scan(text), key=_order)
    added: set[Span] = set()
    n_layers = 0
    for start, end in _units(text):
        made, bombs = layers(text[start:end], start, limit)
        n_layers += len(made)
        added.update(bombs)
        for body, a, b, new in made:
            for kind, i, j in scan(body):
                if True in new[i:j]:
                    added.add((kind, min(a[i:j]), max(b[i:j])))
    return base, sorted({*base, *added}, key=_order), n_layers


def _written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{i}:{j}" for k, i, j in spans)


def _scanned(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                rows = [find(t, limit) for t in part.column(1).to_pylist()]
                count = {k: pa.array([sum(s[0] == k for s in base) for base, _, _ in rows], pa.int64()) for k in KINDS[:3]}
                yield pa.record_batch({
                    "doc_id": part.column(0).cast(pa.int64()), **{f"n_{k}": v for k, v in count.items()},
                    "base_sha256": pa.array([hashlib.sha256(_written(base).encode()).hexdigest() for base, _, _ in rows], pa.string()),
                    "spans": pa.array([_written(all_) for _, all_, _ in rows], pa.string()),
                    "n_layers": pa.array([n for _, _, n in rows], pa.int64()),
                    "found": pa.array([[{"kind": k, "start": i, "stop": j} for k, i, j in all_] for _, all_, _ in rows],
                                      pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())])))})

    return run


def mask(text: str | None, mark: str = "[SECRET]", limit: int = MAX_LAYER_BYTES) -> str | None:
    """The text with every span (overlapping ones merged) replaced by ``mark``."""
    spans = find(text, limit)[1]
    if not spans:
        return text
    out, done, last = [], 0, -1
    for _, i, j in spans:
        if i >= last:
            out += [text[max(done, 0) : i], mark]
        last = done = max(last, j)
    return "".join([*out, text[done:]])


def _masked(mark: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            at = names.index("text")
            for part in slices(batch, at):
                texts = [mask(t, mark, limit) for t in part.column(at).to_pylist()]
                columns = list(part.columns)
                columns[at] = pa.array(texts, part.schema.field(at).type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    same = part.column(at).to_pylist()
                    old = part.column(k).to_pylist()
                    columns[k] = pa.array([o if t == s else len(t) for o, t, s in zip(old, texts, same)], part.schema.field(k).type)
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return run


def secrets(docs: DataFrame, max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """One row per document: base counts, their digest, all spans and the decoded layers."""
    importable(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_scanned(max_layer_bytes), SCHEMA)


def redact(docs: DataFrame, mark: str = "[SECRET]", max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """The documents with every secret replaced by ``mark``; ``n_chars``, if there, follows."""
    importable(docs.sparkSession)
    return docs.mapInArrow(_masked(mark, max_layer_bytes), docs.schema)

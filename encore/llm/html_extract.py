"""HTML extraction by union-free regular-expression inference.

Pages become token trees.  Trees of one host are aligned one after another into a wrapper:
equal neighbours fold into a repeated group, children found in one side only become an
optional group, and texts become slots.  A wrapper is thus a union-free expression over tags,
``?``, ``+`` and ``#`` (text).  Slots carry how much text and link text they held, on how many
pages, whether it was always the same and whether these pages differ (copies of an article
are no evidence of a template).  From the wrapper the content slots of the host follow: those
under ``article`` or ``main`` where the template has one, otherwise the slots that are no
links; blocks whose text is the same on two or more pages that differ are left out, in an
article if half of the host's pages hold them and they are no headings or captions.  Menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts and styles never are.  Inside ``article`` or ``main`` a class or id
that only sounds like one of these (``related-work``, ``share-prices``) drops an element only if
its text is the same on pages of the host that differ, or mostly links.

Distribution: tasks fold their own pages first (equal trees of a host count once), the folds
are summed by (host, bucket) and then by host, each as a stream, so a host with a third of
all pages is spread over ``BUCKETS`` groups and nothing is collected.  Wrappers join the pages
on the host: broadcast while their size is under ``MAX_BROADCAST_BYTES``, else by a shuffle.

Edge cases: null or empty html gives an empty text; a page without a host (null or odd url)
belongs to the host ''.  Unclosed and truncated markup is closed as browsers do it.  Where no
content slot of the wrapper occurs in a page, the page's own tree decides.  Repeated rows give
a row each; extra columns are ignored."""

from __future__ import annotations

import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import importable, slices, stored

BUCKETS = 32
MAX_DEPTH = 256  # elements nested deeper stand in the one at this depth, with all their text
EXACT_PAIRS = 10_000  # child lists of a larger product are aligned by steps of bounded cost
STEP_EDITS = 200
MAX_BROADCAST_BYTES = 16 << 20
SCHEMA = "page_id long, url string, text string, n_chars long"

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\s*[^\s=>"']+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>"']*))?|[\s"'=])*+)\s*/?>|</?[a-zA-Z][^>]*(?:>|\Z)|<|[^<]+""", re.S)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
# Fixed sets of HTML element names.
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp", "noembed", "noframes"}
_RAW_END = {name: re.compile(rf"</{name}(?![^\s/>])", re.I) for name in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
           "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
           "var", "wbr"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4",
             "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NEVER = {"head", "nav", "aside", "form", "button", "select", "input", "dialog", "menu", "footer", "canvas", "audio", "video",
          *_RAW}
_NOT_CONTENT = re.compile(
    r"(?:^|[\s#_-])(?:ads?|advert\w*|adsense|banner|breadcrumbs?|comments?|respond|cookies?|consent|disclaimer|footer|masthead|menu|modal|nav\w*|"
    r"newsletter|notices?|notification|pager|pagination|popup|promo\w*|related|share\w*|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|"
    r"widget|skip|login|signup|search)(?:$|[\s_-])", re.I)
# Whole class or id names that mean page furniture wherever they stand; the words above may be an article's own.
_FURNITURE = re.compile(
    r"(?:^|[\s#])(?:ads?(?:[-_]?9)?|advert|advertisement|adsense|sponsored|comments?(?:[-_](?:9|list|section|thread|area|form|body))?|respond|"
    r"cookie[-_]?(?:bar|banner|consent|notice)|newsletter|breadcrumbs?|pagination|pager|sidebar|navbar|navigation|footer|masthead)(?:$|\s)", re.I)
_SECTIONS = {"h1", "h2", "h3", "h4", "h5", "h6", "section"}  # their ids are made from their headings
_LABELS = {"h1", "h2", "h3", "h4", "h5", "h6", "th", "dt", "caption", "figcaption", "summary"}  # may well be the same in every article
_ROLES = re.compile(r"(?:navigation|banner|contentinfo|complementary|search|form|alert|dialog)$", re.I)


_hash = xxhash.xxh3_64_intdigest


class Node:
    """An element of a page or wrapper; ``key`` is its tag with class and #id."""

    __slots__ = ("key", "children", "repeated", "optional", "chars", "links", "same", "source", "pages", "text")

    def __init__(self, key: str):
        self.key = key
        self.children: list[Node] = []
        self.repeated = self.optional = False
        self.chars = self.links = 0
        self.same: int | None = None  # digest of the slot's text on a page while equal on all, -1 after
        self.pages = 0  # pages that held the slot; of the root: all pages
        self.source: int | None = None  # digest of the page that held the slot, -1 after a different page held it too
        self.text = ""

    @property
    def tag(self) -> str:
        return self.key.partition("|")[0]

    def dump(self) -> list:
        return [self.key, self.repeated + 2 * self.optional, self.chars, self.links, self.same, self.source, self.pages, [c.dump() for c in self.children]]

    @classmethod
    def load(cls, data: list) -> "Node":
        node = cls(data[0])
        node.repeated, node.optional = bool(data[1] & 1), bool(data[1] & 2)
        node.chars, node.links, node.same, node.source, node.pages = data[2:7]
        node.children = [cls.load(c) for c in data[7]]
        return node


def _key(tag: str, attributes: str) -> str:
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").strip() for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
    marks = " ".join(sign + re.sub(r"\d+", "9", found[a]) for a, sign in (("class", ""), ("id", "#")) if found.get(a))
    role = found.get("role", "")
    return f"{tag}|{' '.join(marks.split())}|{role}" if marks.strip() or role else tag


def parse(source: str | None) -> Node:
    """The page as a tree; text nodes have the key ``#`` and their decoded text."""
    root = Node("root")
    stack = [root]
    beyond: Counter[str] = Counter()  # open elements that were not put on the stack, by name
    source = source or ""
    at = 0
    while m := _TOKEN.match(source, at):
        at = m.end()
        token = m[0]
        name = (m[2] or "").lower()
        if not token.startswith("<") or token == "<":
            node = Node("#")
            node.text = entities.unescape(token)
            stack[-1].children.append(node)
            continue
        if not name:
            continue
        if m[1]:
            if beyond[name]:
                beyond[name] -= 1
                continue
            opened = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == name), 0)
            if opened:
                del stack[opened:]
                beyond.clear()
            continue
        if name in _CLOSES_P:
            _close(stack, {"p"}, {"td", "th", "table", "button", "object"})
        if name in _SIBLINGS:
            _close(stack, _SIBLINGS[name], {"ul", "ol", "dl", "table", "select"})
        node = Node(_key(name, m[3]))
        stack[-1].children.append(node)
        if name in _RAW:
            if not (token.endswith("/>") and name == "svg"):  # no markup inside: on to the end tag
                end = _RAW_END[name].search(source, at)
                at = end.start() if end else len(source)
        elif name not in _VOID:
            if len(stack) < MAX_DEPTH:
                stack.append(node)
            else:
                beyond[name] += 1
    return root


def _close(stack: list[Node], tags: set[str], scope: set[str]) -> None:
    """Close the nearest open element of ``tags``, unless a ``scope`` element stands between."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in scope:
            return


def fold(page: Node) -> Node:
    """A page tree as a wrapper: texts become slots, equal neighbours a repeated group."""
    out = _fold(page, False, _digest(page))
    out.pages = 1
    return out


def _digest(page: Node) -> int:
    """Digest of the article's text, or of the page's: pages that differ only around it are copies."""
    rooted = _rooted(page)
    out: list[str] = []

    def walk(node: Node, inside: int) -> None:
        for c in node.children:
            if c.key == "#":
                if inside or not rooted:
                    out.extend(c.text.split())
            elif not excluded(c, inside):
                walk(c, _inside(c, inside))

    walk(page, 0)
    return _hash(" ".join(out).encode("utf-8", "surrogatepass"))


def _fold(node: Node, in_link: bool, source: int) -> Node:
    out = Node(node.key)
    for child in node.children:
        if child.key == "#":
            words = " ".join(child.text.split())
            if not words:
                continue
            slot = Node("#")
            slot.chars, slot.links = len(words), len(words) if in_link else 0
            slot.same, slot.source, slot.pages = _hash(words.encode("utf-8", "surrogatepass")), source, 1
            _append(out.children, slot, True)
        else:
            _append(out.children, _fold(child, in_link or child.tag == "a", source), True)
    return out


def _append(children: list[Node], node: Node, one_page: bool = False) -> None:
    if children and children[-1].key == node.key:
        children[-1] = merge(children[-1], node, one_page)
        children[-1].repeated = True
    else:
        children.append(node)


def merge(a: Node, b: Node, one_page: bool = False) -> Node:
    """Align two wrappers of the same element; neighbours on one page keep the digest of their run."""
    out = Node(a.key)
    out.repeated, out.optional = a.repeated or b.repeated, a.optional or b.optional
    out.chars, out.links = a.chars + b.chars, a.links + b.links
    out.same = a.same if a.same == b.same else -1
    out.source = a.source if a.source == b.source else -1
    out.pages = max(a.pages, b.pages) if one_page else a.pages + b.pages
    if one_page and a.same is not None:
        out.same = _hash(b"%d %d" % (a.same, b.same))
    if not a.children and not b.children:
        return out
    left, right = [c.key for c in a.children], [c.key for c in b.children]
    blocks = [(0, 0, len(left))] if left == right else _aligned(left, right)
    i = j = 0
    for x, y, size in blocks:
        for c in (*a.children[i:x], *b.children[j:y]):  # a mismatch: an optional group
            c.optional = True
            _append(out.children, c, one_page)
        for k in range(size):
            _append(out.children, merge(a.children[x + k], b.children[y + k], one_page), one_page)
        i, j = x + size, y + size
    for c in (*a.children[i:], *b.children[j:]):
        c.optional = True
        _append(out.children, c, one_page)
    return out


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """Matching blocks (place in a, place in b, length) in order."""
    if len(a) * len(b) <= EXACT_PAIRS:
        return SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
    blocks: list[tuple[int, int, int]] = []
    i = j = 0
    while i < len(a) and j < len(b):
        i, j, found = _step(a, b, i, j)
        blocks += found
    return blocks


def _step(a: list[str], b: list[str], i: int, j: int) -> tuple[int, int, list[tuple[int, int, int]]]:
    """From (i, j) the furthest point that at most STEP_EDITS insertions and deletions reach, and
    the matches on the way: the greedy edit graph search, cut off so that its cost is bounded."""
    reach, trail = {1: i}, []
    best = (i, j, 0, 0)
    for edits in range(STEP_EDITS + 1):
        trail.append(dict(reach))
        for k in range(-edits, edits + 1, 2):
            down = k == -edits or (k != edits and reach.get(k - 1, -1) < reach.get(k + 1, -1))
            x = reach[k + 1] if down else reach[k - 1] + 1
            y = x - i - k + j
            if x > len(a) or y > len(b):
                reach[k] = x
                continue
            while x < len(a) and y < len(b) and a[x] == b[y]:
                x, y = x + 1, y + 1
            reach[k] = x
            if x + y > best[0] + best[1]:
                best = (x, y, edits, k)
            if x == len(a) and y == len(b):
                break
        if best[:2] == (len(a), len(b)):
            break
    x, y, edits, k = best
    if (x, y) == (i, j):  # nothing in reach: leave one of each out
        return i + 1, j + 1, []
    blocks: list[tuple[int, int, int]] = []
    at_x, at_y = x, y
    for d in range(edits, -1, -1):  # back along the trail
        before = trail[d]
        down = k == -d or (k != d and before.get(k - 1, -1) < before.get(k + 1, -1))
        start = i if d == 0 else before[k + 1] if down else before[k - 1] + 1
        size = at_x - start
        if size > 0:
            blocks.append((start, at_y - size, size))
        if d:
            at_x, at_y = (start, at_y - size - 1) if down else (start - 1, at_y - size)
            k += 1 if down else -1
    return x, y, blocks[::-1]


def expression(node: Node) -> str:
    """The wrapper as a union-free regular expression."""
    if node.key == "#":
        body = "#"
    else:
        inner = "".join(expression(c) for c in node.children)
        body = f"<{node.key}>{inner}</{node.tag}>"
    mark = "+" * node.repeated + "?" * node.optional
    return f"({body}){mark}" if mark and body != "#" else body + mark


def _inside(node: Node, inside: int) -> int:
    """2 in an article, 1 in a main element, 0 in neither."""
    return 2 if node.tag == "article" else max(inside, node.tag == "main")


def excluded(node: Node, inside: int) -> bool:
    """Menus, headers, adverts and the like, by element, class, id and role; words that may be an
    article's own count outside it only (see ``marked``)."""
    tag, _, marks = node.key.partition("|")
    if tag in _NEVER or (tag == "header" and not inside):
        return True
    if not marks or tag in ("html", "body", "article", "main"):
        return False
    names, _, role = marks.rpartition("|")
    if _ROLES.match(role):
        return True
    if inside:
        return bool(_FURNITURE.search(names.partition("#")[0] if inside == 2 and tag in _SECTIONS else names))
    return bool(_NOT_CONTENT.search(names))


def marked(node: Node) -> bool:
    """Does an element of an article bear a word of menus, adverts and the like?  The wrapper decides then."""
    tag, _, marks = node.key.partition("|")
    if not marks or tag in ("article", "main"):
        return False
    names = marks.rpartition("|")[0]
    return bool(_NOT_CONTENT.search(names.partition("#")[0] if tag in _SECTIONS else names))


def _rooted(node: Node) -> bool:
    """Does the tree have an article or main element?"""
    return any((c.tag in ("article", "main") or _rooted(c)) and not excluded(c, 0) for c in node.children if c.key != "#")


def _constant(slot: Node) -> bool:
    """The same text on two or more pages that differ."""
    return slot.source == -1 and slot.same != -1


def _template(node: Node) -> bool:
    """Is all text of an element constant, or the rest mostly links?"""
    chars = links = 0
    todo = [node]
    while todo:
        for c in todo.pop().children:
            if c.key != "#":
                todo.append(c)
            elif not _constant(c):
                chars += c.chars
                links += c.links
    return links * 2 >= chars


def content_paths(wrapper: Node) -> set[str]:
    """Paths of the elements whose text is content.  A block is judged as one, so that a word in
    bold that all pages share stays in its sentence."""
    rooted = _rooted(wrapper)
    blocks: list[tuple[str, list[tuple[str, Node]]]] = []  # tag, and path and slot of its own texts

    def walk(node: Node, path: str, inside: int, own: list[tuple[str, Node]]) -> None:
        for c in node.children:
            if c.key == "#":
                if inside if rooted else c.links * 2 < c.chars:
                    own.append((path, c))
            elif not excluded(c, inside) and not (inside and marked(c) and _template(c)):
                if c.tag in _INLINE:
                    walk(c, f"{path}/{c.key}", _inside(c, inside), own)
                else:
                    block: list[tuple[str, Node]] = []
                    blocks.append((c.tag, block))
                    walk(c, f"{path}/{c.key}", _inside(c, inside), block)

    blocks.append((wrapper.tag, []))
    walk(wrapper, "", 0, blocks[0][1])

    def varies(own: list[tuple[str, Node]]) -> bool:
        # An article's own constant text must be on most pages of the host: two near copies may share a rare one.
        return not all(_constant(c) and (not rooted or c.pages * 2 >= wrapper.pages) for _, c in own)

    told = [(tag, own, varies(own)) for tag, own in blocks if own]
    if rooted and not any(v for tag, _, v in told if tag not in _LABELS):  # one article under several titles
        told = [(tag, own, True) for tag, own, _ in told]
    return {path for tag, own, v in told if v or (rooted and tag in _LABELS) for path, _ in own}


def text_of(page: Node, paths: set[str]) -> str:
    """Blocks of the page's content in order, one to a line."""
    blocks: list[list[str]] = [[]]

    def walk(node: Node, path: str, inside: int) -> None:
        for c in node.children:
            if c.key == "#":
                if path in paths:
                    blocks[-1].append(c.text)
                continue
            if c.tag == "br":
                blocks[-1].append(" ")
            if excluded(c, inside):
                blocks.append([])
                continue
            block = c.tag not in _INLINE
            if block:
                blocks.append([])
            walk(c, f"{path}/{c.key}", _inside(c, inside))
            if block:
                blocks.append([])

    walk(page, "", 0)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def extract(source: str | None, paths: set[str] | None) -> str:
    page = parse(source)
    text = text_of(page, paths) if paths else ""
    return text or text_of(page, content_paths(fold(page)))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, bucket, wrapper) of the pages of each slice."""
    for batch in batches:
        for part in slices(batch, 1):
            held: dict[str, Node] = {}
            for host, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                made = fold(parse(source))
                held[host] = merge(held[host], made) if host in held else made
            rows = sorted(held.items())
            dumped = [json.dumps(n.dump()) for _, n in rows]
            yield pa.record_batch({"host": pa.array([h for h, _ in rows], pa.string()),
                                   "bucket": pa.array([zlib.crc32(d.encode()) % BUCKETS for d in dumped], pa.int32()),
                                   "wrapper": pa.array(dumped, pa.string())})


def _summed(last: bool):
    """Fold a sorted stream of (host, bucket, wrapper): memory holds one wrapper at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, node = None, None
        for batch in batches:
            for host, bucket, dumped in zip(*(c.to_pylist() for c in batch.columns)):
                key = (host, 0 if last else bucket)
                made = Node.load(json.loads(dumped))
                if key != now:
                    if node is not None:
                        yield done(now, node)
                    now, node = key, made
                else:
                    node = merge(node, made)
        if node is not None:
            yield done(now, node)

    def done(key: tuple[str, int], node: Node) -> pa.RecordBatch:
        return pa.record_batch({"host": pa.array([key[0]], pa.string()), "bucket": pa.array([key[1]], pa.int32()),
                                "wrapper": pa.array([json.dumps(node.dump())], pa.string())})

    return run


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper): the union-free expression of each host as JSON."""
    importable(pages.sparkSession)
    schema = "host string, bucket int, wrapper string"
    own = pages.select(_host().alias("host"), "html").mapInArrow(_folded, schema)
    part = (own.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "wrapper").mapInArrow(_summed(False), schema))
    whole = part.repartition("host").sortWithinPartitions("host", "bucket").mapInArrow(_summed(True), schema)
    return whole.select("host", "wrapper")


def _host():
    return F.lower(F.coalesce(F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[str]] = {}
    for batch in batches:
        for part in slices(batch, 2):
            ids, urls, pages, made = part.columns
            texts = []
            for source, dumped in zip(pages.to_pylist(), made.to_pylist()):
                if dumped is not None and dumped not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[dumped] = content_paths(Node.load(json.loads(dumped)))
                texts.append(extract(source, known.get(dumped)))
            yield pa.record_batch({"page_id": ids.cast(pa.int64()), "url": urls, "text": pa.array(texts, pa.string()),
                                   "n_chars": pa.array([len(t) for t in texts], pa.int64())})


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and the text's length."""
    importable(pages.sparkSession)
    made = stored(wrappers(pages), "wrappers")
    size = made.agg(F.coalesce(F.sum(F.octet_length("wrapper")), F.lit(0))).first()[0]
    made = F.broadcast(made) if size <= MAX_BROADCAST_BYTES else made
    joined = pages.select("page_id", "url", "html", _host().alias("host")).join(made, "host", "left")
    return joined.select("page_id", "url", "html", "wrapper").mapInArrow(_extracted, SCHEMA)

"""Main text of web pages by wrappers: union-free regular expressions inferred for each host.

A page is a stream of text blocks; a block's symbol is the path of the block elements around
it (names, classes, ids; digits become 0). Runs of a repeated block or group of blocks fold
into one repeated node. Aligning two streams keeps what they have in common, makes what only
one has optional, folds what then repeats, and turns a text that differs into a slot; a text
that never differs stays a constant of the template.

Inference in mergeable steps: each task folds its pages by host and stream shape; Spark adds up
the nodes of equal shapes; shapes align in parts of PART, those wrappers in parts of PART, and so
on. A task holds PART streams, whatever a host's size or variety.

A page is then matched against its host's wrapper: each of its blocks is one of a node. The nodes
tell what is main text. The main container is found from the root on: an element goes on to the
child that has DOMINANT of its slots' unlinked text, down to an article or main element. Text
under it is main text, and so are headings and paragraphs beside it on the way there. Out go
nodes that are constants on a SHARE of the host's pages of different text, LEAST_PAGES at least;
containers of links outside an article; and navigation, footers, forms and the like, by element.
A few words of classes and ids are a prior: a whole class or id of STRONG_WORDS leaves its element
out, one of WEAK_WORDS within a longer name only where the element's blocks are no prose.
A page without anything in its host's main container is judged by its own blocks.

Edge cases: a null url is the empty host; null or empty html, or html without main text, gives
an empty text. Raw text elements (scripts, styles and the like) and comments give no blocks; one
that is never closed takes nothing but the text up to the next tag. Elements nest DEPTH deep, and
further ones count as their parents. Repeated rows, also of one id, are extracted each for itself.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkurate.llm import common

#: How many streams or partial wrappers of a host one task aligns, and of how many bytes.
PART = 256
PART_BYTES = 8 << 20
#: Template text is on this share of a host's pages of different text (of some 270 where there are more).
SHARE = 0.25
LEAST_PAGES = 3
DOMINANT = 0.75
PROSE = 25
SHORT = 60
LINKED = 0.8
DEPTH = 128
PERIOD = 6
#: Up to so many bytes wrappers are broadcast; beyond, a join with pages dealt by host and salt.
BROADCAST_BYTES = 16 << 20
PAGES_A_SALT = 2_000
#: A host's pages of different text are counted in so many bitmaps of 64, each for half as many; one of more bits than FULL is full.
LEVELS, FULL = 24, 45
_LEVEL = (1 << 64) - 1
#: Up to so many hosts of more pages than that, the number of their salts is broadcast.
BROADCAST_HOSTS = 100_000

RAW = {"script", "style", "noscript", "template", "iframe", "object", "svg", "textarea", "select", "button"}
VOID = {"area", "base", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "br"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
IN_HEAD = {"title", "meta", "link", "base", "style", "script", "noscript", "template"}
#: An element of this name ends an open one of these.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LIMITS = {"ul", "ol", "dl", "table", "article", "section", "div", "body"}
ASIDE = {"nav", "footer", "aside", "form", "head", "title", "menu", "dialog", "fieldset"}
CONTENT = {"article", "main"}
CONTAINERS = {"div", "section", "center", "article", "main", "header"}
LISTS = {"ul", "ol", "dl", "table"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
STRONG_WORDS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar sidebars footer masthead"
    " comment comments disqus cookie cookies consent notice notices popup modal overlay newsletter subscribe share sharing social related pagination pager toolbar taboola outbrain disclaimer".split()
)
WEAK_WORDS = STRONG_WORDS | set("legal copyright alert alerts search skip login signin signup reply replies respond recommended widget widgets promotion subscription header aside form".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>",
    re.S,
)
_MARK = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
#: The next start or end of an element whose contents aren't text.
_RAW_ENDS = {name: re.compile(rf"<(/?){name}(?=[\s/>])[^>]*>?|<(/?){name}\Z", re.I) for name in RAW}
_NESTED = {"object", "svg"}
_PARTS = re.compile(r"[a-z]+")
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _symbol(name: str, rest: str) -> str:
    marks = []
    if rest and "=" in rest:
        for key, *values in _MARK.findall(rest):
            value = _DIGITS.sub("0", " ".join(sorted("".join(values).lower().split())))
            if value:
                marks.append({"c": ".", "i": "#", "r": "@"}[key[0].lower()] + value.replace("/", " "))
    return name + "".join(sorted(marks))


def _past(name: str, page: str, at: int) -> int:
    """Where the raw element that opens before this place ends; there itself if it is never closed."""
    depth, look = 1, at
    while True:
        m = _RAW_ENDS[name].search(page, look)
        if not m:
            return at
        look = m.end()
        if m[0].startswith("</"):
            depth -= 1
            if not depth:
                return look
        elif name in _NESTED:
            depth += not m[0].endswith("/>")
        elif name not in ("script", "style"):
            return at  # another one opens first: this one is unclosed


def blocks(page: str) -> list[tuple[str, str, int]]:
    """(symbol, text, linked) of every block with text, in page order; linked counts its text in links."""
    found: list[tuple[str, str, int]] = []
    names: list[str] = []
    symbols: list[str] = []
    pieces: list[str] = []
    at = linked = 0
    link = skip = False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = "".join(pieces)
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                found.append(("/".join(symbols), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def cut(depth: int) -> None:
        flush()
        del names[depth:], symbols[depth:]

    def add(piece: str) -> None:
        nonlocal linked
        pieces.append(piece)
        if link:
            linked += len(piece)

    while True:
        m = _TAG.search(page, at)
        if (m.start() if m else len(page)) > at and not skip:
            add(page[at : m.start() if m else len(page)])
        skip = False
        if not m:
            break
        at = m.end()
        name = m["name"] or m["name2"]
        if not name:
            continue
        name = name.lower()
        end, rest = m["end"] or m["end2"], m["rest"] or m["rest2"] or ""
        if name in RAW:
            if not end and not rest.endswith("/"):
                past = _past(name, page, at)
                skip, at = past == at, past
            pieces.append(" ")
            continue
        if name in INLINE:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                link = not end
            continue
        if name in ("html", "body"):
            flush()
            if name == "body" and "head" in names:
                cut(names.index("head"))
            continue
        if end:
            flush()
            for depth in range(len(names) - 1, -1, -1):
                if names[depth] == name:
                    cut(depth)
                    break
            continue
        flush()
        if "head" in names and name not in IN_HEAD:
            cut(names.index("head"))
        if "p" in names:
            cut(names.index("p"))
        ended = ENDS.get(name)
        if ended:
            for depth in range(len(names) - 1, -1, -1):
                if names[depth] in ended:
                    cut(depth)
                    break
                if names[depth] in LIMITS:
                    break
        if name not in VOID and len(names) < DEPTH:
            names.append(name)
            symbols.append(_symbol(name, rest))
    flush()
    return found


def fold(stream: list[str]) -> list[tuple[tuple[str, ...], bool, int, int]]:
    """Nodes (symbols, repeated, first, end) of a stream; the longest repetition at a place wins."""
    nodes, i, n = [], 0, len(stream)
    while i < n:
        best, period = 0, 1
        for p in range(1, min(PERIOD, (n - i) // 2) + 1):
            k = i + p
            while k + p <= n and stream[k : k + p] == stream[i : i + p]:
                k += p
            if k - i > best and k > i + p:
                best, period = k - i, p
        if best:
            nodes.append((tuple(stream[i : i + period]), True, i, i + best))
            i += best
        else:
            nodes.append(((stream[i],), False, i, i + 1))
            i += 1
    return nodes


def text_key(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def page_bit(found: list[tuple[str, str, int]]) -> int:
    """One of LEVELS x 64 bits, by the page's text outside navigation and the like: copies of a page have the same one.

    Half of all pages are in the first 64 bits, a quarter in the next and so on.
    """
    key = text_key("\n\n".join(t for s, t, _ in found if not _aside(s))) + (1 << 63)
    level = min(LEVELS - 1, ((key >> 6) & -(key >> 6)).bit_length() - 1) if key >> 6 else LEVELS - 1
    return 1 << (64 * level + (key & 63))


def different_pages(bits: int) -> float:
    """About how many pages of different text set these bits, to some 10 per cent up to 64 << LEVELS.

    Levels that are nearly full tell nothing; from the first on that isn't, all after it are counted
    (linear counting), and stand for those before.
    """
    counts = [((bits >> (64 * level)) & _LEVEL).bit_count() for level in range(LEVELS)]
    first = next((level for level in range(LEVELS) if max(counts[level:]) <= FULL), LEVELS - 1)
    return sum(64 * math.log(64 / max(1, 64 - n)) for n in counts[first:]) * 2**first


def levels_of(bits: int) -> list[int]:
    """The bits as signed numbers of 64, as Spark has them."""
    return [(x := (bits >> (64 * level)) & _LEVEL) - (1 << 64 if x >> 63 else 0) for level in range(LEVELS)]


def bits_of(levels: list[int]) -> int:
    return sum((x & _LEVEL) << (64 * level) for level, x in enumerate(levels))


class Node:
    """A node of a wrapper: what it matches, on how many pages, and each symbol's texts.

    texts has for each symbol the least and greatest key, and the sums of characters, linked ones,
    those of unlinked prose, and blocks.
    """

    __slots__ = ("bits", "optional", "pages", "repeated", "symbols", "texts")

    def __init__(self, symbols, repeated, optional, texts, pages, bits=0) -> None:
        self.symbols, self.repeated, self.optional, self.texts, self.pages, self.bits = tuple(symbols), repeated, optional, texts, pages, bits

    def join(self, other: Node) -> Node:
        texts = [(min(a[0], b[0]), max(a[1], b[1]), *(x + y for x, y in zip(a[2:], b[2:], strict=True))) for a, b in zip(self.texts, other.texts, strict=True)]
        return Node(self.symbols, self.repeated or other.repeated, self.optional and other.optional, texts, self.pages + other.pages, self.bits | other.bits)

    def row(self) -> list:
        return [list(self.symbols), self.repeated, self.optional, self.texts, self.pages, self.bits]


def common_places(one: list, other: list) -> list[tuple[int, int]]:
    """Places of a long common subsequence of two streams, both rising.

    Symbols that come up once in both are anchors, their longest rising run is kept; between
    anchors it is the same again. Where there are none, small gaps are compared in full and large
    ones taken in order of first fit: no stream takes quadratic time.
    """
    found: list[tuple[int, int]] = []
    gaps = [(0, len(one), 0, len(other))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and one[a] == other[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and one[b - 1] == other[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        if (b - a) * (d - c) <= 4096:
            for i, j, size in SequenceMatcher(None, one[a:b], other[c:d], autojunk=False).get_matching_blocks():
                found.extend((a + i + k, c + j + k) for k in range(size))
            continue
        left, right = Counter(one[a:b]), Counter(other[c:d])
        place = {x: j for j, x in enumerate(other[c:d], c) if right[x] == 1}
        pairs = [(i, place[x]) for i, x in enumerate(one[a:b], a) if left[x] == 1 and x in place]
        anchors = _rising(pairs)
        if anchors:
            found.extend(anchors)
            bounds = [(a - 1, c - 1), *anchors, (b, d)]
            gaps.extend((i + 1, k, j + 1, m) for (i, j), (k, m) in pairwise(bounds))
            continue
        places: dict = {}
        for j in range(c, d):
            places.setdefault(other[j], []).append(j)
        upto = c
        for i in range(a, b):
            fits = places.get(one[i], [])
            k = bisect_left(fits, upto)
            if k < len(fits):
                found.append((i, fits[k]))
                upto = fits[k] + 1
    return sorted(found)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs whose second parts rise; the first ones do."""
    ends: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        k = bisect_left(ends, j)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(j)
            last.append(n)
        else:
            ends[k], last[k] = j, n
    run, n = [], last[-1] if last else -1
    while n >= 0:
        run.append(pairs[n])
        n = before[n]
    return run[::-1]


def align(one: list[Node], other: list[Node]) -> list[Node]:
    """The wrapper of what either matches."""
    if not one or not other:
        for node in one or other:
            node.optional = True
        return one or other
    merged: list[Node] = []

    def add(node: Node) -> None:
        if merged and merged[-1].symbols == node.symbols:  # X? X is (X)+
            both = merged[-1].join(node)
            both.repeated = True
            both.pages = max(merged[-1].pages, node.pages)
            merged[-1] = both
        else:
            merged.append(node)

    i = j = 0
    for a, b in [*common_places([n.symbols for n in one], [n.symbols for n in other]), (len(one), len(other))]:
        for node in one[i:a] + other[j:b]:
            node.optional = True
            add(node)
        if a < len(one):
            pair = one[a].join(other[b])
            pair.optional = one[a].optional or other[b].optional
            add(pair)
        i, j = a + 1, b + 1
    return merged


def expression(nodes: list[Node]) -> str:
    """The wrapper as a union-free regular expression over symbols."""
    return " ".join("(" + " ".join(s or "." for s in n.symbols) + ")" + ("*" if n.optional and n.repeated else "+" if n.repeated else "?" if n.optional else "") for n in nodes)


@lru_cache(1 << 16)
def _elements(symbol: str) -> tuple[tuple[str, frozenset[str], frozenset[str]], ...]:
    """Name, whole classes and ids, and their words, of each element of a path."""
    found = []
    for element in symbol.split("/"):
        name, *marks = re.split(r"[.#@]", element)
        whole = frozenset(x for m in marks for x in m.split())
        found.append((name, whole, frozenset(x for m in whole for x in _PARTS.findall(m))))
    return tuple(found)


@lru_cache(1 << 16)
def _aside(symbol: str) -> bool:
    """Whether the path leads outside the main text by its elements or whole classes and ids.

    What an article stands in or is called doesn't count, but for the elements' names.
    """
    elements = _elements(symbol)
    inmost = max((i for i, e in enumerate(elements) if e[0] in CONTENT), default=-1)
    return any(e[0] in ASIDE or (i > inmost and (not STRONG_WORDS.isdisjoint(e[1]) or (inmost < 0 and e[0] == "header"))) for i, e in enumerate(elements))


def main_symbols(totals: dict[str, tuple[int, int, int, int]]) -> set[str]:
    """The symbols of main text, from each one's blocks, characters, linked ones and those of unlinked prose."""
    below: dict[str, list[int]] = {"": [0, 0, 0, 0]}
    for symbol, (n, chars, linked, prose) in totals.items():
        parts = symbol.split("/") if symbol else []
        for k in range(len(parts) + 1):
            sums = below.setdefault("/".join(parts[:k]), [0, 0, 0, 0])
            for i, x in enumerate((n, chars, linked, 0 if _aside(symbol) else prose)):
                sums[i] += x
    children: dict[str, list[str]] = {}
    for prefix in below:
        if prefix:
            children.setdefault(prefix.rpartition("/")[0], []).append(prefix)
    root = ""
    while _elements(root)[-1][0] not in CONTENT:
        inner = [c for c in children.get(root, []) if _elements(c)[-1][0] in CONTAINERS and below[c][3]]
        semantic = [c for c in inner if _elements(c)[-1][0] in CONTENT]
        best = max(semantic or inner, key=lambda c: below[c][3], default=None)
        if best is None or below[best][3] < (SHARE if semantic else DOMINANT) * below[root][3]:
            break
        root = best
    on_the_way = {root[:i] for i, x in enumerate(root) if x == "/"}
    content = any(e[0] in CONTENT for e in _elements(root))

    def out(prefix: str) -> bool:
        name, _, words = _elements(prefix)[-1]
        n, chars, linked, _ = below[prefix]
        if not content and name in CONTAINERS | LISTS and chars and linked > LINKED * chars:
            return True
        return not WEAK_WORDS.isdisjoint(words) and name not in CONTENT and chars < SHORT * n

    kept = set()
    for symbol in totals:
        if _aside(symbol):
            continue
        parts = symbol.split("/") if symbol else []
        inside = not root or symbol == root or symbol.startswith(root + "/")
        if inside and not any(out("/".join(parts[:k])) for k in range(len(root.split("/")) + 1 if root else 1, len(parts) + 1)):
            kept.add(symbol)
        parent, _, leaf = symbol.rpartition("/")
        name = _elements(leaf)[0][0]
        if not inside and name not in CONTAINERS | LISTS and (parent in on_the_way or (not parent and root and name in HEADINGS)):
            kept.add(symbol)
    return kept


def constants(nodes: list[Node]) -> list[list[int | None]]:
    """For each node and symbol the key of its text if that is the template's."""
    whole = 0
    for n in nodes:
        whole |= n.bits
    least = max(LEAST_PAGES - 0.5, SHARE * different_pages(whole))
    varies = any(t[0] != t[1] for n in nodes for s, t in zip(n.symbols, n.texts, strict=True) if not _aside(s))
    return [[t[0] if varies and t[0] == t[1] and different_pages(n.bits) >= least else None for t in n.texts] for n in nodes]


def _prose(text: str, linked: int) -> int:
    return len(text) - linked if len(text) >= PROSE else 0


def text_of(found: list[tuple[str, str, int]], nodes: list[tuple[tuple[str, ...], list[int | None]]], kept: set[str]) -> str:
    """The main text of a page's blocks, matched against its host's wrapper: nodes' symbols and constants."""
    mine = fold([s for s, _, _ in found])
    at = dict(common_places([n[0] for n in mine], [n[0] for n in nodes]))
    if not any(s in kept for s, _, _ in found):
        kept = main_symbols(_totals(found))
    texts = []
    for i, (symbols, _, first, end) in enumerate(mine):
        fixed = nodes[at[i]][1] if i in at else [None] * len(symbols)
        for k in range(first, end):
            symbol, text, _ = found[k]
            key = fixed[(k - first) % len(symbols)]
            if symbol in kept and (key is None or text_key(text) != key):
                texts.append(text)
    return "\n\n".join(texts)


def _totals(found: list[tuple[str, str, int]]) -> dict[str, tuple[int, int, int, int]]:
    totals: dict[str, tuple[int, int, int, int]] = {}
    for symbol, text, linked in found:
        n, chars, links, prose = totals.get(symbol, (0, 0, 0, 0))
        totals[symbol] = n + 1, chars + len(text), links + linked, prose + _prose(text, linked)
    return totals


_SHAPE = "host string, shape long, place int, part int, symbol string, repeated boolean, low long, high long, blocks long, chars long, linked long, prose long, pages long, " + ", ".join(f"bits{level} long" for level in range(LEVELS))
_KEYS = ["host", "shape", "place", "part", "symbol", "repeated"]
_SUMS = ["blocks", "chars", "linked", "prose", "pages"]


def _shapes(pages: DataFrame) -> DataFrame:
    """Nodes of each host's stream shapes with the range of their text keys, added up.

    A shape goes by the hash of its nodes; each row has its own symbol alone.
    """
    common.ship(pages.sparkSession)
    names = [f.split()[0] for f in _SHAPE.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.bool_()] + [pa.int64()] * (7 + LEVELS)

    def run(batches):
        seen: dict[tuple[str, int], tuple[list, list]] = {}
        held = 0

        def rows():
            columns: list[list] = [[] for _ in names]
            for (host, shape), (nodes, stats) in seen.items():
                for place, ((symbols, repeated), parts) in enumerate(zip(nodes, stats, strict=True)):
                    for part, (symbol, s) in enumerate(zip(symbols, parts, strict=True)):
                        for c, v in zip(columns, (host, shape, place, part, symbol, repeated, *s[:-1], *levels_of(s[-1])), strict=True):
                            c.append(v)
                if len(columns[0]) > 1 << 14:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
                    columns = [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for host, page in zip(common.column_of(batch, "host"), common.column_of(batch, "html"), strict=True):
                host, found = host.as_py(), blocks(page.as_py() or "")
                nodes = fold([s for s, _, _ in found])
                shape = text_key(json.dumps([[s, r] for s, r, _, _ in nodes], ensure_ascii=False))
                if (host, shape) not in seen:
                    seen[host, shape] = [(s, r) for s, r, _, _ in nodes], [[[(1 << 63) - 1, -(1 << 63), 0, 0, 0, 0, 0, 0] for _ in s] for s, _, _, _ in nodes]
                    held += sum(len(s) for s, _, _, _ in nodes)
                bit = page_bit(found)
                for parts, (symbols, _, first, end) in zip(seen[host, shape][1], nodes, strict=True):
                    for k in range(first, end):
                        _, text, linked = found[k]
                        s, key = parts[(k - first) % len(symbols)], text_key(text)
                        s[0], s[1], s[2], s[3], s[4], s[5] = min(s[0], key), max(s[1], key), s[2] + 1, s[3] + len(text), s[4] + linked, s[5] + _prose(text, linked)
                    for s in parts:
                        s[6] += 1
                        s[7] |= bit
                if held > 1 << 18:  # rows of one shape add up later
                    yield from rows()
                    seen.clear()
                    held = 0
        yield from rows()

    return pages.mapInArrow(run, _SHAPE).groupBy(*_KEYS).agg(F.min("low").alias("low"), F.max("high").alias("high"), *[F.sum(k).alias(k) for k in _SUMS], F.array(*[F.bit_or(f"bits{level}") for level in range(LEVELS)]).alias("bits"))


_PART = "host string, part long, pages long, nodes string"


def _aligned(table: pa.Table) -> pa.Table:
    """One wrapper of a host's parts; those of the most pages come first."""
    wrapper: list[Node] | None = None
    rows = sorted(zip(table["pages"].to_pylist(), table["nodes"].to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
    for _, nodes in rows:
        part = [Node(s, rep, opt, [tuple(t) for t in texts], pages, bits) for s, rep, opt, texts, pages, bits in json.loads(nodes)]
        wrapper = part if wrapper is None else align(wrapper, part)
    whole = json.dumps([n.row() for n in wrapper], ensure_ascii=False)
    return pa.table({"host": table["host"][:1], "part": table["up"][:1], "pages": [sum(r[0] for r in rows)], "nodes": [whole]})


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hosts' wrappers as expressions, and what matching takes of them."""
    for batch in batches:
        made = []
        for host, pages, text in zip(*(common.column_of(batch, k).to_pylist() for k in ("host", "pages", "nodes")), strict=True):
            nodes = [Node(*n) for n in json.loads(text)]
            totals: dict[str, tuple[int, ...]] = {}
            for n in nodes:
                for symbol, t in zip(n.symbols, n.texts, strict=True):
                    totals[symbol] = tuple(a + b for a, b in zip(totals.get(symbol, (0, 0, 0, 0)), (t[5], t[2], t[3], t[4]), strict=True))
            matching = [[list(n.symbols), fixed] for n, fixed in zip(nodes, constants(nodes), strict=True)]
            made.append((host, pages, expression(nodes), json.dumps([matching, sorted(main_symbols(totals))], ensure_ascii=False)))
        columns = list(zip(*made, strict=True)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.string(), pa.int64(), pa.string(), pa.string()], strict=True)], names=["host", "pages", "wrapper", "matching"])


def _hosted(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.coalesce(F.lower(F.regexp_extract("url", _HOST, 1)), F.lit("")).alias("host"))


def infer(pages: DataFrame, part: int = PART) -> DataFrame:
    """host, pages, wrapper (a regular expression), matching (its nodes' constants, its main symbols)."""
    rows = _shapes(_hosted(pages).select("host", "html"))
    text = F.struct("low", "high", "chars", "linked", "prose", "blocks")
    by_node = rows.groupBy("host", "shape", "place").agg(F.sort_array(F.collect_list(F.struct("part", "symbol", text.alias("text")))).alias("parts"), F.max("repeated").alias("repeated"), F.max("pages").alias("pages"), F.array(*[F.bit_or(F.col("bits")[level]) for level in range(LEVELS)]).alias("bits"))
    # A shape's rows are those of one stream: a page's blocks bound them.
    shapes = by_node.groupBy("host", "shape").agg(F.sort_array(F.collect_list(F.struct("place", "parts", "repeated", "pages", "bits"))).alias("nodes"), F.max("pages").alias("pages"))
    as_json = F.to_json(
        F.transform(
            "nodes",
            lambda n: F.struct(
                F.transform(n["parts"], lambda x: x["symbol"]).alias("symbols"),
                n["repeated"].alias("repeated"),
                F.transform(n["parts"], lambda x: F.array(*[x["text"][k] for k in ("low", "high", "chars", "linked", "prose", "blocks")])).alias("texts"),
                n["pages"].alias("pages"),
                n["bits"].alias("bits"),
            ),
        )
    )
    common.ship(pages.sparkSession)
    parts = common.materialize(shapes.select("host", F.col("shape").alias("part"), "pages", as_json.alias("nodes")).mapInArrow(_compact, _PART))
    while True:
        sizes = parts.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.octet_length("nodes")).alias("bytes"))
        needed = F.greatest(F.ceil(F.col("n") / part), F.least(F.ceil(F.col("n") / 2), F.ceil(F.col("bytes") / PART_BYTES)))
        groups = sizes.agg(F.max(needed)).first()[0] or 1
        up = F.pmod(F.xxhash64("part"), F.lit(groups))
        parts = parts.withColumn("up", up).groupBy("host", "up").applyInArrow(_aligned, _PART)
        if groups == 1:
            return parts.select("host", "pages", "nodes").mapInArrow(_finished, "host string, pages long, wrapper string, matching string")
        parts = common.materialize(parts)


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes as rows of Node, in place of named fields."""
    for batch in batches:
        nodes = [json.dumps([[n["symbols"], n["repeated"], False, n["texts"], n["pages"], bits_of(n["bits"])] for n in json.loads(x)], ensure_ascii=False) for x in common.column_of(batch, "nodes").to_pylist()]
        yield pa.RecordBatch.from_arrays([common.column_of(batch, "host"), common.column_of(batch, "part"), common.column_of(batch, "pages"), pa.array(nodes, pa.string())], names=["host", "part", "pages", "nodes"])


def extract(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page by its host's wrapper; wrappers is a written table."""
    schema = T.StructType([common.id_field(pages, "page_id"), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def start():
        @lru_cache(256)
        def parsed(matching: str) -> tuple[list, set]:
            nodes, kept = json.loads(matching)
            return [(tuple(s), fixed) for s, fixed in nodes], set(kept)

        def step(batch):
            texts = [text_of(blocks(page.as_py() or ""), *parsed(matching.as_py() or "[[], []]")) for page, matching in zip(common.column_of(batch, "html"), common.column_of(batch, "matching"), strict=True)]
            return pa.RecordBatch.from_arrays([common.column_of(batch, "page_id"), common.column_of(batch, "url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

        return step

    hosted = _hosted(pages)
    size = wrappers.agg(F.sum(F.octet_length("matching"))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        joined = hosted.join(F.broadcast(wrappers.select("host", "matching")), "host", "left")
    else:
        # A large host's pages are dealt over so many salts as it has thousands of pages; its wrapper goes to each.
        count = F.ceil(F.col("pages") / PAGES_A_SALT).cast("int")
        large = common.broadcast_up_to(common.materialize(wrappers.where(count > 1).select("host", count.alias("salts"))), BROADCAST_HOSTS)
        dealt = hosted.join(large, "host", "left").withColumn("salt", F.pmod(F.xxhash64("html", "url"), F.coalesce("salts", F.lit(1))))
        copies = wrappers.select("host", "matching", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)).alias("salt"))
        joined = dealt.join(copies, ["host", "salt"], "left")
    return common.map_rows(joined.select("page_id", "url", "html", "matching"), start, schema)


def op5_html_extraction(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    began = common.mark()
    wrappers = common.materialize(infer(pages))
    common.discard_since(began, spark, wrappers)
    return extract(pages, wrappers)

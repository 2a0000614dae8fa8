"""Main text of web pages by wrappers inferred from pages of the same host.

A page is read as a stream of block tags and text slots. Neighbouring repeats fold into repeated
groups; the streams of a host are then aligned one after the other, and what one has and another
lacks becomes an optional group, so that a union-free regular expression grows that describes all
of them. The texts of a slot are compared over the pages that share it: one that is the same on most
pages is template, one that varies is content.

What a page's own blocks say comes first: slots inside the article (or the main part) and in no menu,
advert or the like are content. A page is aligned with its host's wrapper where that can decide, and
what its texts show is judged by: blocks that only a word in a class, id or role speaks against, and
the slots of pages without an article or main part. A slot that the wrapper lacks is judged by its
blocks alone.

Wrappers are learned from every structure of a host, the most frequent ones first: a few at a time
become a wrapper, and wrappers are aligned with each other like streams until the host has one.
Structures are small, so a host with most of the pages is no burden.
"""

from __future__ import annotations

import functools
import html as references
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.tables import Stored

#: Structures that one wrapper is inferred from, and wrappers that are united, at a time: a host with more
#: structures takes more rounds.
STRUCTURES, UNITED = 256, 16
#: Pages from which on the same text on most of them shows a template.
SHOWN = 3
#: Nodes that a repeated group can have when it is first seen.
PERIOD = 16

# Names with a meaning in HTML.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul head title option select textarea button noscript iframe object template".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "xmp")
_DROPPED = frozenset(
    "nav header footer aside form menu dialog head title option select textarea button noscript iframe object template "
    "search".split()
)
#: Words in a class, id or role for what is not part of an article; of these, what differs from page to page
#: by its nature.
_VARIED = frozenset(
    "ad ads adbox adsense advert adverts advertisement advertising banner sponsor sponsored promo menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar comment comments disqus respond related".split()
)
_MARKED = _VARIED | frozenset(
    "header masthead footer cookie cookies consent gdpr notice notices share sharing social newsletter subscribe popup "
    "modal overlay widget toolbar contentinfo complementary alert dialog skip".split()
)
_CLOSES = {  # what a start tag ends when it is still open, up to the blocks named after it
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.IGNORECASE)


#: Marks that words give.
_WORDED = ("=", "^", "~")


@functools.lru_cache(maxsize=4096)
def _raw_end(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE)


@functools.lru_cache(maxsize=65536)
def _block(name: str, attributes: str) -> str:
    """A block's name in labels, with a mark for what may not belong to an article.

    ``!`` never does. A name (of a class, id or role) that is made of listed words gives ``=`` where it
    has one of :data:`_VARIED`, else ``^``; a listed word that is only a part of a name gives ``~``. Words
    mark neither html, body and article nor the main part.
    """
    if name in ("html", "body"):
        return name
    if name in _DROPPED or _HIDDEN.search(attributes):
        return f"{name}!"
    mark, main = "", name == "main"
    for m in _NAMED.finditer(attributes):
        for one in (m[1] or m[2] or m[3] or "").lower().split():
            words = {w for w in re.split(r"[^a-z0-9]+", one) if w}
            listed = words & _MARKED
            main = main or ("main" in words and not listed)
            if listed and mark != "=":
                whole = listed == words
                mark = "=" if whole and words & _VARIED else "^" if whole or mark == "^" else "~"
    if name == "article":
        return name
    return "main" if main else name + mark


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``start``, ``end`` or ``text`` with a name and attributes, or the text as it is written."""
    at, size, quotes = 0, len(page), True
    while at < size:
        low = page.find("<", at)
        if low < 0:
            yield "text", page[at:], ""
            return
        if low > at:
            yield "text", page[at:low], ""
        if page.startswith("<!--", low):
            end = page.find("-->", low + 4)
            at = size if end < 0 else end + 3
            continue
        following = page[low + 1 : low + 2]
        name = _NAME.match(page, low + (2 if following == "/" else 1))
        if not name:
            if following in ("!", "?", "/"):
                end = page.find(">", low)
                at = size if end < 0 else end + 1
            else:
                yield "text", "<", ""
                at = low + 1
            continue
        end = _TAG_END.match(page, name.end()) if quotes else None
        if end:
            close = end.end()
        else:  # a quote that is not closed ends nothing; look for none of them in the rest
            quotes = False
            close = page.find(">", name.end()) + 1
            if not close:
                return
        kind = name[0].lower()
        if following == "/":
            yield "end", kind, ""
        else:
            yield "start", kind, page[name.end() : close - 1]
            if kind in _RAW and not page[name.end() : close - 1].endswith("/"):
                stop = _raw_end(kind).search(page, close)
                close = stop.end() if stop else size
                yield "end", kind, ""
        at = close


def read(page: str | None) -> list[tuple[str, str]]:
    """The page's symbols: ``<name>``, ``</name>`` and text slots, each with its text or nothing.

    A slot is ``#`` with the blocks it stands in. Tags inside a block are not part of the structure.
    White space in a block's text is one space. Blocks that the page leaves open are ended where
    another block shows their end. Words mark no block that holds the article.
    """
    out: list[tuple[str, str]] = []
    stack: list[tuple[str, str]] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join(references.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            out.append(("#" + "/".join(label for _, label in stack), text))

    def close(depth: int) -> None:
        flush()
        while len(stack) > depth:
            out.append((f"</{stack.pop()[1]}>", ""))

    for kind, name, attributes in tokens(page or ""):
        if kind == "text":
            held.append(name)
        elif name not in _BLOCKS:
            if name == "br":
                held.append(" ")
        elif kind == "start":
            flush()
            if stack and stack[-1][0] == "p":  # no block stands in a paragraph
                close(len(stack) - 1)
            if name in _CLOSES:
                ended, within = _CLOSES[name]
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in within:
                        break
                    if stack[depth][0] in ended:
                        close(depth)
                        break
            label = _block(name, attributes)
            out.append((f"<{label}>", ""))
            if name in _VOID:
                out.append((f"</{label}>", ""))
            else:
                stack.append((name, label))
        else:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    close(depth)
                    break
            else:
                flush()
    close(0)
    return _held(out)


def _held(symbols: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """``symbols`` without the marks of words on blocks that hold the article (or else the main part).

    That is the one with the most text, where all of them stand in marked blocks. What ``=`` marks, as
    comments, holds it only if less text stands in no marked block at all.
    """
    if not any(s[-2:-1] in _WORDED and s[-1:] == ">" for s, _ in symbols):
        return symbols
    stack: list[tuple[str, int]] = []
    open_: list[tuple[str, int, list]] = []  # articles and main parts that are open, how deep, and
    found: dict[str, list[list]] = {"article": [], "main": []}  # length of text, blocks around
    plain = 0
    for at, (symbol, text) in enumerate(symbols):
        if text:
            plain += len(text) * (not any(m in symbol for m in "!=^~"))
            for _, _, one in open_ if "!" not in symbol else ():
                one[0] += len(text)
        elif symbol.startswith("</"):
            stack.pop()
            if open_ and open_[-1][1] == len(stack):
                open_.pop()
        else:
            label = symbol[1:-1]
            if label in found and all(other != label for other, _, _ in open_):
                found[label].append([0, list(stack)])
                open_.append((label, len(stack), found[label][-1]))
            stack.append((label, at))
    blocks = [b for b in found["article"] if b[0]] or [b for b in found["main"] if b[0]]
    if not blocks or any(all(label[-1] not in "!=^~" for label, _ in around) for _, around in blocks):
        return symbols
    length, around = max(blocks, key=lambda b: b[0])
    free = {at: label[-1] for label, at in around if label[-1] in _WORDED}
    if "=" in free.values() and plain >= length:
        return symbols
    out, names = [], []
    for at, (symbol, text) in enumerate(symbols):
        if text:
            out.append(("#" + "/".join(names), text))
        elif symbol.startswith("</"):
            out.append((f"</{names.pop()}>", ""))
        else:
            names.append(symbol[1:-2] if at in free else symbol[1:-1])
            out.append((f"<{names[-1]}>", ""))
    return out


# --- wrappers -------------------------------------------------------------------------------------
# A node is a symbol, or a repeated group: a list of nodes.


def _key(node) -> str:
    return node if isinstance(node, str) else json.dumps(node)


def fold(nodes: list, period: int = PERIOD) -> list:
    """Neighbouring repeats as repeated groups, the shortest first, until there are none."""
    return _folded(nodes, period)[0]


def _folded(nodes: list, period: int = PERIOD) -> tuple[list, list[int]]:
    """The folded nodes, and how many of ``nodes`` each stands for."""
    sizes = [1] * len(nodes)
    changed = True
    while changed:
        changed = False
        for width in range(1, period + 1):
            names: dict[str, int] = {}
            keys = np.array([names.setdefault(_key(n), len(names)) for n in nodes]) if len(nodes) >= 2 * width else None
            if keys is None:
                break
            same = keys[:-width] == keys[width:]
            # How many places from here on are as they are ``width`` later: a repeat has all of them.
            stops = np.flatnonzero(~same)
            ahead = np.append(stops, len(same))[np.searchsorted(stops, np.arange(len(same)))] - np.arange(len(same))
            starts = np.flatnonzero(ahead >= width)
            if not len(starts):
                continue
            out, lengths, at = [], [], 0
            for start in starts.tolist():
                if start >= at:
                    body = nodes[start : start + width]
                    out += nodes[at:start]
                    out.append(body[0] if width == 1 and isinstance(body[0], list) else body)
                    end = start + (int(ahead[start]) // width + 1) * width
                    lengths += [*sizes[at:start], sum(sizes[start:end])]
                    at = end
            nodes, sizes = out + nodes[at:], lengths + sizes[at:]
            nodes, sizes = _taken(nodes, _groups(nodes), sizes)
            changed = True
    return nodes, sizes


def _absorbed(nodes: list, groups: list[list]) -> list:
    """``nodes`` with single occurrences of repeated groups, and neighbours of them, folded in."""
    return _taken(nodes, groups, [1] * len(nodes))[0]


def _taken(nodes: list, groups: list[list], sizes: list[int]) -> tuple[list, list[int]]:
    keys = [_key(n) for n in nodes]
    present = set(keys)
    for own, group in {_key(g): g for g in groups}.items():
        if own not in present and _key(group[0]) not in present:
            continue
        body, out, named, lengths, at = [_key(n) for n in group], [], [], [], 0
        while at < len(nodes):
            if keys[at] == own or (keys[at] == body[0] and keys[at : at + len(body)] == body):
                end = at + (1 if keys[at] == own else len(body))
                if not out or named[-1] != own:
                    out.append(group)
                    named.append(own)
                    lengths.append(0)
                lengths[-1] += sum(sizes[at:end])
                at = end
            else:
                out.append(nodes[at])
                named.append(keys[at])
                lengths.append(sizes[at])
                at += 1
        nodes, keys, sizes = out, named, lengths
        present.add(own)
    return nodes, sizes


def _groups(nodes: list) -> list[list]:
    return [n for n in nodes if isinstance(n, list)]


def _firsts(values: list[int], sizes: list[int]) -> list[int]:
    """The first of each ``sizes`` neighbouring values."""
    at, out = 0, []
    for size in sizes:
        out.append(values[at])
        at += size
    return out


def _aligned(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence, as pairs of places."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    x, y = a[low : len(a) - high], b[low : len(b) - high]
    # Bits of a row, last place of y first: where the longest subsequence of what follows grows by one.
    places: dict[str, int] = {}
    for j, name in enumerate(y):
        places[name] = places.get(name, 0) | 1 << (len(y) - 1 - j)
    full = (1 << len(y)) - 1
    at = [i for i, name in enumerate(x) if name in places]  # the others leave a row as it is
    # Rows are kept at the ends of blocks and made again inside one, as those of long streams are many.
    step = math.isqrt(len(at)) + 1
    ends = [0] * (len(at) // step + 2)

    def above(row: int, i: int) -> int:
        hit = row & places[x[at[i]]]
        return ((row + hit) | (row - hit)) & full

    row = full
    for i in range(len(at) - 1, -1, -1):
        if (i + 1) % step == 0 or i + 1 == len(at):
            ends[i // step] = row
        row = above(row, i)

    def block(k: int) -> list[int]:
        row, rows = ends[k], [full & ~ends[k]]
        for i in range(min(len(at), (k + 1) * step) - 1, k * step - 1, -1):
            row = above(row, i)
            rows.append(full & ~row)
        return rows[::-1]

    def best(i: int, j: int) -> int:
        return (rows[i - first] & ((1 << (len(y) - j)) - 1)).bit_count()

    pairs, i, j = [(k, k) for k in range(low)], 0, 0
    first, rows = 0, block(0)
    while i < len(at) and j < len(y):
        if i - first == step:
            first, rows = i, block(i // step)
        if x[at[i]] == y[j]:
            pairs.append((low + at[i], low + j))
            i, j = i + 1, j + 1
        elif best(i + 1, j) >= best(i, j + 1):
            i += 1
        else:
            j += 1
    return pairs + [(len(a) - high + k, len(b) - high + k) for k in range(high)]


@dataclass
class Wrapper:
    """Nodes in order, each with the streams (as bits) that have it, and how many streams there were.

    ``texts`` has for a node's place and a slot in it how many pages have the slot, and how many of them
    with the most frequent text.
    """

    nodes: list = field(default_factory=list)
    seen: list[int] = field(default_factory=list)
    streams: int = 0
    texts: dict[str, list[int]] = field(default_factory=dict)

    def add(self, stream: list) -> None:
        """Aligns a folded stream: nodes that either side lacks become optional."""
        self.merge(Wrapper(list(stream), [1] * len(stream), 1))

    def merge(self, other: Wrapper) -> None:
        """Aligns a wrapper of other streams as :meth:`add` does one stream."""
        groups = _groups(self.nodes) + _groups(other.nodes)
        nodes, sizes = _taken(self.nodes, groups, [1] * len(self.nodes))
        if len(nodes) != len(self.nodes):  # a group has taken nodes in, with what is known of the first
            self.nodes, self.seen = nodes, _firsts(self.seen, sizes)
        stream, sizes = _taken(other.nodes, groups, [1] * len(other.nodes))
        bits = [s << self.streams for s in _firsts(other.seen, sizes)]
        pairs = _aligned([_key(n) for n in self.nodes], [_key(n) for n in stream])
        nodes, seen, i, j = [], [], 0, 0
        for a, b in [*pairs, (len(self.nodes), len(stream))]:
            nodes += self.nodes[i:a] + stream[j:b]
            seen += self.seen[i:a] + bits[j:b]
            if a < len(self.nodes):
                nodes.append(self.nodes[a])
                seen.append(self.seen[a] | bits[b])
            i, j = a + 1, b + 1
        self.nodes, self.seen, self.streams = nodes, seen, self.streams + other.streams

    def shorten(self) -> None:
        """Numbers the sets of streams in as few bits as tell them apart, where there are many streams.

        Which nodes the same streams have, and which all of them have, stays as it is.
        """
        everyone = (1 << self.streams) - 1
        numbers = {s: n for n, s in enumerate(dict.fromkeys(s for s in self.seen if s != everyone), 1)}
        bits = (len(numbers) + 1).bit_length()
        if bits < self.streams:
            self.seen = [numbers.get(s, (1 << bits) - 1) for s in self.seen]
            self.streams = bits

    def fits(self, stream: list) -> bool:
        """Whether the wrapper describes a folded stream without a change."""
        stream = _absorbed(stream, _groups(self.nodes))
        pairs = _aligned([_key(n) for n in self.nodes], [_key(n) for n in stream])
        taken, everyone = {a for a, _ in pairs}, (1 << self.streams) - 1
        return len(pairs) == len(stream) and all(i in taken for i, s in enumerate(self.seen) if s == everyone)

    def expression(self) -> str:
        """The wrapper as a regular expression: ``(...)+`` repeats, ``(...)?`` is optional."""

        def written(node) -> str:
            return node if isinstance(node, str) else f"({''.join(map(written, node))})+"

        out, at, everyone = [], 0, (1 << self.streams) - 1
        while at < len(self.nodes):
            end = at + 1
            while end < len(self.nodes) and self.seen[end] == self.seen[at] != everyone:
                end += 1
            part = "".join(map(written, self.nodes[at:end]))
            out.append(part if self.seen[at] == everyone else f"({part})?")
            at = end
        return "".join(out)

    def match(self, stream: list, sizes: list[int]) -> list[int]:
        """Aligns a folded stream and gives the place of the node for each symbol it was folded from;
        -1 for what the wrapper lacks. ``sizes``: how many symbols each node of the stream stands for."""
        stream, sizes = _taken(stream, _groups(self.nodes), sizes)
        places = [-1] * len(stream)
        for a, b in _aligned([_key(n) for n in self.nodes], [_key(n) for n in stream]):
            places[b] = a
        return [place for place, size in zip(places, sizes) for _ in range(size)]

    def varies(self, place: int, slot: str) -> bool | None:
        """Whether a slot's text differs between the host's pages; nothing if they do not show it."""
        pages, most = self.texts.get(f"{place} {slot}", (0, 0))
        if 2 * most > pages:
            return False if pages >= SHOWN else None
        return True if pages else None

    def dumps(self) -> str:
        return json.dumps([self.nodes, [f"{s:x}" for s in self.seen], self.streams, self.texts])

    @classmethod
    def loads(cls, text: str) -> Wrapper:
        nodes, seen, streams, texts = json.loads(text)
        return cls(nodes, [int(s, 16) for s in seen], streams, texts)


@functools.lru_cache(maxsize=65536)
def _standing(slot: str) -> tuple[str, str]:
    """The part of the page a slot stands in (article, main or the body), and its mark: ``!`` for what is
    not content, ``^`` and ``~`` for what words mark in that part."""
    blocks = slot[1:].split("/")
    part = next((wanted for wanted in ("article", "main") if wanted in blocks), "body")
    marks = [(at, b[-1]) for at, b in enumerate(blocks) if b and b[-1] in "!=^~"]
    within = blocks.index(part) if part != "body" else -1
    if any(m in "!=" or at < within for at, m in marks):  # what words mark around it lies beside the article
        return part, "!"
    return part, "^" if any(m == "^" for _, m in marks) else "~" if marks else ""


def _asked(slots: set[str]) -> set[str]:
    """The slots that are content or not by what the host's pages show."""
    stands = {s: _standing(s) for s in slots}
    return {s for s, (part, mark) in stands.items() if mark in ("^", "~") or (part == "body" and not mark)}


def content(found: set[tuple[int, str]], wrapper: Wrapper) -> set[tuple[int, str]]:
    """Which slots of a page (with their places in the wrapper) are content.

    Those inside an article, or inside the main part; without either, in the body. What ``^`` marks is
    content only where its text varies between pages, what ``~`` marks unless its text is the same on
    most pages. So is what has no mark in the body, where no block says what is the article; if
    all of it is the same there, all of it stays.
    """
    stands = {one: _standing(one[1]) for one in found}

    def kept(one: tuple[int, str]) -> bool:
        part, mark = stands[one]
        if mark == "!" or (not mark and part != "body"):
            return mark != "!"
        varies = wrapper.varies(*one)
        return varies is True if mark == "^" else varies is not False

    inside = {one for one in found if kept(one)}
    for wanted in ("article", "main"):
        part = {one for one in inside if wanted in one[1][1:].split("/")}
        if part:
            return part
    for wanted in ("", "~"):
        inside = inside or {one for one, (_, mark) in stands.items() if mark == wanted}
    return inside


def infer(streams: list[list]) -> Wrapper:
    wrapper = Wrapper()
    for stream in streams:
        wrapper.add(stream)
    return wrapper


def united(wrappers: list[Wrapper]) -> Wrapper:
    """One wrapper of all streams that ``wrappers`` were inferred from."""
    one, *others = wrappers
    for other in others:
        one.merge(other)
    one.shorten()
    return one


def extract(page: str | None, wrapper: Wrapper | None) -> str:
    """The texts of the page's content slots in page order, one to a line.

    The page is aligned with its host's wrapper where that can decide: where words mark a block of the
    article, or the page has neither an article nor a main part.
    """
    symbols = read(page)
    wrapper = wrapper or Wrapper()
    slots = {s for s, text in symbols if text}
    places = [-1] * len(symbols)
    if wrapper.texts and _asked(slots):
        unmarked = {part for part, mark in map(_standing, slots) if not mark}
        if unmarked <= {"body"} or any(_standing(s)[1] in ("^", "~") for s in slots):
            places = wrapper.match(*_folded([s for s, _ in symbols]))
    wanted = content({(at, s) for at, (s, text) in zip(places, symbols) if text}, wrapper)
    return "\n".join(text for at, (s, text) in zip(places, symbols) if text and (at, s) in wanted)


def _texts_of(symbols: list[tuple[str, str]], sizes: list[int]) -> list[dict]:
    """``node, slot, hash`` for the slots that pages of a host are compared by; nodes are the stream's."""
    asked = _asked({s for s, text in symbols if text})
    held: dict[tuple[int, str], list[str]] = {}
    if asked:
        nodes = (node for node, size in enumerate(sizes) for _ in range(size))
        for node, (symbol, text) in zip(nodes, symbols):
            if symbol in asked:
                held.setdefault((node, symbol), []).append(text)
    return [
        {"node": node, "slot": slot, "hash": xxhash.xxh64_intdigest("\n".join(texts)) - 2**63}
        for (node, slot), texts in held.items()
    ]


def _host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, url: str = "url", html: str = "html", size: int = STRUCTURES) -> DataFrame:
    """``host, wrapper, expression``: what is inferred from the pages of each host.

    The wrapper is inferred from all structures of the host; texts are compared over all its pages, each
    aligned with the wrapper; pages that are the same count once. ``size``: structures aligned at a time.
    """

    @F.pandas_udf("array<struct<structure:string,page:long,texts:array<struct<node:int,slot:string,hash:long>>>>")
    def structure(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def of(page: str | None) -> list[dict]:
            symbols = read(page)
            nodes, sizes = _folded([s for s, _ in symbols])
            key = xxhash.xxh64_intdigest("\n".join(text for _, text in symbols)) - 2**63
            return [{"structure": json.dumps(nodes), "page": key, "texts": _texts_of(symbols, sizes)}]

        for batch in batches:
            yield pd.Series([of(page) for page in batch], dtype=object)

    @F.pandas_udf("string")
    def inferred(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([infer([json.loads(s) for s in streams]).dumps() for streams in batch], dtype=object)

    @F.pandas_udf("string")
    def joined(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(
                [some[0] if len(some) == 1 else united([*map(Wrapper.loads, some)]).dumps() for some in batch], dtype=object
            )

    @F.pandas_udf("string")
    def written(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([Wrapper.loads(one).expression() for one in batch], dtype=object)

    @F.pandas_udf("array<int>")
    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = functools.lru_cache(maxsize=256)(Wrapper.loads)
        for wrapper, structures in batches:
            out = []
            for one, s in zip(wrapper, structures):
                stream = json.loads(s)
                out.append(known(one).match(stream, [1] * len(stream)))
            yield pd.Series(out, dtype=object)

    @F.pandas_udf("string")
    def noted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for wrapper, texts in batches:
            out = []
            for one, shown in zip(wrapper, texts):
                w = Wrapper.loads(one)
                w.texts = {f"{t['place']} {t['slot']}": [t["pages"], t["most"]] for t in shown} if shown is not None else {}
                out.append(w.dumps())
            yield pd.Series(out, dtype=object)

    # Exploded rather than filtered: a filter would read each page a second time.
    read_once = pages.select(_host(url).alias("host"), F.explode(structure(html)).alias("s")).select("host", "s.*")
    # Stored, as it is both counted and compared, and so that a large host can be split.
    each = Stored(read_once.groupBy("host", "structure", "page", "texts").agg(F.count("*").alias("n")), "structures").df
    # The most frequent structures are the first set of a host; the others are dealt out by a hash.
    counted = Stored(each.groupBy("host", "structure").agg(F.sum("n").alias("count")), "counted").df
    order = Window.partitionBy("host").orderBy(F.desc("count"), "structure")
    first = counted.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= size)
    first = Stored(first.select("host", "structure", "count", F.lit(0).cast("bigint").alias("set")), "frequent").df
    sets = counted.groupBy("host").agg(F.ceil((F.count("*") - size) / size).alias("sets")).where("sets > 0")
    others = counted.join(first.select("host", "structure"), ["host", "structure"], "left_anti").join(sets, "host")
    dealt = first.unionByName(
        others.select("host", "structure", "count", (1 + F.pmod(F.xxhash64("structure"), "sets")).alias("set"))
    )
    listed = F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("rarer"), "structure")))
    grouped = dealt.groupBy("host", "set").agg(listed.alias("s"))
    made = Stored(grouped.select("host", "set", inferred("s.structure").alias("wrapper")), "inferred").df
    last = made.agg(F.max("set")).first()[0] or 0
    while last:
        together = made.groupBy("host", F.expr(f"set div {UNITED}").alias("set")).agg(
            F.sort_array(F.collect_list(F.struct("set", "wrapper"))).alias("s")
        )
        made = Stored(together.select("host", "set", joined("s.wrapper").alias("wrapper")), "inferred").df
        last //= UNITED
    # Every structure of the host is aligned with its wrapper, so that the texts of all its pages are compared.
    known = each.where(F.size("texts") > 0).select("host", "structure").distinct()
    taken = known.join(made.select("host", "wrapper"), "host").select(
        "host", "structure", placed("wrapper", "structure").alias("places")
    )
    asked = each.where(F.size("texts") > 0).join(taken, ["host", "structure"])
    texts = asked.select("host", "places", F.explode("texts").alias("t")).select(
        "host", F.col("places")[F.col("t.node")].alias("place"), "t.slot", "t.hash"
    )
    shown = (
        texts.where("place >= 0")
        .groupBy("host", "place", "slot", "hash").agg(F.count("*").alias("n"))
        .groupBy("host", "place", "slot").agg(F.sum("n").alias("pages"), F.max("n").alias("most"))
        .where("pages > 1")
        .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "slot", "pages", "most"))).alias("shown"))
    )
    return made.join(shown, "host", "left").select(
        "host", noted("wrapper", "shown").alias("wrapper"), written("wrapper").alias("expression")
    )


def main_text(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with their main text; empty where a page has none, or is null.

    Rows without a url are one host. Wrappers are stored before the pages are read again, so
    Spark knows their size and decides by it how to join them.
    """
    learned = Stored(wrappers(pages, url, html), "wrappers").df

    @F.pandas_udf("string")
    def texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = functools.lru_cache(maxsize=256)(Wrapper.loads)
        for page, wrapper in batches:
            yield pd.Series(
                [extract(p, None if w is None else known(w)) for p, w in zip(page, wrapper)], dtype=object
            )

    named = learned.select(F.col("host").alias("_host"), F.col("wrapper").alias("_wrapper"))
    joined = pages.withColumn("_of", _host(url)).join(named, F.col("_of") == F.col("_host"), "left")
    return joined.withColumn(into, texts(html, "_wrapper")).select(*[c for c in pages.columns if c != into], into)


def page_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``, one row per row of ``pages``."""
    return main_text(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )

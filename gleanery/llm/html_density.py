"""Main text of web pages by composite text density.

A page becomes a tree of elements. Every element has a density: its characters per tag,
raised or lowered by the share of characters and tags that are links. The element with the
largest sum of its children's densities holds the main text, where ``article`` and ``main`` weigh more; elements beside its path to the
body that are at least as dense as the thinnest element of that path belong to it too.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.llm.common import slices

_SLICE_BYTES = 4 << 20

_MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*)"
    r"|</?([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|$))"
    r"|<[!?/][^>]*+(?:>|$)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[a-z0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

# Elements by name: without content, with raw content, never part of the text, blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
OUTSIDE = frozenset(
    "head nav footer aside form button select option datalist dialog menu noscript template svg math canvas audio video object".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
# Elements that can be the main text, and those that weigh more because an author marked it.
HOLDERS = frozenset("article body center div main section table tbody td tr blockquote html".split())
MARKED = frozenset(["article", "main"])
MARK_WEIGHT = 2
# A named element with more than so many times the text of all that is not named is no surroundings.
LEAST_LEFT = 10
# A start tag ends these open elements, up to the nearest one of the second set.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
}
# Words in class, id or role that name what surrounds an article.
AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion sidebar menu nav navbar"
    " navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification alert popup modal"
    " overlay newsletter subscribe subscription signup share sharing social related recommended comment comments disqus discussion"
    " discussions thread threads feedback reply replies respond pagination pager toolbar widget login search complementary contentinfo skip".split()
)
# Inside a marked element these only go by names without other words: a class tells what a paragraph is about, too.
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 hgroup blockquote pre figcaption li dd dt td th code em strong b i span a".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# A name that starts with one of these states what a wrapper has, and a header of one of those is a title.
_STATES = frozenset("has with no not without is".split())
_TITLED = frozenset("article post entry content story".split())


def _names_around(value: str, within: bool) -> int:
    """Whether one of the names in a class, id or role names surroundings: 1 beside other words, 2 in words for them alone, else 0."""
    found = 0
    for name in value.split():
        words = _NAME.findall(name)
        if words and words[0] not in _STATES:
            header = "header" in words and not within and _TITLED.isdisjoint(words)
            if header or not AROUND.isdisjoint(words):
                found = max(found, 2 if all(w in AROUND or w == "header" or w.isdigit() for w in words) else 1)
    return found


class _Tree:
    """Elements in page order: name, parent, attributes; and the text runs with the element each is in."""

    def __init__(self, page: str):
        self.names, self.parents, self.attributes = ["html"], [-1], [""]
        self.runs: list[tuple[int, str]] = []  # element, text; a run with element -1 is a block's edge
        self._open, self._count = [0], {}
        at, size = 0, len(page)
        while at < size:
            found = _MARKUP.search(page, at)
            if found is None:
                self._text(page[at:])
                break
            if found.start() > at:
                self._text(page[at : found.start()])
            at = found.end()
            name = found.group(1)
            if name is None:
                continue
            name = name.lower()
            if found.group()[1] == "/":
                self._end(name)
                continue
            inner = found.group(2)
            if not inner.endswith(">"):
                break  # the page ends inside a tag
            self._start(name, inner[:-1])
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                self._end(name)
                if close is None:
                    break
                at = close.end()

    def _text(self, text: str) -> None:
        self.runs.append((self._open[-1], text))

    def _edge(self, name: str) -> None:
        if name in BLOCKS:
            self.runs.append((-1, ""))
        elif name == "br":
            self.runs.append((self._open[-1], " "))

    def _pop(self) -> str:
        name = self.names[self._open.pop()]
        self._count[name] -= 1
        return name

    def _start(self, name: str, attributes: str) -> None:
        if name in BLOCKS and self._count.get("p"):
            self._end("p")
        if name in ENDS:
            closed, bound = ENDS[name]
            while len(self._open) > 1 and any(self._count.get(c) for c in closed):
                top = self.names[self._open[-1]]
                if top in bound or (top in HOLDERS and top not in closed):
                    break
                self._pop()
        self._edge(name)
        if name in ("html", "body") and self._count.get(name):
            return
        self.names.append(name)
        self.parents.append(self._open[-1])
        self.attributes.append(attributes)
        if name not in VOID:
            self._open.append(len(self.names) - 1)
            self._count[name] = self._count.get(name, 0) + 1

    def _end(self, name: str) -> None:
        if self._count.get(name):
            while self._pop() != name:
                pass
        self._edge(name)


def _outside(tree: _Tree) -> list[bool]:
    """Which elements belong to the surroundings, by name or by what their attributes say.

    What a class, id or role names goes, unless little text would be left without it, or its name has other words as well
    and it holds most of the page's text outside links: that is a layout around the text, and the elements named inside it
    are judged each.
    """
    n = len(tree.names)
    holds, within = [False] * n, [False] * n
    for i in range(n - 1, 0, -1):
        if holds[i] or tree.names[i] in MARKED:
            holds[tree.parents[i]] = True
    out, named = [False] * n, [0] * n
    for i in range(1, n):
        name, up = tree.names[i], tree.parents[i]
        within[i] = within[up] or name in MARKED
        if out[up] or name in RAW or name in OUTSIDE or (name == "header" and not within[up]):
            out[i] = True
            continue
        if tree.attributes[i] and not tree.attributes[i].isspace() and not holds[i] and name not in ("html", "body"):
            for key, *values in _ATTRIBUTE.findall(tree.attributes[i]):
                key, value = key.lower(), (values[0] or values[1] or values[2]).lower()
                if key in ("class", "id", "role"):
                    kind = _names_around(value, within[up])
                    named[i] = max(named[i], 0 if kind == 1 and within[up] and name in PARAGRAPHS else kind)
                elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and _HIDDEN.search(value)):
                    out[i] = True
    pruned = _pruned(tree, out, named)
    for i in range(1, n):
        out[i] = out[i] or pruned[i] or out[tree.parents[i]]
    return out


def _pruned(tree: _Tree, out: list[bool], named: list[int]) -> list[bool]:
    """Which of the ``named`` elements are surroundings: the largest are opened as long as they hold the page's text."""
    n = len(tree.names)
    size, linked, top = [0] * n, [False] * n, [-1] * n  # top: the nearest named element, itself or above
    for i in range(1, n):
        up = tree.parents[i]
        linked[i] = linked[up] or tree.names[i] == "a"
        top[i] = i if named[i] and not out[i] else top[up]
    own = [0] * n
    for i, text in tree.runs:
        if i >= 0 and not out[i] and not linked[i]:
            own[i] += len(text) - sum(map(text.count, " \n\t\r"))
    for i in range(n - 1, -1, -1):
        size[i] += own[i]
        if i:
            size[tree.parents[i]] += size[i]
    loose, inner = [0] * n, [[] for _ in range(n)]  # text of a named element outside named ones in it; these
    plain, heaps = 0, ([], [])  # by name: with other words, without
    for i in range(n):
        if top[i] < 0:
            plain += own[i]
            continue
        loose[top[i]] += own[i]
        if top[i] == i:
            above = top[tree.parents[i]]
            if above < 0:
                heaps[named[i] - 1].append((-size[i], i))
            else:
                inner[above].append(i)
    for heap in heaps:
        heapq.heapify(heap)
    while True:
        first = [heap[0][1] if heap and size[heap[0][1]] else 0 for heap in heaps]
        if first[0] and (2 * size[first[0]] > size[0] or size[first[0]] > LEAST_LEFT * plain):
            i = heapq.heappop(heaps[0])[1]
        elif first[1] and size[first[1]] > LEAST_LEFT * plain:
            i = heapq.heappop(heaps[1])[1]
        else:
            break
        plain += loose[i]
        for k in inner[i]:
            heapq.heappush(heaps[named[k] - 1], (-size[k], k))
    pruned = [False] * n
    for _, i in [*heaps[0], *heaps[1]]:
        pruned[i] = True
    return pruned


def _densities(tree: _Tree, out: list[bool]) -> tuple[list[int], list[int], list[float], list[float]]:
    """Characters, those in links, composite density and sum of the children's densities of every element; its own text counts as a child."""
    n = len(tree.names)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in tree.runs:
        if i >= 0 and not out[i]:
            chars[i] += len(text) - text.count(" ") - text.count("\n")
    own = chars[:]
    linked = [False] * n
    for i in range(1, n):
        linked[i] = linked[tree.parents[i]] or tree.names[i] == "a"
    for i in range(n - 1, 0, -1):
        if out[i]:
            continue
        up = tree.parents[i]
        if linked[i]:
            link_chars[i] = chars[i]
        chars[up] += chars[i]
        tags[up] += tags[i] + 1
        link_chars[up] += link_chars[i]
        link_tags[up] += link_tags[i] + (tree.names[i] == "a")
    page_share = link_chars[0] / max(chars[0], 1)

    def composite(c: int, lc: int, t: int, lt: int) -> float:
        base = math.log(c * lc / max(c - lc, 1) + page_share * c + math.e)
        share = (c / max(lc, 1)) * (max(t, 1) / max(lt, 1))
        return c / max(t, 1) * (math.log(share) / math.log(base) if base > 1 and share > 0 else 1.0)

    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if chars[i] and not out[i]:
            density[i] = composite(chars[i], link_chars[i], tags[i], link_tags[i])
        if own[i]:
            sums[i] += composite(own[i], own[i] if linked[i] else 0, 0, 0)
        if i:
            sums[tree.parents[i]] += density[i]
    return chars, link_chars, density, sums


def _leads(tree: _Tree, out: list[bool], chars: list[int], link_chars: list[int], best: int, path: list[int]) -> set[int]:
    """Headlines beside the path before the choice, and paragraphs behind them, unless the choice has a headline of its own.

    A headline is an ``h1``, or an element that holds one and nothing but headings and paragraphs.
    """
    n = len(tree.names)
    inside, titled, plain = [False] * n, [False] * n, [True] * n
    inside[best] = True
    for i in range(best + 1, n):
        inside[i] = inside[tree.parents[i]]
        if inside[i] and tree.names[i] == "h1" and not out[i] and chars[i]:
            return set()
    for i in range(n - 1, 0, -1):
        name, up = tree.names[i], tree.parents[i]
        titled[i] = titled[i] or (name == "h1" and not out[i] and chars[i] > 0)
        titled[up] = titled[up] or titled[i]
        if name in BLOCKS and name not in HEADINGS and name != "p" and chars[i] and not (titled[i] and plain[i]):
            plain[up] = False
        plain[up] = plain[up] and plain[i]
    found, begun = set(), set()
    on_path = set(path)
    for i in range(1, best):
        up = tree.parents[i]
        if up not in on_path or i in on_path or out[i] or 2 * link_chars[i] > chars[i]:
            continue
        if titled[i] and plain[i]:
            begun.add(up)
        if up in begun and ((titled[i] and plain[i]) or tree.names[i] == "p" or tree.names[i] in HEADINGS):
            found.add(i)
    return found


def _chosen(tree: _Tree, out: list[bool]) -> list[bool]:
    """The elements whose own text is main text.

    The sums choose an element; the mark around it, if there is one, belongs to it with all that is not pruned, but for
    articles in it that are thinner than the way to the choice. Around that, dense neighbours and the headline are added.
    """
    n = len(tree.names)
    chars, link_chars, density, sums = _densities(tree, out)
    holders = [i for i in range(n) if tree.names[i] in HOLDERS and not out[i] and chars[i]]
    if not holders:
        return [not o for o in out]
    marked = [False] * n
    for i in range(1, n):
        marked[i] = marked[tree.parents[i]] or tree.names[i] in MARKED
    core = max(holders, key=lambda i: (sums[i] * (MARK_WEIGHT if marked[i] else 1), -i))
    path = [core]
    while path[-1] > 0:
        path.append(tree.parents[path[-1]])
    best = next((i for i in path if tree.names[i] in MARKED), core)
    way = path[: path.index(best) + 1]
    path = path[path.index(best) :]
    thin = min(density[i] for i in way)
    thinnest = min([density[i] for i in path if i], default=density[0])
    on_way, on_path, above = set(way), set(path), set(path[1:])
    leads = _leads(tree, out, chars, link_chars, best, path)
    keep = [False] * n
    for i in range(n):
        if out[i]:
            continue
        up = tree.parents[i] if i else -1
        if i != best and i not in on_way and tree.names[i] == "article" and best != core and density[i] < thin:
            continue
        if i == best or (i and keep[up] and up not in above):
            keep[i] = True
        elif i in on_path:
            keep[i] = True  # its own text; its other children are judged each
        elif up in on_path and (density[i] >= thinnest or i in leads):
            keep[i] = True
    return keep


def extract(page: str | None) -> str:
    """The main text of a page: its blocks, in page order, one to a line."""
    if not page:
        return ""
    tree = _Tree(page)
    keep = _chosen(tree, _outside(tree))
    blocks, parts = [], []
    for i, text in [*tree.runs, (-1, "")]:
        if i >= 0:
            if keep[i]:
                parts.append(text)
            continue
        if parts:
            block = " ".join(html.unescape("".join(parts)).split())
            if block:
                blocks.append(block)
            parts = []
    return "\n".join(blocks)


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", _SLICE_BYTES):
        texts = [extract(page) for page in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty page, or one without text, has an empty text. Pages are independent, so
    nothing is shuffled; repeated rows are extracted each, other columns are ignored.
    Tags that a page leaves open are closed as browsers do; what follows a script or comment that
    is never closed belongs to it. Line breaks inside a block are white space.
    """
    return pages.select("page_id", "url", "html").mapInArrow(
        _extract_batches, "page_id long, url string, text string, n_chars long"
    )

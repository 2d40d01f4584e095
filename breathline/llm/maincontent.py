"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text with the elements around them. A classifier gives each
block log-odds of being content: what the elements and their class names say (fixed
weights), and a logistic model of the text itself. The odds become capacities to the two
terminals of a graph; blocks that follow each other, and blocks with the same parent, are
tied by edges whose capacity is greater the nearer they are in the document tree. The
minimum cut, found by maximum flow, keeps the content side.

The text model is fitted on about ``SAMPLE_PAGES`` pages, on blocks whose elements leave no
doubt (inside article or main, or inside navigation, footers and the like). Without both
kinds in the sample its score is zero. Everything else works page by page where the page
is, so pages are never moved.

Defined results
- A null or empty page, or one without content, has the empty text.
- Unclosed elements end where HTML has them end; a tag or comment cut off at the end of a
  page is no text. Only elements shape blocks, so a line break is white space.
- Null ids and urls and rows that repeat stay as they are; other columns are not looked at.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE_PAGES = 2_000
#: Capacity of an edge between blocks that follow each other under one parent.
TIE = 1.5
#: Its share for a parent in common one, two, ... levels up, and for a sibling further back.
NEARNESS = (1.0, 0.5, 0.25)
SIBLING = 0.6
TEXT_LIMIT = 3.0

# The elements of HTML by their part in a page.
RAW = frozenset("script style textarea title iframe".split())
SKIPPED = RAW | frozenset("head noscript template select button svg math object canvas audio video datalist map".split())
BREAKS = frozenset(
    "html body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody "
    "tfoot tr caption blockquote pre figure figcaption form fieldset address details summary hgroup dialog menu search center".split())
SPACED = frozenset("br td th hr wbr img input".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}}
#: Elements that end an open paragraph, and those that an implied end doesn't cross.
ENDS_P = BREAKS - {"html", "body", "tr", "tbody", "thead", "tfoot", "caption"}
BARRIERS = frozenset("html body table article section nav aside header footer main div form ul ol dl blockquote".split())

# Odds that an element or a word of its class, id or role adds.
GOOD_ELEMENTS = {"article": 4.0, "main": 4.0}
BAD_ELEMENTS = {"nav": -9.0, "aside": -9.0, "footer": -9.0, "form": -9.0, "menu": -9.0, "dialog": -9.0, "search": -9.0,
                "header": -9.0, "address": -1.0}
OWN_ELEMENTS = {"p": 0.5, "h1": 1.0, "h2": 0.5, "h3": 0.5, "blockquote": 0.5, "pre": 0.5, "li": -0.5, "tr": -0.5}
BAD_WORDS = frozenset(
    "ad ads adbox adslot adunit adsense advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion promoted "
    "banner nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar rail widget widgets footer foot header masthead topbar "
    "toolbar cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay comment comments commentlist disqus reply "
    "replies respond discussion share sharing social related recommended recommendations trending subscribe subscription newsletter signup login "
    "signin register search searchbox form copyright legal disclaimer skip complementary contentinfo dialog toc outbrain taboola".split())
TITLE_WORDS = frozenset("header masthead banner".split())
GOOD_WORDS = frozenset("article content post entry story main articlebody postbody body text hentry".split())
BAD, GOOD = -9.0, 2.5

_TAG = re.compile(
    r"""<(?:!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z)"""
    r"""|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)|[^>]*(?:>|\Z))"""
    r"""|/[^>]*(?:>|\Z))""", re.S)
_ENDS = {name: re.compile(rf"</{name}(?![\w-])" + ("|<body" if name == "head" else ""), re.I) for name in SKIPPED}
_NAMES = re.compile(r"""(?<![\w-])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|(?<=\s))(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Element:
    """An element that shapes blocks, with what it says about its text."""

    def __init__(self, name: str, parent: Element | None, rest: str = ""):
        self.name, self.parent, self.good, self.bad = name, parent, GOOD_ELEMENTS.get(name, 0.0), BAD_ELEMENTS.get(name, 0.0)
        self.named, self.chars, self.holds, self.heads, self.signs = 0.0, 0, False, False, None
        self.inside = name in GOOD_ELEMENTS or (parent is not None and parent.inside)
        if name == "header" and self.inside:
            self.bad = 0.0
        if rest:
            words = {w.lower() for m in _NAMES.finditer(rest) for w in _WORDS.findall(m[1] or m[2] or m[3] or "")}
            if self.inside:
                words -= TITLE_WORDS  # the head of an article is its title
            if name not in ("html", "body") and (words & BAD_WORDS or _HIDDEN.search(rest)):
                self.named = BAD
            elif words & GOOD_WORDS:
                self.good = max(self.good, GOOD)
        if name in GOOD_ELEMENTS or name == "h1":
            for above in self.above():
                above.holds |= name != "h1"
                above.heads |= name == "h1"

    def above(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent

    def odds(self, page_chars: int) -> tuple[float, float]:
        """The strongest good and bad sign of the element and those around it.

        A container of the article, or of most of the text with the heading, can't be
        boilerplate for its class, nor a form around the page.
        """
        chain = [self]
        while chain[-1].signs is None and chain[-1].parent is not None:
            chain.append(chain[-1].parent)
        for e in reversed(chain):
            if e.signs is None:
                good, bad = e.parent.signs if e.parent else (0.0, 0.0)
                around = e.holds or (e.heads and e.chars > 0.6 * page_chars)
                own = min(0.0 if around else e.named, 0.0 if around and e.name == "form" else e.bad)
                e.signs = max(good, e.good), min(bad, own)
        return self.signs


@dataclass
class Block:
    element: Element
    text: str
    #: Share of its characters in links.
    linked: float


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without scripts and the like."""
    here, found, pieces, linked, links, at = Element("", None), [], [], 0, 0, 0

    def flush() -> None:
        nonlocal pieces, linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join(entities.unescape(raw).split())
            if text:
                found.append(Block(here, text, min(1.0, linked / max(1, len(raw)))))
            pieces, linked = [], 0

    while (m := _TAG.search(page, at)) is not None:
        if m.start() > at:
            pieces.append(page[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        if m["name"] is None:
            continue
        name, closing, rest = m["name"].lower(), bool(m["close"]), m["rest"] or ""
        if name in SKIPPED:
            if not closing and not rest.endswith("/"):
                end = _ENDS[name].search(page, at)
                at = end.start() if end else len(page) if name in RAW else at
                pieces.append(" ")
        elif name == "a":
            links = max(0, links + (-1 if closing else 1))
        elif name in SPACED:
            pieces.append(" ")
        elif name in BREAKS:
            flush()
            links = 0
            if closing:
                here = next((e.parent for e in (here, *here.above()) if e.name == name and e.parent), here)
            else:
                if name in ENDS_P and here.name == "p":
                    here = here.parent
                for e in (here, *here.above()) if name in CLOSES else ():
                    if e.name in CLOSES[name]:
                        here = e.parent
                    if e.name in CLOSES[name] or e.name in BARRIERS:
                        break
                here = Element(name, here, rest)
    if at < len(page):
        pieces.append(page[at:])
    flush()
    return found


def text_features(block: Block) -> list[float]:
    words = block.text.split()
    n = len(block.text)
    return [
        1.0, log1p(len(words)), block.linked, float(block.text[-1] in ".!?:;\"'”»)"), block.text.count(",") / len(words),
        sum(c.isupper() for c in block.text) / n, sum(c.isdigit() for c in block.text) / n,
        float(any(c in block.text for c in "©|»·•®")), sum(w[0].isupper() for w in words) / len(words),
    ]


FEATURES = 9


def scores(blocks: list[Block], weights: np.ndarray) -> tuple[list[float], list[tuple[float, float]]]:
    """Log-odds of content of each block, and the signs of the elements alone."""
    for b in blocks:
        b.element.chars += len(b.text)
        for e in b.element.above():
            e.chars += len(b.text)
    total = sum(len(b.text) for b in blocks)
    signs = [b.element.odds(total) for b in blocks]
    if not blocks:
        return [], []
    text = np.array([text_features(b) for b in blocks]) @ weights
    text = np.clip(text, -TEXT_LIMIT, TEXT_LIMIT).tolist()
    return [g + w + t + OWN_ELEMENTS.get(b.element.name, 0.0) for (g, w), t, b in zip(signs, text, blocks, strict=True)], signs


def ties(blocks: list[Block]) -> list[tuple[int, int, float]]:
    """Edges between blocks, with their capacity."""
    edges, last = [], {}
    for i, b in enumerate(blocks):
        parent = b.element.parent or b.element
        if i:
            mine, other = (b.element, *b.element.above()), {id(e) for e in (blocks[i - 1].element, *blocks[i - 1].element.above())}
            up = next(n for n, e in enumerate(mine) if id(e) in other)
            theirs = (blocks[i - 1].element, *blocks[i - 1].element.above())
            up = max(up, next(n for n, e in enumerate(theirs) if e is mine[up]))
            if up <= len(NEARNESS):
                edges.append((i - 1, i, TIE * NEARNESS[max(0, up - 1)]))
        before = last.get(id(parent))
        if before is not None and before != i - 1:
            edges.append((before, i, TIE * SIBLING))
        last[id(parent)] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node is on the source side of a minimum cut.

    A node has capacity ``odds`` from the source if positive, else its size to the sink.
    Flow is pushed along shortest ways, level by level, until none is left.
    """
    n, tiny = len(odds), 1e-9
    left = [max(0.0, x) for x in odds]
    room = [max(0.0, -x) for x in odds]
    arcs: list[list[int]] = [[] for _ in range(n)]
    head, capacity = [], []
    for a, b, c in edges:
        for u, v in ((a, b), (b, a)):
            arcs[u].append(len(head))
            head.append(v)
            capacity.append(c)
    while True:
        level = [0 if x > tiny else -1 for x in left]
        queue = [i for i in range(n) if level[i] == 0]
        reached = False
        for u in queue:
            reached |= room[u] > tiny
            for e in arcs[u]:
                if capacity[e] > tiny and level[head[e]] < 0:
                    level[head[e]] = level[u] + 1
                    queue.append(head[e])
        if not reached:
            return [x >= 0 for x in level]
        tried = [0] * n
        for start in range(n):
            while left[start] > tiny:
                way, u = [], start
                while room[u] <= tiny:
                    while tried[u] < len(arcs[u]):
                        e = arcs[u][tried[u]]
                        if capacity[e] > tiny and level[head[e]] == level[u] + 1:
                            break
                        tried[u] += 1
                    else:
                        if not way:
                            break
                        u = head[way.pop() ^ 1]
                        tried[u] += 1
                        continue
                    way.append(e)
                    u = head[e]
                if room[u] <= tiny:
                    break
                pushed = min([left[start], room[u], *(capacity[e] for e in way)])
                left[start] -= pushed
                room[u] -= pushed
                for e in way:
                    capacity[e] -= pushed
                    capacity[e ^ 1] += pushed


def main_text(page: str, weights: np.ndarray) -> str:
    blocks = blocks_of(page)
    odds, _ = scores(blocks, weights)
    keep = minimum_cut(odds, ties(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of features, per page, of blocks whose elements leave no doubt."""
    for batch in batches:
        features, labels = [], []
        for page in batch.column("page").to_pylist():
            blocks = blocks_of(page)
            for b, (good, bad) in zip(blocks, scores(blocks, np.zeros(FEATURES))[1], strict=True):
                if (good > GOOD and not bad) or bad <= BAD:
                    features.append(text_features(b))
                    labels.append(float(not bad))
        yield pa.RecordBatch.from_pydict({"x": pa.array(features, pa.list_(pa.float64())), "y": pa.array(labels, pa.float64())})


def fit_text_model(pages: DataFrame, page: str = "html", sample_pages: int = SAMPLE_PAGES) -> np.ndarray:
    """Weights of the text features, fitted on about ``sample_pages`` different pages by their hash; zero without both kinds."""
    rows = pages.select(F.col(page).alias("page")).where(F.col(page).isNotNull()).withColumn("spot", F.xxhash64("page"))
    # copies count once, as in langid.sample
    share = min(1.0, sample_pages / max(1, rows.select("spot").distinct().count()))
    near = rows.where(F.pmod("spot", F.lit(1 << 30)) < F.lit(share * (1 << 30)))
    some = near.groupBy("spot").agg(F.min("page").alias("page")).select("page")
    got = some.mapInArrow(_examples, "x array<double>, y double").groupBy("x", "y").count().collect()
    weights = np.zeros(FEATURES)
    y, times = np.array([r["y"] for r in got]), np.array([r["count"] for r in got], dtype=float)
    if len(set(y.tolist())) < 2:
        return weights
    x = np.array([r["x"] for r in got])
    for kind in (0.0, 1.0):  # both kinds weigh the same
        times[y == kind] /= times[y == kind].sum()
    for _ in range(25):
        p = 1 / (1 + np.exp(-(x @ weights)))
        slope = x.T @ (times * (y - p)) - 1e-3 * weights
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(FEATURES)
        weights = weights + np.linalg.solve(curve, slope)
    return weights


def _extracted(weights: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", weights) for p in batch.column("page").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["id", "url", "text", "n_chars"])
    return run


def extract(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html",
            sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Per page: id, url, text and n_chars of the main text."""
    weights = fit_text_model(pages, page, sample_pages)
    rows = pages.select(F.col(id).cast("long").alias("id"), F.col(url).alias("url"), F.col(page).alias("page"))
    return rows.mapInArrow(_extracted(weights), "id long, url string, text string, n_chars long").select(
        F.col("id").alias(id), F.col("url").alias(url), "text", "n_chars")

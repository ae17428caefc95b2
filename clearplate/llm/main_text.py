"""Main text of web pages by minimum cut.

A page is cut into text blocks. A classifier gives each block a cost of being content and
one of being boilerplate; these are the capacities to the two terminals. Blocks that follow
each other and blocks that are near in the document tree are tied by smoothness edges. The
minimum cut, found by maximum flow, is the labelling with the least total cost.

What the words of a block are like (length, links, punctuation, neighbours, depth) is
weighed by a logistic model. It is fitted on a bounded sample of pages whose own tags tell
article from navigation, and then used on all blocks, also on those without such tags.
What the tags say is added to it.

Each page is a graph of its own; pages are spread over the tasks as Spark reads them.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearplate.llm.base import filled, query, table

# A tag's parts, each matched at a place and none twice, so a page is read once from front to back.
TAG_NAME = re.compile(r"[a-zA-Z][^\t\n\f\r />]*")
GAP = re.compile(r"[\t\n\f\r /]*")
ATTRIBUTE_NAME = re.compile(r"=?[^\t\n\f\r />=]*")
EQUALS = re.compile(r"[\t\n\f\r ]*=[\t\n\f\r ]*")
BARE_VALUE = re.compile(r"[^\t\n\f\r >]*")
COMMENT_END = re.compile(r"--!?>")
HIDDEN = {"script", "style", "template", "textarea", "select", "title", "head", "svg", "iframe", "object", "button"}
RAW = {"script", "style", "textarea", "title", "iframe", "template", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "br", "wbr", "input"}
# An open element that a new one closes, by the new one's tag; any block closes an open p.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Elements that hold text or the page itself; their class names say nothing of what is around an article.
TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "main", "article", "body", "html"}
ITEMS = {"p", "li", "dt", "dd", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}
BODY = {"article", "main"}
CHROME = {"nav", "header", "footer", "aside", "form", "menu", "dialog"}
CHROME_NAMES = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|sidebar|side|footer|header|masthead|comments?|commentlist|discussion|talkback|replies|reply|alerts?|disclaimer|gdpr|teasers?|recommend\w*|trending|respond|disqus|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup|share|sharing|social|related|breadcrumbs?|pagination|widget|login|search)(?:$|[\s_-])", re.I)
# Name tokens that tell nothing of the element itself: "has-sidebar", "article-header".
NEUTRAL_NAMES = re.compile(r"^(?:(?:has|with|no|without)[_-].*|(?:article|post|entry|story|content|page)[_-](?:header|head|title))$", re.I)
BODY_NAMES = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body)(?:$|[\s_-]|body|content|text)", re.I)

# What tags add to the classifier's margin, the bounds of the margin itself, and the edges.
IN_CHROME_TAG = 8.0
IN_CHROME_NAME = 6.0
IN_BODY = 3.0
MARGIN = 2.0
NEIGHBOUR = 1.0
SIBLING = 1.2
# The classifier is fitted on at most this many pages (smallest hash of the id), and blocks of each.
SAMPLE_PAGES = 500
SAMPLE_BLOCKS = 200


@dataclass
class Block:
    """A run of text without a block tag inside: its text, where it is, and what it is like."""

    text: str
    parent: int
    chrome: float  # how much the tags around it speak against it
    body: bool
    heading: bool
    link_share: float
    depth: int = 0


@dataclass
class _Open:
    tag: str
    serial: int
    chrome: float
    body: bool
    hidden: bool
    block: int  # place on the stack of the nearest element that is no inline one


def _tag_end(page: str, at: int) -> tuple[dict[str, str], int] | None:
    """Attributes of a tag from behind its name, and where it ends; None if the page ends before it."""
    found: dict[str, str] = {}
    end = len(page)
    while True:
        at = GAP.match(page, at).end()
        if at >= end:
            return None
        if page[at] == ">":
            return found, at + 1
        name = ATTRIBUTE_NAME.match(page, at)
        at = name.end()
        value = ""
        equals = EQUALS.match(page, at)
        if equals:
            at = equals.end()
            if at >= end:
                return None
            if page[at] in "\"'":
                close = page.find(page[at], at + 1)
                if close < 0:
                    return None
                value, at = page[at + 1 : close], close + 1
            elif page[at] != ">":
                bare = BARE_VALUE.match(page, at)
                value, at = bare[0], bare.end()
        found.setdefault(name[0].lower(), value)


def _spoken_names(tag: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether class, id or role of a container speak of something beside the article, and of the article; both cancel out."""
    if tag in TEXT_TAGS - {"main", "article"}:
        return False, False
    against = for_it = False
    for name in " ".join(attributes.get(a, "") for a in ("class", "id", "role")).split():
        if not NEUTRAL_NAMES.match(name):
            beside, body = bool(CHROME_NAMES.search(name)), bool(BODY_NAMES.search(name))
            against |= beside and not body
            for_it |= body and not beside
    return against and tag not in TEXT_TAGS, for_it


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. Unclosed and stray tags are taken as browsers would, roughly."""
    out: list[Block] = []
    stack = [_Open("", 0, 0.0, False, False, 0)]
    text: list[str] = []
    links = [0, 0]  # whether a link is open, characters inside links
    opened: Counter[str] = Counter()  # elements on the stack that are no inline ones
    inline: list[Counter[str]] = [Counter()]  # inline ones since each of those
    serial = 0
    sections = True

    def close_block() -> None:
        if text:
            words = " ".join("".join(text).split())
            if words:
                k = stack[-1].block
                owner = stack[k]
                # Paragraphs, list items and cells are near what lies in the same parent.
                near = stack[stack[k - 1].block] if owner.tag in ITEMS else owner
                out.append(Block(words, near.serial, stack[-1].chrome, stack[-1].body, owner.tag in ("h1", "h2", "h3", "h4", "h5", "h6"), min(1.0, links[1] / len(words)), len(inline)))
            text.clear()
        links[1] = 0

    def add(piece: str) -> None:
        if piece and not stack[-1].hidden:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            if links[0]:
                links[1] += len(piece)

    def cut_stack(k: int) -> None:
        """Close the element at place ``k`` and all in it."""
        for o in stack[k:]:
            if o.tag not in INLINE:
                opened[o.tag] -= 1
                inline.pop()
        del stack[k:]

    def close_inline(tag: str) -> None:
        k = len(stack) - 1
        while stack[k].tag != tag:
            k -= 1
        for o in stack[k:]:
            inline[-1][o.tag] -= 1
        del stack[k:]

    at, end = 0, len(page)
    while at < end:
        m = page.find("<", at)
        if m < 0:
            add(page[at:])
            break
        add(page[at:m])
        at = m + 1
        closing = page.startswith("/", at)
        name = TAG_NAME.match(page, at + closing)
        if not name:
            if page.startswith("!--", at):
                at += 3
                short = 1 if page.startswith(">", at) else 2 if page.startswith("->", at) else 0
                stop = None if short else COMMENT_END.search(page, at)
                at = at + short if short else stop.end() if stop else end
            elif closing or page.startswith(("!", "?"), at):
                if sections and page.startswith("![CDATA[", at):
                    stop = page.find("]]>", at)
                    sections = stop >= 0  # without an end there is none further on either
                    if sections:
                        at = stop + 3
                        continue
                stop = page.find(">", at)
                at = end if stop < 0 else stop + 1
            else:
                add("<")
            continue
        tag = name[0].lower()
        rest = _tag_end(page, name.end())
        if rest is None:
            break
        attributes, at = rest
        if closing:
            if tag in INLINE:
                if inline[-1][tag] > 0:
                    close_inline(tag)
            else:
                close_block()
                if opened[tag] > 0:
                    k = stack[-1].block
                    while stack[k].tag != tag:
                        k = stack[k - 1].block
                    cut_stack(k)
            if tag == "a":
                links[0] = 0
            continue
        if tag == "br":
            add(" ")
        if tag not in INLINE:
            close_block()
            links[0] = 0
            k = stack[-1].block
            if k and (stack[k].tag == "p" or stack[k].tag in CLOSES.get(tag, ())):
                cut_stack(k)
        if tag in VOID:
            continue
        if tag in RAW:
            stop = RAW_END[tag].search(page, at)
            at = stop.end() if stop else end
            continue
        if tag == "a":
            links[0] = 1
        top = stack[-1]
        against, for_it = _spoken_names(tag, attributes) if attributes else (False, False)
        beside = tag in CHROME and not (tag == "header" and top.body) or tag == "noscript" and not top.body
        chrome = max(top.chrome, IN_CHROME_TAG if beside else 0.0, IN_CHROME_NAME if against else 0.0)
        serial += 1
        stack.append(_Open(tag, serial, chrome, top.body or tag in BODY or for_it, top.hidden or tag in HIDDEN, top.block if tag in INLINE else len(stack)))
        if tag in INLINE:
            inline[-1][tag] += 1
        else:
            opened[tag] += 1
            inline.append(Counter())
    close_block()
    return out


RAW_END = {tag: re.compile(rf"</{tag}(?=[\t\n\f\r />])[^>]*>", re.I) for tag in RAW}


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block: what its words are like, and those of its neighbours; nothing of the tags around it."""
    own = np.array([[min(len(b.text), 400) / 100, b.link_share, b.text[-1] in ".!?:;\"'", b.heading, min(b.depth, 20) / 10] for b in blocks], float).reshape(-1, 5)
    near = np.zeros((len(blocks), 2))
    for back in (1, -1):
        near += np.roll(own[:, :2], back, axis=0) / 2
    if len(blocks):
        near[0] -= own[-1, :2] / 2
        near[-1] -= own[0, :2] / 2
    return np.hstack([np.ones((len(blocks), 1)), own, near])


# The model where no pages tell article from navigation: weights of ``features``.
UNFITTED = np.array([-1.0, 1.25, -3.0, 0.5, 0.5, 0.0, 0.0, 0.0])


def fit_margin(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic model by Newton steps, drawn towards UNFITTED; both classes weigh the same."""
    if not len(y) or y.min() == y.max():
        return UNFITTED
    weigh = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * min(len(y), 1000)
    w = UNFITTED.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weigh * (p - y)) + ridge * (w - UNFITTED)
        bend = (x * (weigh * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(pages: DataFrame, page_id: str = "page_id", source: str = "html", rows: int = SAMPLE_PAGES) -> np.ndarray:
    """The classifier's weights from at most ``rows`` pages, and SAMPLE_BLOCKS blocks of each.

    Blocks inside an article or main element and not beside it are content; those inside
    navigation, headers, footers, asides and forms are not; others teach nothing. Of several
    pages with one id the first in order is taken; pages without id teach nothing.
    """
    ids = pages.select(F.col(page_id).alias("id")).filter("id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(rows)
    found = pages.select(F.col(page_id).alias("id"), filled(source).alias("html")).join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("html").alias("html"))
    names = [f"f{i}" for i in range(len(UNFITTED))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0):
                blocks = blocks_of(page.as_py())
                told = np.array([k for k, b in enumerate(blocks) if (b.body and not b.chrome) or (not b.body and b.chrome >= IN_CHROME_TAG)], np.int64)
                told = told[np.unique(np.linspace(0, len(told) - 1, min(len(told), SAMPLE_BLOCKS)).astype(np.int64))] if len(told) else told
                x = features(blocks)[told]
                y = np.array([float(not blocks[k].chrome) for k in told])
                yield pa.RecordBatch.from_arrays([pa.array(y), *[pa.array(x[:, i]) for i in range(len(names))]], names=["y", *names])

    got = found.select("html").mapInArrow(run, "y double, " + ", ".join(f"{n} double" for n in names)).toPandas()
    got = got.sort_values(list(got.columns), ignore_index=True)  # the same sum in any order of the tasks
    return fit_margin(got[names].to_numpy(), got["y"].to_numpy())


def costs(blocks: list[Block], weights: np.ndarray = UNFITTED) -> list[tuple[float, float]]:
    """Of each block: cost of calling it boilerplate, and of calling it content."""
    margin = np.clip(features(blocks) @ weights, -MARGIN, MARGIN)
    score = margin + np.array([(IN_BODY if b.body else 0.0) - b.chrome for b in blocks])
    return list(zip(np.maximum(score, 0.0).tolist(), np.maximum(-score, 0.0).tolist()))


@dataclass
class Flow:
    """Maximum flow by shortest augmenting paths in level graphs."""

    n: int
    to: list[int] = field(default_factory=list)
    left: list[float] = field(default_factory=list)
    out: list[list[int]] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.out = [[] for _ in range(self.n)]

    def edge(self, a: int, b: int, there: float, back: float = 0.0) -> None:
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.left.append(there)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.left.append(back)

    def reach(self, source: int) -> list[int]:
        """Distance of each node from the source along edges with capacity left; -1 if cut off."""
        level = [-1] * self.n
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in self.out[a]:
                b = self.to[e]
                if level[b] < 0 and self.left[e] > 1e-9:
                    level[b] = level[a] + 1
                    queue.append(b)
        return level

    def run(self, source: int, sink: int) -> list[int]:
        """Push flow until the sink is cut off; returns the last distances."""
        while True:
            level = self.reach(source)
            if level[sink] < 0:
                return level
            following = [0] * self.n
            path: list[int] = []
            a = source
            while True:
                if a == sink:
                    push = min(self.left[e] for e in path)
                    for e in path:
                        self.left[e] -= push
                        self.left[e ^ 1] += push
                    cut = next(k for k, e in enumerate(path) if self.left[e] <= 1e-9)
                    a = self.to[path[cut] ^ 1]
                    del path[cut:]
                    continue
                while following[a] < len(self.out[a]):
                    e = self.out[a][following[a]]
                    if self.left[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    following[a] += 1
                if following[a] < len(self.out[a]):
                    path.append(self.out[a][following[a]])
                    a = self.to[path[-1]]
                elif path:
                    e = path.pop()
                    a = self.to[e ^ 1]
                    following[a] += 1
                else:
                    break


def label(blocks: list[Block], weights: np.ndarray = UNFITTED) -> list[bool]:
    """Whether each block is content, by minimum cut."""
    n = len(blocks)
    flow = Flow(n + 2)
    source, sink = n, n + 1
    last: dict[int, int] = {}
    for k, (b, (drop, keep)) in enumerate(zip(blocks, costs(blocks, weights))):
        if drop:
            flow.edge(source, k, drop)
        if keep:
            flow.edge(k, sink, keep)
        if k:
            weight = NEIGHBOUR if b.chrome == blocks[k - 1].chrome else NEIGHBOUR / 4
            flow.edge(k - 1, k, weight, weight)
        if b.parent in last:
            flow.edge(last[b.parent], k, SIBLING, SIBLING)
        last[b.parent] = k
    return [d >= 0 for d in flow.run(source, sink)[:n]]


def main_text(page: str, weights: np.ndarray = UNFITTED) -> str:
    """The content blocks of a page, one per line."""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, keep in zip(blocks, label(blocks, weights)) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", weights: np.ndarray | None = None) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    ``weights`` are those of :func:`fit`, by default fitted on these pages. Null and empty
    pages, and pages without content, have the empty text. Repeated rows return repeated
    rows; pages of any length are read whole, in time that grows with their length; other
    columns of any name are ignored; an empty table gives no rows.
    """
    weights = fit(pages, page_id, source) if weights is None else weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weights) for p in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), filled(source).alias("html"))
    return slim.mapInArrow(run, "page_id long, url string, text string, n_chars long")


@query("op8_main_text")
def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

"""Main text of web pages from flat text blocks.

A page is read once into blocks: runs of text between tags that break lines. A block knows
its words, how many of them are links, and the kinds of elements around it. A decision
tree, trained on a small labelled table of pages, classifies it by these values and those
of the blocks before and after it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postsift.llm.labelled_pages import LABELLED

#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg math iframe object canvas audio video textarea select option datalist button head title".split())
#: Of these, the ones whose content is no markup either: it ends with the first closing tag.
RAW = frozenset("script style textarea title iframe noscript".split())
#: Elements that stay on the line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A new one of these ends an open one of the same group.
CLOSES = {t: g for g in (("p",), ("li",), ("dt", "dd"), ("tr",), ("td", "th"), ("option",)) for t in g}

#: What stands inside head; anything else ends it, also without its closing tag.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())

#: Kinds of surroundings, by element name or by words of class, id and role.
BY_ELEMENT = {
    "nav": "boiler", "menu": "boiler", "aside": "boiler", "footer": "boiler", "header": "header", "form": "boiler", "dialog": "boiler",
    "article": "main", "main": "main",
}
BOILER_WORDS = frozenset(
    """nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar side aside footer foot header masthead banner ad ads advert adverts
    advertisement advertising adbox adsense promo promotion promoted sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal
    overlay comment comments commentlist disqus reply replies respond discussion share sharing social subscribe newsletter signup login search related
    recommended widget toolbar pagination pager copyright legal disclaimer dialog complementary contentinfo form""".split()
)
MAIN_WORDS = frozenset("article content post entry story main body text".split())
#: What a block and its neighbours are like: words, link density, kind of line, place on the page.
AROUND = tuple(f"{what}{where}" for where in ("", "_before", "_after") for what in ("words", "links", "heading", "paragraph", "item")) + ("from_start", "from_end", "long_before", "long_after")
#: What names say about a block.
NAMED = ("boiler", "header", "main", "page_has_main")
FEATURES = AROUND + NAMED
#: Names may split only below so many splits by what is around.
NAMES_BELOW = 2
#: Words of a block that counts as long.
LONG_BLOCK = 15
#: Nesting that is followed; elements below it are read, but their ends and kinds are not kept.
DEEPEST = 256

TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)", re.S)
STOPS = re.compile("[>\"']")
#: A last attribute value without quotes, to which a slash at its end belongs.
BARE_VALUE = re.compile(r"=\s*[^\s\"'>]+\Z")
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S | re.I)
WORD_PARTS = re.compile(r"[a-z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = {
    **{name: ("any silent",) for name in SILENT},
    **{name: ("any heading",) for name in HEADINGS},
    **{name: ("any item",) for name in ("li", "dt", "dd", "td", "th")},
}


@dataclass
class Block:
    text: str
    links: float
    boiler: int
    header: int
    main: int
    heading: int
    paragraph: int
    item: int

    @property
    def words(self) -> int:
        return self.text.count(" ") + 1


@dataclass
class Open:
    name: str
    kinds: tuple[str, ...] = ()


@dataclass
class Reader:
    """The state of reading one page."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[Open] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    inside: Counter = field(default_factory=Counter)

    def push(self, name: str, kinds: tuple[str, ...]) -> None:
        if len(self.stack) < DEEPEST:
            self.stack.append(Open(name, kinds))
            self.inside.update((name, *kinds, *GROUPS.get(name, ())))

    def pop(self, k: int) -> None:
        """Close the elements from place k on."""
        for o in self.stack[k:]:
            self.inside.subtract((o.name, *o.kinds, *GROUPS.get(o.name, ())))
        del self.stack[k:]

    def end_block(self) -> None:
        text = " ".join(html.unescape("".join(self.parts)).split())
        if text:
            linked = len("".join(html.unescape("".join(self.linked)).split()))
            share = min(1.0, linked / max(1, len(text.replace(" ", ""))))
            self.blocks.append(Block(text, share, *(int(self.inside[k] > 0) for k in ("boiler", "header", "main", "any heading", "p", "any item"))))
        self.parts, self.linked = [], []

    def end_head(self) -> None:
        while self.stack and self.stack[-1].name == "head":
            self.pop(len(self.stack) - 1)

    def text(self, text: str) -> None:
        if text.strip(" \t\n\f\r"):
            self.end_head()
        if text and self.inside["any silent"] <= 0:
            self.parts.append(text)
            if self.inside["a"] > 0:
                self.linked.append(text)

    def start(self, name: str, attributes: str) -> None:
        if name not in IN_HEAD:
            self.end_head()
        elif name in ("head", "html") and self.stack and self.stack[-1].name == "head":
            return
        if name not in INLINE:
            self.end_block()
        elif name == "br":
            self.text(" ")
        group = CLOSES.get(name)
        if group or name not in INLINE:
            # An open paragraph ends where another block begins.
            for k in range(len(self.stack) - 1, -1, -1):
                own = self.stack[k].name
                if own == "p" or (group and own in group):
                    self.pop(k)
                    break
                if own not in INLINE:
                    break
        foreign = self.inside["svg"] > 0 or self.inside["math"] > 0 or name in ("svg", "math")
        if name in VOID or (foreign and attributes.rstrip().endswith("/") and not BARE_VALUE.search(attributes)):
            return  # only foreign elements close themselves; elsewhere the slash says nothing
        kinds = []
        if name in BY_ELEMENT:
            kinds.append(BY_ELEMENT[name])
        if name not in ("body", "html") and name not in HEADINGS:
            named = {w for m in NAMES.finditer(attributes) for w in WORD_PARTS.findall((m[1] or m[2] or m[3] or "").lower())}
            if named & BOILER_WORDS and name not in ("article", "main"):
                kinds.append("boiler")
            elif named & MAIN_WORDS:
                kinds.append("main")
        self.push(name, tuple(kinds))

    def end(self, name: str) -> None:
        if name not in INLINE:
            self.end_block()
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k].name == name:
                self.pop(k)
                return
            if name in INLINE and self.stack[k].name not in INLINE:
                return


@dataclass
class Scanner:
    """Finds the tags of a page from left to right, every character a bounded number of times."""

    page: str
    last: int = 0
    #: Quotes ahead of this place are not looked at: one of them is never closed.
    plain_until: int = 0

    def __post_init__(self) -> None:
        self.last = self.page.rfind(">")

    def end_of_tag(self, at: int) -> int:
        """The place of the `>` that ends the tag at `at`: the first one outside quotes."""
        page, k = self.page, at
        while at >= self.plain_until:
            stop = STOPS.search(page, k)
            if stop is None:
                break
            if stop[0] == ">":
                return stop.start()
            k = page.find(stop[0], stop.end()) + 1
            if not k:
                self.plain_until = stop.start() + 1
        return page.find(">", at)

    def tags(self) -> Iterator[tuple[int, int]]:
        """(begin, end) of everything between angle brackets; the caller may skip ahead by `send`."""
        page, at = self.page, 0
        while True:
            begin = page.find("<", at)
            if begin < 0 or begin > self.last:
                break
            mark = page[begin + 1 : begin + 9]
            if mark.startswith("!--"):
                end = page.find("-->", begin + 4)
                end = len(page) if end < 0 else end + 3
            elif mark == "![CDATA[":
                end = page.find("]]>", begin)
                end = len(page) if end < 0 else end + 3
            elif mark[:1] in ("!", "?"):
                end = page.find(">", begin) + 1
            elif TAG.match(page, begin + 1):
                end = self.end_of_tag(begin) + 1
            else:
                at = begin + 1
                continue
            moved = yield begin, end
            at = end if moved is None else moved
            if moved is not None:
                yield begin, end


def end_of_raw(page: str, name: str, at: int) -> int:
    """Behind the closing tag of an element whose content is no markup; the end of the page without one."""
    closing = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
    end = page.find(">", closing.end()) if closing else -1
    return end + 1 if end >= 0 else len(page)


def read_blocks(page: str) -> list[Block]:
    """The text blocks of a page, in page order, in time linear in its length."""
    reader, at = Reader(), 0
    tags = Scanner(page).tags()
    for begin, end in tags:
        reader.text(page[at:begin])
        at = end
        found = TAG.match(page, begin + 1)
        if found is None:
            continue
        name = found[2].lower()
        if found[1]:
            reader.end(name)
            continue
        reader.start(name, page[found.end() : end - 1])
        if name in RAW and reader.stack and reader.stack[-1].name == name:
            reader.pop(len(reader.stack) - 1)
            at = end_of_raw(page, name, end)
            tags.send(at)
    reader.text(page[at:])
    reader.end_block()
    return reader.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES per block."""
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    if n:
        own = np.array([(b.words, b.links, b.heading, b.paragraph, b.item) for b in blocks], float)
        out[:, :5] = own
        out[1:, 5:10] = own[:-1]
        out[:-1, 10:15] = own[1:]
        out[:, 15], out[:, 16] = np.arange(n), np.arange(n)[::-1]
        long = (own[:, 0] >= LONG_BLOCK) & (own[:, 1] < 0.5)
        out[:, 17], out[:, 18] = np.cumsum(long) - long, np.cumsum(long[::-1])[::-1] - long
        out[:, 19:22] = [(b.boiler, b.header, b.main) for b in blocks]
        out[:, 22] = any(b.main for b in blocks)
    return out


@dataclass
class Tree:
    """A decision tree: inner nodes split at feature <= threshold, leaves hold the class."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[bool] = field(default_factory=list)

    def grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int, level: int = 0) -> int:
        """Splits by what is around; names come in below NAMES_BELOW, where that leaves a doubt."""
        node = len(self.value)
        for column, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, bool(2 * y.sum() >= len(y)))):
            column.append(empty)
        split = None
        if depth and 0 < y.sum() < len(y):
            split = best_split(x[:, : len(AROUND)], y, least) if level < NAMES_BELOW else None
            split = split or best_split(x, y, least)
        if split is not None:
            k, cut = split
            low = x[:, k] <= cut
            self.feature[node], self.threshold[node] = k, cut
            self.left[node] = self.grow(x[low], y[low], depth - 1, least, level + 1)
            self.right[node] = self.grow(x[~low], y[~low], depth - 1, least, level + 1)
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.feature[node] < 0 or not len(rows):
                out[rows] = self.value[node]
                continue
            low = x[rows, self.feature[node]] <= self.threshold[node]
            todo += [(self.left[node], rows[low]), (self.right[node], rows[~low])]
        return out


def best_split(x: np.ndarray, y: np.ndarray, least: int) -> tuple[int, float] | None:
    """The feature and threshold with the lowest Gini impurity, `least` rows on either side."""
    n, best, found = len(y), 2 * y.mean() * (1 - y.mean()) - 1e-9, None
    for k in range(x.shape[1]):
        order = np.argsort(x[:, k], kind="stable")
        v, hits = x[order, k], np.cumsum(y[order])
        cut = np.flatnonzero(v[:-1] < v[1:])
        cut = cut[(cut + 1 >= least) & (n - cut - 1 >= least)]
        if len(cut):
            low = cut + 1
            p, q = hits[cut] / low, (hits[-1] - hits[cut]) / (n - low)
            impurity = (low * 2 * p * (1 - p) + (n - low) * 2 * q * (1 - q)) / n
            if impurity.min() < best:
                at = int(np.argmin(impurity))
                best, found = float(impurity[at]), (k, float(v[cut[at]] + v[cut[at] + 1]) / 2)
    return found


def labelled_blocks(pages) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a table of (page, texts of the blocks that belong to the article)."""
    x, y = [], []
    for page, wanted in pages:
        blocks = read_blocks(page)
        x.append(features(blocks))
        y += [b.text in wanted for b in blocks]
    return np.concatenate(x), np.array(y)


@cache
def trained(depth: int = 12, least: int = 2) -> Tree:
    """The tree of the labelled table; training takes milliseconds and is the same everywhere."""
    tree = Tree()
    tree.grow(*labelled_blocks(LABELLED), depth, least)
    return tree


def main_text(page: str | None, tree: Tree) -> str:
    blocks = read_blocks(page or "")
    keep = tree.predict(features(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, *, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page, in one pass without a shuffle.

    White space inside a block becomes one space, blocks are joined by an empty line. A null
    or empty page, or one without a block of the article, has an empty text. Pages are read
    whole and one by one, so repeated rows agree. Other columns are not read.
    """
    chosen = pages.select(pages[f"`{key}`"].alias("page_id"), pages[f"`{url}`"].alias("url"), pages[f"`{page}`"].alias("html"))
    kind = chosen.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for batch in batches:
            texts = [main_text(page.as_py(), tree) for page in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return chosen.mapInArrow(extracted, f"page_id {kind}, url string, text string, n_chars bigint")

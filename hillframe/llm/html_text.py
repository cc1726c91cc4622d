"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of element styles (tag and class). What is counted of a node over
the host's pages are its presentation styles (sequences of child styles) and, where it holds text, its content (all different words of each page). The importance of a style node is the entropy of its
presentation, mixed with its children's; that of a content node is one minus the mean entropy, over its pages' words, of a word over the pages, so
text whose words come back on every page weighs little, also where no two pages have the same. A presentation prior gives
menus, headers, footers, sidebars, notices, adverts, forms, comments and the like no weight, and an article or main element
full weight; where a page has one, branches beside it have none. A class or id name takes no weight from what stands around the
article or, on a page without one, holds most of the text, unless it is a plain name of such things (reader comments stay out, however long they
are). Branches below the threshold are cut from each page. A page is read in time proportional to its length, however deep its elements are.

Only counts are shuffled, summed before they are dealt, so a host with a third of all pages is no large group; the html itself
is not shuffled while the table of unimportant branches is small (its rows are counted), and is joined by host beyond.

Defined results: null and empty html give an empty text; a null or odd url belongs to the host ''; nodes on fewer than
`min_pages` pages of a host keep their prior; if nothing of a page is left, the prior alone decides; unclosed and stray tags
are closed as browsers do; repeated rows are pages of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, map_batches, small

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+)|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements and name parts that mark what isn't article text.
ASIDE_TAGS = frozenset("nav footer aside form script style button select menu dialog head noscript template textarea iframe svg title label input option".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
ASIDE_NAMES = frozenset("ad ads adv adbox adslot banner nav navbar navigation menu footer foot header masthead sidebar side aside cookie cookies consent gdpr notice notices popup modal overlay share sharing social related recommended promo promotion sponsor sponsored comment comments commentlist disqus reply replies respond newsletter subscribe signup login breadcrumb breadcrumbs pagination pager toolbar widget skip".split())
#: Names that mark a class or id in any place of it; the other names only where nothing but such words and CONTAINERS stands beside them.
STRONG_NAMES = frozenset("ads adbox adslot banner nav navbar navigation menu footer header masthead sidebar cookie cookies consent gdpr popup modal overlay sponsor sponsored promo promotion comment comments commentlist disqus newsletter breadcrumb breadcrumbs pagination pager toolbar widget".split())
CONTAINERS = frozenset("area articles bar block box button buttons container content group inner item items label left link links list main outer panel posts right section site slot text title top bottom to unit wrap wrapper".split())
ASIDE_BEGINS = ("advert", "sponsor", "cookie", "comment", "sidebar", "breadcrumb", "newsletter", "navbar", "footer")
ARTICLE_TAGS = frozenset(("article", "main"))
#: Names that inside an article mark its own heading.
HEADINGS = frozenset(("header", "head"))


def _aside(token: str, inside: bool) -> int:
    """Whether a class or id names what isn't article text: 0 no, 1 perhaps, 2 by a name that stands for nothing else."""
    parts = [p for p in re.split(r"[^a-z0-9]+", token) if p]
    if inside and set(parts) & HEADINGS:
        return 0
    if any(p in STRONG_NAMES or p.startswith(ASIDE_BEGINS) for p in parts):
        return 2 if all(p in ASIDE_NAMES or p.startswith(ASIDE_BEGINS) or p in ("list", "section") for p in parts) else 1
    return int(bool(set(parts) & ASIDE_NAMES) and all(p in ASIDE_NAMES or p in CONTAINERS or p[0].isdigit() for p in parts))


def _style(tag: str, attributes: str, inside: bool) -> tuple[str, int]:
    """The style of an element, and its prior: -1 or (plain names) -2 none by its names alone, 0 none, 1 unknown, 2 article."""
    name, role, tokens = tag, "", []
    if attributes:
        for key, value in ATTRIBUTE.findall(attributes):
            value = value.strip("\"'").lower()
            if key.lower() == "role":
                role = value
            else:
                if key.lower() == "class" or not re.fullmatch("h[1-6]", tag):  # a heading's id is its anchor
                    tokens += value.split()
                if key.lower() == "class":
                    name = f"{tag}.{' '.join(sorted(value.split()))}"
    if tag in ARTICLE_TAGS or role == "main":
        return name, 2
    if tag in ASIDE_TAGS or role in ASIDE_ROLES or (tag == "header" and not inside):
        return name, 0
    named = max((_aside(t, inside) for t in tokens), default=0) if tag not in ("html", "body") else 0
    return name, -named or 1


class Element(NamedTuple):
    """An open element: what its text inherits. Numbers are places in lists of Walk, or -1."""

    tag: str
    node: int
    none: bool  # of prior 0, or under one
    named: int  # the innermost element around without prior by its names
    article: int  # the innermost article around
    low: bool  # of an unimportant node, or under one
    block: int  # place on the stack of the innermost block


class Block(NamedTuple):
    prior: int
    node: int
    low: bool
    text: str


OUTSIDE = Element("", 0, False, -1, -1, False, -1)


class Walk:
    """One pass over a page: its text blocks, the child styles and the parent of every node, whether there is an article.

    A node is the checksum of its style path. The prior of a block is 0 under anything of prior 0, else 2 inside an article. A prior that
    rests on names alone doesn't hold for an element around the page's article: where every article has such elements around it, for
    those around the one with the fewest of them, then the most text; where there is no article, for those with most of the text, but for plain names.
    """

    def __init__(self, page: str, unimportant: frozenset[int] = frozenset()):
        self.unimportant = unimportant
        self.children: dict[int, list[str]] = {}
        self.parent: dict[int, int] = {}
        self.stack: list[Element] = []
        self.opened: dict[str, list[int]] = {}  # by tag, the places of its open elements
        self.held: list[str] = []
        self.total = 0  # characters outside elements of prior 0
        self.named: list[list] = []  # the one around, how many around, plain, characters before, characters within
        self.articles: list[list] = []  # named element around, characters before, characters within
        self.own: list[tuple[int, int]] = []  # of every open element: its own places in named and articles
        self.found: list[tuple[bool, int, int, int, bool, str]] = []
        self.read(page)
        self.flush()
        self.close(0)
        self.blocks = self.judged()

    def flush(self) -> None:
        if not self.held:
            return
        text = " ".join("".join(self.held).split())
        self.held.clear()
        if text:
            top = self.stack[-1] if self.stack else OUTSIDE
            if not top.none:
                self.total += len(text)
            # inline elements share the node of the block they stand in
            block = self.stack[top.block] if top.block >= 0 else OUTSIDE
            self.found.append((top.none, top.article, top.named, block.node, block.low, text))

    def close(self, k: int) -> None:
        """Take the elements from place k on off the stack."""
        while len(self.stack) > k:
            self.opened[self.stack.pop().tag].pop()
            name, article = self.own.pop()
            if name >= 0:
                self.named[name][4] = self.total - self.named[name][3]
            if article >= 0:
                self.articles[article][2] = self.total - self.articles[article][1]

    def pop(self, k: int) -> None:
        self.flush()
        self.close(k)

    def read(self, page: str) -> None:
        at, n = 0, len(page)
        while at < n:
            m = TOKEN.match(page, at)
            at = m.end()
            close, tag, attributes, text = m.groups()
            if text is not None:
                self.held.append(html.unescape(text))
            elif tag is None:
                if m.group() == "<":
                    self.held.append("<")
            elif close:
                self.end(tag.lower())
            elif tag.lower() in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            else:
                self.begin(tag.lower(), attributes)

    def end(self, tag: str) -> None:
        places = self.opened.get(tag)
        if places:
            k = places[-1]
            if any(e.tag in BLOCK or e.none or e.named >= 0 for e in self.stack[k:]):
                self.flush()
            self.close(k)
        elif tag in BLOCK:
            self.flush()

    def begin(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.flush()
            if tag not in ("br", "hr"):
                if self.opened.get("p"):
                    self.pop(self.opened["p"][-1])
                closes, i = CLOSES.get(tag, ()), self.stack[-1].block if self.stack else -1
                while closes and i >= 0:
                    if self.stack[i].tag in closes:
                        self.pop(i)
                        break
                    if self.stack[i].tag not in ("tbody", "thead", "tfoot"):
                        break
                    i = self.stack[i - 1].block if i else -1
        above = self.stack[-1] if self.stack else OUTSIDE
        name, prior = _style(tag, attributes, above.article >= 0)
        if prior <= 0 and tag not in BLOCK:
            self.flush()
        kids = self.children.setdefault(above.node, [])
        if not kids or kids[-1] != name:
            kids.append(name)
        if tag in VOID:
            return
        none, named, article, own = above.none or prior == 0, above.named, above.article, [-1, -1]
        if prior < 0:
            own[0] = len(self.named)
            self.named.append([named, self.named[named][1] + 1 if named >= 0 else 1, prior == -2, self.total, 0])
            named = own[0]
        if prior == 2 and not none:
            own[1] = len(self.articles)
            self.articles.append([named, self.total, 0])
            article = own[1]
        node = zlib.crc32(name.encode(), above.node)
        self.parent[node] = above.node
        place = len(self.stack)
        self.stack.append(Element(tag, node, none, named, article, above.low or node in self.unimportant, place if tag in BLOCK else above.block))
        self.own.append((own[0], own[1]))
        self.opened.setdefault(tag, []).append(place)

    def judged(self) -> list[Block]:
        held = set()
        if self.articles:
            i = min(self.articles, key=lambda a: (self.named[a[0]][1] if a[0] >= 0 else 0, -a[2]))[0]
            while i >= 0:
                held.add(i)
                i = self.named[i][0]
        else:
            held = {i for i, (_, _, plain, _, size) in enumerate(self.named) if 2 * size > self.total and not plain}
        good: list[bool] = []
        for i, (around, *_) in enumerate(self.named):  # what is around stands before
            good.append(i in held and (around < 0 or good[around]))
        return [Block(0 if none or (named >= 0 and not good[named]) else 2 if article >= 0 else 1, node, low, text) for none, article, named, node, low, text in self.found]


def main_text(page: str | None, unimportant: frozenset[int] = frozenset()) -> str:
    """The page's blocks without branches of no prior, without what stands beside an article, and without unimportant nodes."""
    if not page:
        return ""
    walked = Walk(page, unimportant)
    mine = [b for b in walked.blocks if b.prior == (2 if walked.articles else 1)]
    kept = [b.text for b in mine if not b.low]
    return " ".join(kept or [b.text for b in mine])


def host_of(url: str = "url") -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def style_counts(pages: DataFrame) -> DataFrame:
    """(host, node, parent, kind, value, pages): pages of a host whose node has a presentation style (kind 0) or a word (1)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[tuple, int] = {}
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                page = page.as_py()
                if not page:
                    continue
                walked = Walk(page)
                own = set()
                parents: dict[int, int] = {}
                words: dict[int, set[int]] = {}
                for prior, node, _, text in walked.blocks:
                    if prior and node:
                        words.setdefault(node, set()).update(map(zlib.crc32, text.lower().encode().split()))
                        while node and node not in parents:  # those above a known node are known
                            parents[node] = walked.parent[node]
                            node = parents[node]
                for node, found in words.items():
                    own.update((node, 1, word) for word in found)
                for node, parent in parents.items():
                    own.add((node, 0, zlib.crc32("\n".join(walked.children.get(node, ())).encode())))
                for node, kind, value in own:
                    key = (host, node, parents.get(node, 0), kind, value)
                    seen[key] = seen.get(key, 0) + 1
            if seen:
                columns = [*zip(*seen, strict=True), tuple(seen.values())]
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["host", "node", "parent", "kind", "value", "pages"])

    rows = pages.select("host", "html").transform(map_batches, read, "host string, node long, parent long, kind int, value long, pages long")
    return rows.groupBy("host", "node", "parent", "kind", "value").agg(F.sum("pages").alias("pages"))


def unimportant_nodes(counts: DataFrame, threshold: float = 0.3, min_pages: int = 8, damping: float = 0.9) -> DataFrame:
    """(host, nodes): the style nodes of each host whose composite importance is below the threshold."""
    c = F.col("pages")
    nodes = (
        counts.groupBy("host", "node", "parent")
        .agg(
            F.sum(F.when(F.col("kind") == 0, c)).alias("m"),
            F.sum(F.when(F.col("kind") == 0, c * F.log(c))).alias("style_log"),
            F.sum(F.when(F.col("kind") == 0, 1)).alias("styles"),
            F.sum(F.when(F.col("kind") == 1, c * F.log(c))).alias("content_log"),
            F.sum(F.when(F.col("kind") == 1, c)).alias("features"),
        )
        .where(F.col("m") >= min_pages)
    )

    def weigh(group: pd.DataFrame) -> pd.DataFrame:
        m = group["m"].to_numpy("float64")
        log_m = np.log(np.maximum(m, 2))
        own = np.clip(1 - (group["style_log"].to_numpy("float64") / m) / log_m, 0, 1)  # -sum p log_m p
        features = np.nan_to_num(group["features"].to_numpy("float64"))
        content = np.where(features > 0, 1 - np.nan_to_num(group["content_log"].to_numpy("float64")) / np.maximum(features, 1) / log_m, np.nan)
        index = {int(n): i for i, n in enumerate(group["node"])}
        kids: dict[int, list[int]] = {}
        for i, p in enumerate(group["parent"]):
            if int(p) in index:
                kids.setdefault(index[int(p)], []).append(i)
        part = damping ** np.maximum(1.0, np.nan_to_num(group["styles"].to_numpy("float64")))
        value = own.copy()
        # from the leaves up: an order in which every node stands after its parent, read backwards
        order = [i for i, p in enumerate(group["parent"]) if int(p) not in index]
        for i in order:
            order.extend(kids.get(i, ()))
        for i in reversed(order):
            below = [value[k] for k in kids.get(i, ())]
            if not np.isnan(content[i]):
                below.append(float(content[i]))
            if below:
                value[i] = (1 - part[i]) * own[i] + part[i] * max(below) if kids.get(i) else content[i]
        low = [int(n) for n, i in index.items() if value[i] < threshold]
        return pd.DataFrame({"host": [group["host"].iloc[0]], "nodes": [sorted(low)]}) if low else pd.DataFrame({"host": pd.Series(dtype=str), "nodes": pd.Series(dtype=object)})

    return nodes.groupBy("host").applyInPandas(weigh, "host string, nodes array<long>")


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html", broadcast_rows: int = 200_000, **options) -> DataFrame:
    """page_id, url, host, text and n_chars of every page."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), host_of(url).alias("host"), F.col(page).cast("string").alias("html"))
    low = cut(unimportant_nodes(style_counts(rows), **options), "unimportant")
    low = low.withColumnRenamed("host", "low_host")
    joined = rows.join(F.broadcast(low) if small(low, broadcast_rows) else low, F.col("host") == F.col("low_host"), "left").drop("low_host")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), frozenset(nodes.as_py() or ())) for p, nodes in zip(batch.column(3), batch.column(4), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "host", "text", "n_chars"])

    return joined.select("page_id", "url", "host", "html", "nodes").transform(map_batches, read, "page_id long, url string, host string, text string, n_chars long")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", "n_chars")


QUERIES = {"op5_html": op5_html}
ORACLES: dict[str, str] = {}

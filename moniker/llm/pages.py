"""Main text of web pages by the style tree of their site.

**Parsing.** Each page becomes blocks of text in page order, each known by its path: the block
elements around it, with their classes and ids (digits count as one digit, so that numbered
ids are one). Inline elements and ``br`` belong to the text of their block. Scripts, styles
and whatever else a page does not show give no text, and neither do elements whose meaning is
not to be content, by HTML (``nav``, ``footer``, ``form`` ..) or by a plain class, id or role.

**Style tree.** The pages of one host are laid over each other: a node of the tree is a path, and holds
the sequences of child nodes it was seen with (its presentations, runs of equal children
count as one) and the texts of its blocks (its contents). With ``m`` pages that have the node:

* presentation importance: the entropy of its presentations over the pages, to the base ``m``;
* content importance: one minus the mean over its texts of the entropy of a text's places, to
  the base ``m``: a text on ``c`` pages says 1 - log(c) / log(m);
* composite importance of a node: ``(1 - g) * presentation + g * content``, where content is
  the mean over all texts of its branch, and ``g`` is ``DECAY`` to the number of presentations.

Where a host has few pages, little is told by them, so the value is mixed with that of the
same path in the tree of all hosts, which counts as ``SHARED`` pages. A node is noise if it and
all nodes of its branch are less important than ``THRESHOLD``; its blocks are left out.

**Page.** If a page marks its main text by ``article``, else by ``main``, only such branches
are its text, as far as they are not noise. A page on which only noise is left, as one whose
site consists of copies of it, keeps all its unmarked blocks: the tree then tells nothing.

Rows are counts by node before they are shuffled, so a host with a third of all pages is no
longer than others; what the second pass needs of a host is its list of noise nodes, which is
broadcast if all lists together have at most ``BROADCAST`` nodes, and else joined with hosts
spread over salts.

Elements nested deeper than ``DEPTH`` belong to the node at that depth; their text stays.

Defined results: a null or empty html has the empty text. A null or odd url has the host
``''``. Equal pages count as often as they occur. White space is what ``str.split`` takes for
it; unknown character references stay as they are. Texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moniker.operators.skew import hot_keys, spread_join
from moniker.sources import materialise

DECAY = 0.9
SHARED = 32
THRESHOLD = 0.3
BROADCAST = 1 << 18
DEPTH = 256

# Elements by the HTML standard, and plain names for parts of a page.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
UNSEEN = frozenset(
    "head template svg math canvas object video audio map select datalist button dialog menu nav footer aside form fieldset".split()
)
BLOCKS = frozenset(
    "html body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section summary "
    "table tbody td tfoot th thead tr ul head template svg math canvas object video audio map select datalist button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer colophon copyright "
    "sidebar sidebars aside widget widgets notice notices cookie cookies consent gdpr banner banners popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended "
    "comment comments commentlist respond disqus reply replies pagination pager toolbar skip".split()
)
# An end tag of a list item, cell or paragraph that is left out is taken to stand before the next one.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "thead": {"caption"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}}

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*)((?:[^<>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/<>]*)([^<>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOLD = re.compile("class|id|role|hidden", re.I)
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")
SHOWN, UNLESS_MARKED, HIDDEN = 0, 1, 2


def _named(name: str) -> int:
    """What a class or id says: ``with-sidebar`` speaks of the page, ``entry-header`` is a title inside of an article."""
    words = WORDS.findall(re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower())
    if not words or words[0] in ("has", "with", "no", "without", "is") or NOISE.isdisjoint(words):
        return SHOWN
    return UNLESS_MARKED if NOISE.intersection(words) == {"header"} else HIDDEN


@lru_cache(1 << 14)
def _node_of(tag: str, attributes: str) -> tuple[str, int]:
    """Key of an element in the style tree, and whether it is known not to be content."""
    own: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attributes):
        own.setdefault(name.lower(), unescape(value.strip("\"'")))
    seen = HIDDEN if tag in UNSEEN else UNLESS_MARKED if tag == "header" else SHOWN
    if "hidden" in own or own.get("aria-hidden", "").lower() == "true" or own.get("role", "").lower() in ROLES:
        seen = HIDDEN
    names = sorted(set(f"{own.get('class', '')} {own.get('id', '')}".split()))
    if tag not in ("html", "body", "article", "main"):
        seen = max([seen, *map(_named, names)])
    elif any(x.lower() in ("comment", "comments", "reply") for x in names):
        seen = HIDDEN
    return "|".join([tag, *(DIGITS.sub("0", x) for x in names)]), seen


def number(text: str) -> int:
    """64-bit hash of a text."""
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


@lru_cache(1 << 14)
def _child(node: int, key: str) -> int:
    return number(f"{node}/{key}")


@dataclass(frozen=True)
class Open:
    """An element that is not closed yet, and the node its text belongs to."""

    tag: str
    node: int
    hidden: bool
    marks: int
    depth: int


class Page:
    """Blocks of a page: ``blocks`` has (node, marks, text); ``above`` the node above each; ``children`` the child keys of each node in order."""

    def __init__(self, html: str):
        root = Open("", number(""), False, 0, 0)
        self.blocks: list[tuple[int, int, str]] = []
        self.above: dict[int, int] = {}
        self.children: dict[int, list[str]] = {}
        self._open, self._tags = [root], Counter()
        self._text: list[str] = []
        self._read(html)

    def _read(self, html: str) -> None:
        at = 0
        while at < len(html):
            found = TAG.search(html, at)
            begin = found.start() if found else len(html)
            if begin > at and not self._open[-1].hidden:
                self._text.append(html[at:begin])
            if not found:
                break
            at = found.end()
            close, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
            if not tag:
                continue
            tag = tag.lower()
            if close:
                self._end(tag)
            elif tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            else:
                self._start(tag, attributes)
        self._flush()

    def _flush(self) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            self._text = []
            if text:
                self.blocks.append((self._open[-1].node, self._open[-1].marks, text))

    def _push(self, own: Open) -> None:
        self._open.append(own)
        self._tags[own.tag] += 1

    def _pop(self, size: int) -> None:
        """Close elements until ``size`` are open."""
        while len(self._open) > size:
            self._tags[self._open.pop().tag] -= 1

    def _start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self._text.append(" ")
            elif tag == "hr":
                self._flush()
            return
        key, seen = _node_of(tag, attributes) if TOLD.search(attributes) else _node_of(tag, "")
        top = self._open[-1]
        if tag not in BLOCKS:  # part of the text of its block, unless it is hidden
            if top.hidden or seen == HIDDEN:
                self._push(replace(top, tag=tag, hidden=True))
            return
        self._flush()
        inline = len(self._open)
        while self._open[inline - 1].tag and self._open[inline - 1].tag not in BLOCKS:
            inline -= 1
        if self._open[inline - 1].tag == "p":
            self._pop(inline - 1)
        if tag in CLOSES:
            self._close_before(CLOSES[tag], SCOPES.get(tag, {"table"}))
        top = self._open[-1]
        hidden = top.hidden or seen == HIDDEN or seen == UNLESS_MARKED and not top.marks
        node = top.node
        if not hidden and top.depth < DEPTH:
            node = _child(top.node, key)
            self.above[node] = top.node
            self.children.setdefault(top.node, []).append(key)
        self._push(Open(tag, node, hidden, top.marks | {"article": 1, "main": 2}.get(tag, 0), top.depth + 1))

    def _close_before(self, tags: set[str], scope: set[str]) -> None:
        for i in range(len(self._open) - 1, 0, -1):
            if self._open[i].tag in scope:
                return
            if self._open[i].tag in tags:
                return self._pop(i)

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if self._tags[tag]:
            size = len(self._open) - 1
            while self._open[size].tag != tag:
                size -= 1
            if tag in BLOCKS or not any(x.tag in BLOCKS for x in self._open[size:]):
                self._pop(size)

    def branch(self, node: int) -> list[int]:
        """A node and all above it."""
        found = [node]
        while node in self.above:
            node = self.above[node]
            found.append(node)
        return found

    def text(self, noise: set[int]) -> str:
        """Blocks that are neither unmarked beside marked ones nor noise, one a line."""
        for mark in (1, 2, 0):
            own = [(node, text) for node, marks, text in self.blocks if marks & mark == mark]
            if own:
                kept = [text for node, text in own if node not in noise]
                return "\n".join(kept or [text for _, text in own])
        return ""


CONTENT, STYLE, BELOW = 0, 1, 2


def page_rows(html: str) -> set[tuple[int, int, int]]:
    """What a page adds to the tree: (node, kind, value), each once.

    ``CONTENT``: a text of the node; ``STYLE``: a presentation; ``BELOW``: a node above, or itself.
    """
    page = Page(html)
    rows = {(node, CONTENT, number(DIGITS.sub("0", text).lower())) for node, _, text in page.blocks}
    for node in {node for node, _, _ in page.blocks}:
        for above in page.branch(node):
            rows |= {(node, BELOW, above), (above, BELOW, above)}
    for node, keys in page.children.items():
        runs = [k for i, k in enumerate(keys) if not i or keys[i - 1] != k]
        rows.add((node, STYLE, number(" ".join(runs))))
    return rows


def host_of(url: Column) -> Column:
    """Host of an address in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _importance(counts: DataFrame, tree: list[str]) -> DataFrame:
    """(tree.., node, pages, importance, above) of ``counts`` (tree.., node, kind, value, n): one row for each node above and itself."""
    own = [*tree, "node"]
    pages = counts.where((F.col("kind") == BELOW) & (F.col("node") == F.col("value"))).select(*own, F.col("n").alias("pages"))
    base = F.when(F.col("pages") > 1, F.log(F.col("pages").cast("double")))
    content = counts.where(F.col("kind") == CONTENT).groupBy(*own)
    content = content.agg(F.count(F.lit(1)).alias("texts"), F.sum(F.log(F.col("n").cast("double"))).alias("spread"))
    content = content.join(pages, own).withColumn("said", F.col("texts") - F.coalesce(F.col("spread") / base, F.lit(0.0)))
    below = counts.where(F.col("kind") == BELOW).select(*own, F.col("value").alias("above"))
    branch = below.join(content, own).groupBy(*tree, F.col("above").alias("node"))
    branch = branch.agg((F.sum("said") / F.sum("texts")).alias("content"))
    style = counts.where(F.col("kind") == STYLE).join(pages, own)
    share = F.col("n") / F.col("pages")
    style = style.groupBy(*own).agg(F.count(F.lit(1)).alias("styles"), F.sum(-share * F.log(share) / base).alias("entropy"))
    decay = F.pow(F.lit(DECAY), F.coalesce(F.col("styles"), F.lit(0)))
    whole = pages.join(branch, own).join(style, own, "left")
    presentation = F.when(F.col("pages") > 1, F.least(F.coalesce("entropy", F.lit(0.0)), F.lit(1.0))).otherwise(1.0)
    return whole.select(*own, "pages", ((1 - decay) * presentation + decay * F.col("content")).alias("importance"))


def noise_nodes(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, node) of all branches of the sites that are noise."""
    own = pages.select(host_of(F.col(f"`{url}`")).alias("host"), F.col(f"`{html}`").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for host, html in zip(*(batch.column(i) for i in range(2)), strict=True):
                rows = list(page_rows(html.as_py() or ""))
                node, kind, value = zip(*rows, strict=True) if rows else ((), (), ())
                columns = [pa.array([host.as_py()] * len(rows), pa.string()), pa.array(node, pa.int64()), pa.array(kind, pa.int8()), pa.array(value, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "node", "kind", "value"])

    rows = own.mapInArrow(run, "host string, node bigint, kind tinyint, value bigint")
    rows = rows.withColumn("host", F.xxhash64("host"))
    counts = materialise(rows.groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("n")), "style-tree")
    site = _importance(counts, ["host"])
    every = _importance(counts.groupBy("node", "kind", "value").agg(F.sum("n").alias("n")), [])
    mixed = site.join(every.select("node", F.col("importance").alias("shared")), "node")
    value = (F.col("pages") * F.col("importance") + SHARED * F.col("shared")) / (F.col("pages") + SHARED)
    mixed = materialise(mixed.select("host", "node", value.alias("importance")), "importance")
    below = counts.where(F.col("kind") == BELOW).select("host", "node", F.col("value").alias("above"))
    branch = below.join(mixed, ["host", "node"]).groupBy("host", F.col("above").alias("node")).agg(F.max("importance").alias("most"))
    whole = mixed.join(branch, ["host", "node"]).where(F.greatest("importance", "most") < THRESHOLD)
    return whole.select("host", "node")


def main_texts(pages: DataFrame, keys: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """(keys.., text) of every page."""
    noise = materialise(noise_nodes(pages, url, html), "noise")
    lists = noise.groupBy(F.col("host").alias("__host")).agg(F.collect_list("node").alias("__noise"))
    host = F.xxhash64(host_of(F.col(f"`{url}`")))
    own = pages.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], F.col(f"`{html}`").alias("__html"), host.alias("__host"))
    if noise.count() <= BROADCAST:
        joined = own.join(F.broadcast(lists), "__host", "left")
    else:
        joined = spread_join(own, lists, "__host", hot_keys(own, "__host"), ["__html"], "left")
    fields = [own.schema[f"k{i}"] for i in range(len(keys))]
    schema = ", ".join([*[f"`k{i}` {f.dataType.simpleString()}" for i, f in enumerate(fields)], "`text` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, noise = batch.column("__html"), batch.column("__noise")
            lists: dict[tuple, set[int]] = {}
            step = max(1, min(batch.num_rows, 64))
            for begin in range(0, batch.num_rows, step):
                texts = []
                for i in range(begin, min(begin + step, batch.num_rows)):
                    told = tuple(noise[i].as_py() or ())
                    texts.append(Page(html[i].as_py() or "").text(lists.setdefault(told, set(told))))
                columns = [batch.column(f"k{i}").slice(begin, len(texts)) for i in range(len(fields))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*(f"k{i}" for i in range(len(fields))), "text"])

    return joined.mapInArrow(run, schema).toDF(*keys, "text")

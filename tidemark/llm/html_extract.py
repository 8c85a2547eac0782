"""HTML extraction with site style trees.

Every page is parsed into elements. The elements of all pages of a host, merged by their
style path (the tags and classes from the root down), make up the host's style tree. Spark
counts, for each node, in how many different ways its children are laid out (presentation)
and which texts it holds (content). A node's importance is the larger of both entropies,
each divided by the logarithm of the number of pages that hold the node: 0 if all pages
agree, 1 if all differ. A node on at least ``MIN_PAGES`` pages and a tenth of its host's
pages, whose importance is below ``LOW``, is removed from each page with its branch, unless
a node below it is important. Pages with the same HTML count once, so that copies of an
article don't make it look like a menu.

The article or main element is a prior. Inside it, blocks go only below ``LOW_MAIN``, and a
heading, caption or table header that pages share ("Background", "Price") goes or stays with the
first text after it that is none, or, at the element's end, with the last one before. Outside
it, what the tree knows nothing of goes, if the element holds ``PRIOR`` of the text; branches
with a node whose content reaches ``HIGH`` stay.

What a page declares itself is believed as well: menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments by element or role are not main text.
A class or id that names such a thing drops its branch, unless that holds an article or main
element, or most of the text with no article elsewhere. One that only has such a name as a
part ("has-sidebar") lowers it: the branch goes unless it holds such an element, most of the
page's text, or an important node.

Blocks are the runs of text between block elements; a line break is a space.

Defined results: null or empty HTML gives an empty text. A url that is null or has no host
belongs to the host ''. Repeated rows are pages of their own (in the tree they count once).
Unclosed and stray tags are read as browsers do in common cases. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

MIN_PAGES, SHARE, LOW, LOW_MAIN, HIGH = 5, 0.1, 0.3, 0.1, 0.7
#: Share of the page's text that the article or main elements hold, if they are to decide.
PRIOR = 0.25

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)")
# Element names by how HTML treats them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_CLOSES_P = _BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "html", "body", "legend", "summary"}
# Elements, roles and name parts of what is no main text.
_DROPPED = frozenset("nav aside footer form head menu button select option label input dialog svg canvas object video audio map datalist".split()) | _RAW
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_THING = (
    r"(?:ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"nav|navbar|navigation|menu|breadcrumbs?|sidebar|side-bar|footer|comments?|commentlist|disqus|respond|reply|replies|share|sharing|social|"
    r"newsletter|subscribe|subscription|signup|login|search|related|widget|pagination|pager|skip-link|toolbar)"
)
_PART = re.compile(rf"(?:^|[\s_-]){_THING}(?:$|[\s_-])", re.I)
_NAME = re.compile(
    rf"(?:^|\s)(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global|user|post|{_THING})[_-])*{_THING}"
    r"(?:[_-](?:list|area|section|box|bar|block|wrap|wrapper|container|form|links?|buttons?|inner|top|bottom|left|right|[0-9]+))*(?:$|\s)",
    re.I,
)
#: Words before a name that make it a remark on the layout.
_REMARK = re.compile(r"(?:^|(?<=\s))(?:has|have|with|without|no|not|hide|hides|show|shows|is)[_-]\S*", re.I)
_MAIN = frozenset(("article", "main"))
#: Elements that say what the text beside them is.
_LABELS = frozenset("h1 h2 h3 h4 h5 h6 hgroup caption figcaption legend summary th thead dt".split())


@dataclass
class Node:
    tag: str
    path: int
    keep: bool                      # not declared as something other than main text, by element or role
    main: bool                      # inside the article or main element
    words: list[str] = field(default_factory=list)
    layout: list[str] = field(default_factory=list)
    block: int = 0
    up: Node | None = None
    rich: bool = False              # this node or one below it is important
    named: int = 0                  # 2: named as something other than main text, 1: in a part of the name
    holds: bool = False             # it is or holds an article or main element
    said: int = 0                   # characters of text in its branch


def _path(parent: int, step: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent}>{step}".encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        name = m[1] or m[5]
        out.setdefault(name.lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def _declared(tag: str, attrs: dict[str, str], parent: Node) -> bool:
    """False if the element says of itself that it is no main text."""
    if tag in _DROPPED or (tag == "header" and not parent.main):
        return False
    if not attrs:
        return True
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return False
    if tag in ("html", "body", "article", "main"):
        return True
    return attrs.get("role", "").lower() not in _ROLES


def _named(tag: str, attrs: dict[str, str]) -> int:
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}"
    if tag in ("html", "body", "article", "main") or names == " ":
        return 0
    names = _REMARK.sub("", names)
    return 2 if _NAME.search(names) else int(bool(_PART.search(names)))


def parse(page: str) -> tuple[list[Node], list[tuple[Node, int, str]]]:
    """All elements, and the page's text pieces in order: (element, block number, text)."""
    root = Node("", 0, True, False)
    stack, nodes, pieces = [root], [root], []
    known: dict[tuple[int, str], int] = {}
    block, at = 0, 0

    def close(count: int) -> None:
        nonlocal block
        for _ in range(count):
            if stack.pop().tag in _BLOCK:
                block += 1

    def say(raw: str) -> None:
        if raw and not raw.isspace():
            pieces.append((stack[-1], block, html.unescape(raw)))
        elif raw:
            pieces.append((stack[-1], block, " "))

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(len(stack) - depth)
                    break
                # an inline end tag doesn't close the block around it
                if tag not in _BLOCK and stack[depth].tag in _BLOCK:
                    break
            continue
        if tag in ("html", "body") and any(x.tag == tag for x in stack):
            continue
        if tag == "br":
            pieces.append((stack[-1], block, " "))
            continue
        closes = {"p"} if tag in _CLOSES_P else _CLOSED_BY.get(tag, ())
        scope = _SCOPE.get(tag, ()) if tag not in _CLOSES_P else ("td", "th", "table", "button")
        for targets, bounds in ((closes, scope), (_CLOSED_BY.get(tag, ()), _SCOPE.get(tag, ()))):
            for depth in range(len(stack) - 1, 0, -1) if targets else ():
                if stack[depth].tag in bounds:
                    break
                if stack[depth].tag in targets:
                    close(len(stack) - depth)
                    break
        parent = stack[-1]
        attrs = _attributes(m[3]) if m[3].strip(" /\n\t\r") else {}
        style = f"{tag}.{' '.join(sorted(attrs.get('class', '').lower().split()))}" if attrs.get("class") else tag
        key = (parent.path, style)
        if key not in known:
            known[key] = _path(*key)
        node = Node(tag, known[key], parent.keep and _declared(tag, attrs, parent), parent.main or tag in _MAIN or attrs.get("role") == "main", up=parent, named=_named(tag, attrs))
        parent.layout.append(style)
        nodes.append(node)
        if tag in _BLOCK:
            block += 1
        if tag in _VOID or m[3].endswith("/") and tag in ("path", "circle", "use"):
            continue
        if tag in _RAW:
            end = re.compile(f"</{re.escape(tag)}[\\s/>]", re.I).search(page, at)
            close_at = page.find(">", end.start()) if end else -1
            at = close_at + 1 if close_at >= 0 else n
            continue
        stack.append(node)
    return nodes, pieces


def blocks(pieces: list[tuple[Node, int, str]]) -> Iterator[str]:
    """Texts of the blocks: pieces of one block joined, white space as single spaces."""
    here, block = [], None
    for _, number, text in pieces:
        if number != block and here:
            yield " ".join("".join(here).split())
            here = []
        block = number
        here.append(text)
    if here:
        yield " ".join("".join(here).split())


def extract(page: str, low: frozenset[int], high: frozenset[int] = frozenset(), lowest: frozenset[int] = frozenset()) -> str:
    """Main text. ``low``, ``high`` and ``lowest`` are the host's style paths of importance
    below ``LOW``, content importance from ``HIGH``, and importance below ``LOW_MAIN``.
    """
    nodes, pieces = parse(page)
    for node, _, text in pieces:
        if node.keep:
            node.said += len(text.strip())
    for node in reversed(nodes):        # a node comes after those above it
        node.rich = node.rich or node.path in high
        node.holds = node.holds or node.main and node.keep and node.said > 0
        if node.up:
            node.up.said += node.said
            node.up.holds = node.up.holds or node.holds
            node.up.rich = node.up.rich or node.rich and node.tag not in ("body", "html")
    for node in nodes[1:]:
        most = 2 * node.said >= nodes[0].said
        inside = node.main and node.up.main     # a named part of an article doesn't hold that article
        if node.named and not (node.holds and not inside):
            lost = not (most and not nodes[0].holds) if node.named == 2 else not (most or node.rich)
            node.keep = node.keep and not lost
        node.keep = node.keep and node.up.keep
    said = [(p[0], len(p[2].strip())) for p in pieces if p[0].keep]
    main = sum(n for x, n in said if x.main)
    decides = main > 0 and main >= PRIOR * sum(n for _, n in said)

    def stays(node: Node) -> bool:
        if node.main:
            while node.up and node.tag not in _BLOCK:       # words inside a sentence stay with it
                node = node.up
            return not node.main or node.path not in lowest
        if node.path in low or not decides:
            return node.path not in low
        while node.up and node.tag not in ("body", "html"):
            if node.rich:
                return True
            node = node.up
        return node.path in high        # text of the body itself

    def label(node: Node) -> bool:
        while node.up and node.main and node.tag not in _MAIN:
            if node.tag in _LABELS:
                return True
            node = node.up
        return False

    decided: dict[int, bool] = {}
    labels: dict[int, bool] = {}
    for node, _, _ in pieces:
        key = id(node)
        if key not in decided:
            decided[key], labels[key] = node.keep and stays(node), label(node)
    marks = [decided[id(node)] for node, _, _ in pieces]
    told = [False] * len(pieces)
    for order in (range(len(pieces) - 1, -1, -1), range(len(pieces))):
        beside = None       # whether the nearest text that is no label stays: first the one after, then the one before
        for i in order:
            node, _, text = pieces[i]
            if not node.main:
                beside = None
            elif not labels[id(node)]:
                beside = marks[i] if node.keep and text.strip() else beside
            elif node.keep and not decided[id(node)] and beside is not None and not told[i]:
                marks[i], told[i] = beside, True
    kept = [p for p, mark in zip(pieces, marks, strict=True) if mark]
    return "\n\n".join(b for b in blocks(kept) if b)


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def style_counts(page: str) -> Iterator[tuple[int, int, int]]:
    """(path, 0 for layout or 1 for content, feature) of each node, once per page and path."""
    nodes, pieces = parse(page)
    said: dict[int, list[str]] = {}
    for node, _, text in pieces:
        said.setdefault(node.path, []).append(text)
    layouts: dict[int, list[str]] = {}
    for node in nodes:
        layouts.setdefault(node.path, []).append(",".join(node.layout))
    for path, steps in layouts.items():
        yield path, 0, _hash("|".join(steps))
        yield path, 1, _hash(" ".join("".join(said.get(path, ())).split()))


def host_of(url) -> F.Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def unimportant(pages: DataFrame) -> DataFrame:
    """(host, low, lowest, high): style paths on many pages of a host, by importance; high by content alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
                name = host.as_py()
                counts[name, 0, 2, 0] += 1
                counts.update((name, *x) for x in style_counts(page.as_py()))
            rows = list(counts.items())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array([k[i] for k, _ in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int8(), pa.int64()))), pa.array([n for _, n in rows], pa.int64())],
                names=["host", "path", "kind", "feature", "n"],
            )

    text = F.coalesce(pages["html"], F.lit(""))
    once = (
        pages.select(host_of(pages["url"]).alias("host"), text.alias("html"), F.xxhash64(text).alias("h"), F.length(text).alias("l"))
        .withColumn("no", F.monotonically_increasing_id())
    )
    first = stored(once.groupBy("host", "h", "l").agg(F.min("no").alias("no")).select("no"), "first-pages")
    counted = (
        once.join(first, "no", "left_semi").select("host", "html")
        .mapInArrow(run, "host string, path long, kind byte, feature long, n long")
        .groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n"))
    )
    nodes = stored(
        counted.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("nlogn")), "style-nodes"
    )
    size = nodes.where("kind = 2").select("host", F.col("pages").alias("host_pages"))
    entropy = F.when(F.col("pages") > 1, (F.log("pages") - F.col("nlogn") / F.col("pages")) / F.log("pages")).otherwise(F.lit(1.0))
    importance = nodes.where("kind < 2").groupBy("host", "path").agg(
        F.max(entropy).alias("importance"), F.max(F.when(F.col("kind") == 1, entropy)).alias("content"), F.max("pages").alias("pages")
    )
    return (
        importance.join(size, "host")
        .where(((F.col("importance") < LOW) | (F.col("content") >= HIGH)) & (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= SHARE * F.col("host_pages")))
        # a host has few such paths: each is on a tenth of its pages
        .groupBy("host").agg(
            F.collect_list(F.when(F.col("importance") < LOW, F.col("path"))).alias("low"),
            F.collect_list(F.when(F.col("importance") < LOW_MAIN, F.col("path"))).alias("lowest"),
            F.collect_list(F.when(F.col("content") >= HIGH, F.col("path"))).alias("high"),
        )
    )


def main_texts(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    low = stored(unimportant(pages), "style-low")
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), host_of(pages["url"]).alias("host"), F.coalesce(pages["html"], F.lit("")).alias("html")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                extract(page.as_py(), *(frozenset(x.as_py() or ()) for x in paths))
                for page, *paths in zip(*(batch.column(c) for c in ("html", "low", "high", "lowest")), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(x) for x in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.join(low, "host", "left").select("page_id", "url", "html", "low", "high", "lowest").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


ORACLES: dict[str, str] = {}
QUERIES = {"op6_html_extract": op6_html_extract}

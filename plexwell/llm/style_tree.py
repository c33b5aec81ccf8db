"""Main text of web pages with site style trees.

The DOMs of one host are merged: elements with equal paths of tags and classes from the root are one style node. Over the
pages that have a node, the entropy of its presentation (the tags of its children) and of its content (the texts below)
give its importance: what looks and reads alike on page after page is template. Branches of low importance are removed from
each page, inside an article as well as outside. Pages count once for each article of a site: of pages whose longest blocks agree
in the least hash of their runs of four words (copies, and most near copies) one is counted, so copies of an article do not
remove each other.

Some branches say what they are: by tag or role (menus, headers, footers, sidebars, forms, scripts), and by class or id
(adverts, notices, comments), where the site can't tell, as it shows each of them once. Inside an article only containers
are taken at their class's word, and no element around an article is. Where a page marks its article (``article``, ``main``,
roles, class names), the text is what is inside.

One row for a page, with hashes for its nodes, goes to its (site, article); counts are sums for each site, node and value, so
a host with a third of all pages is as good as any. The low nodes of hosts are written: if Spark finds that table small it
copies it to the tasks that read pages, else the join's hot hosts are split.

A page is read once from left to right: a tag that never ends, and what follows it, is text; elements left open end with the
page. Null and empty pages have empty text. Rows with equal or null page_id are handled each for themselves; pages with a null
url or one without a host form a site of their own. Ties need no rule: a value counts by how many articles show it. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_batches, giving_back

# Fixed values of HTML: elements without content, elements whose content is no markup, and elements within a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript textarea title iframe svg math object canvas xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split()
)
#: Elements that an opening tag of the same kind (or of the second set) ends.
ENDED_BY = {
    "p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}
NOISE_TAGS = frozenset("nav header footer aside form button select menu dialog head".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that hold others rather than text of their own.
CONTAINERS = frozenset("div section ul ol dl table details fieldset center".split())
#: Whole words of class and id values that name furniture.
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar widget header masthead footer copyright comment comments reply replies disqus share sharing social "
    "related newsletter subscribe signup login search pagination pager toolbar skip".split()
)
#: Words beside which those only describe a layout (has-sidebar, header-fixed, content-sidebar-wrap).
LAYOUT_WORDS = frozenset("has with no without is wrap wrapper container layout page content main body fixed sticky".split())
MAIN_WORDS = frozenset("article main content post entry story".split())

_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"[\s/=]*([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_END = re.compile(r"[\s/=]*")
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"[a-z]+")
_SITE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _named(value: str) -> bool:
    """A class or id value has a name that says furniture."""
    return any(NOISE_WORDS & words and not LAYOUT_WORDS & words for words in (set(_WORD.findall(name)) for name in value.split()))


class Node:
    """An element: what it is, and where it stands in the style tree of its site (``path``, a hash)."""

    __slots__ = ("tag", "style", "path", "parent", "children", "items", "furniture", "named", "starts", "main", "noise", "around")

    def __init__(self, tag: str, found: dict[str, str], parent: "Node | None"):
        self.tag, self.parent = tag, parent
        name, role = found.get("class", "").lower(), found.get("role", "").lower().split()
        self.style = f"{tag}.{' '.join(sorted(name.split()))}"
        self.path = xxhash.xxh64_intdigest(self.style.encode("utf-8", "surrogatepass"), parent.path if parent else 0)
        ids = f"{name} {found.get('id', '').lower()}"
        self.named = bool(ids.strip()) and tag not in ("html", "body", "main") and _named(ids)
        hidden = "hidden" in found and found["hidden"].lower() != "until-found" or found.get("aria-hidden", "").lower() == "true"
        self.furniture = tag in NOISE_TAGS or bool(NOISE_ROLES.intersection(role)) or hidden
        self.around = (tag in ("article", "main") or "main" in role or "article" in role) and not self.named and not self.furniture
        self.starts = self.around or tag in ("div", "section") and not self.named and bool(MAIN_WORDS & set(_WORD.findall(ids)))
        self.main = self.noise = False
        self.children: list[str] = []
        self.items: list = []  # texts and elements in order


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes of a tag from behind its name, the first of each name, and the place of its end (-1: it has none)."""
    found: dict[str, str] = {}
    while at < len(page):
        if page[at] == ">":
            return found, at
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            at = _END.match(page, at).end()
            if at >= len(page) or page[at] != ">":
                return found, -1
            continue
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
        at = m.end()
    return found, -1


def walk(page: str) -> tuple[list[Node], list[tuple[Node, str | None]]]:
    """All nodes, and events in page order: (node, text) within ``node``, (node, None) where a block begins or ends."""
    root = Node("html", {}, None)
    stack, nodes, at, n = [root], [root], 0, len(page)
    open_: Counter[str] = Counter()  # tags on the stack
    blocks = [0]  # places on it that are not inline
    events: list[tuple[Node, str | None]] = []

    def tell(text: str) -> None:
        if text:
            events.append((stack[-1], text))
            stack[-1].items.append(text)

    def close(depth: int) -> None:
        while len(stack) > depth:
            open_[stack.pop().tag] -= 1
        while blocks[-1] >= depth:
            blocks.pop()

    while at < n:
        start = page.find("<", at)
        if start < 0:
            tell(page[at:])
            break
        tell(page[at:start])
        m = _NAME.match(page, start)
        if m is None:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = n if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), start):
                end = page.find(">", start)
                at = n if end < 0 else end + 1
            else:
                tell("<")
                at = start + 1
            continue
        tag, found, end = m[2].lower(), {}, m.end()
        if page[end : end + 1] != ">":
            found, end = _attributes(page, end)
        if end < 0:  # the tag never ends
            tell(page[start:])
            break
        empty, at = page[end - 1] == "/", end + 1
        if m[1]:
            if open_[tag]:
                depth = len(stack) - 1
                while stack[depth].tag != tag:
                    depth -= 1
                if blocks[-1] >= depth:
                    events.append((stack[-1], None))
                close(depth)
            elif tag == "p":
                events.append((stack[-1], None))
            continue
        if tag == "html":
            continue
        if tag == "br":
            tell(" ")
            continue
        # an opening block ends a paragraph (or item, cell) around it, with whatever is left open in that
        if blocks[-1] > 0 and tag in ENDED_BY.get(stack[blocks[-1]].tag, ()):
            close(blocks[-1])
        if tag not in INLINE:
            events.append((stack[-1], None))
        if tag in VOID:
            continue
        node = Node(tag, found, stack[-1])
        stack[-1].children.append(node.style)
        stack[-1].items.append(node)
        nodes.append(node)
        if tag in RAW:
            if not empty:  # to its end tag, whatever markup it holds
                e = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = e.end() if e else n
        elif not empty:
            if tag not in INLINE:
                blocks.append(len(stack))
            stack.append(node)
            open_[tag] += 1
    for x in reversed(nodes):  # children stand after their parents
        if x.around and x.parent is not None:  # an element around an article is none of what its class says
            x.parent.around = True
    for x in nodes[1:]:
        up = x.parent
        x.main = up.main or x.starts
        inside = up.main
        furniture = x.furniture and not (x.tag == "header" and inside)  # the header of an article holds its title
        named = x.named and not x.around and (not inside or x.tag in CONTAINERS or x.tag == "article")  # an article in one: a comment
        x.noise = up.noise or furniture or named
    return nodes, events


def site_of(url: str | None) -> str:
    """The host of a url, lower-cased, without credentials and port; empty where there is none."""
    m = re.match(_SITE, url or "")
    return m[1].lower() if m else ""


def _site(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, _SITE, 1), F.lit("")))


def _hash(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def style_nodes(page: str) -> tuple[int, dict[int, tuple[int, int, bool]]]:
    """The page's article (a hash), and for each style node presentation and content (hashes) and whether it is in an article.

    A node's content is hashed from its texts and elements in order, and elements of one style node are put together in order.
    """
    nodes, events = walk(page)
    below: dict[int, int] = {}
    for x in reversed(nodes):
        h = 0
        for item in x.items:
            if isinstance(item, Node):
                if below[id(item)]:
                    h = _hash("e", h ^ below[id(item)])
            elif item.strip():
                h = _hash(_SPACE.sub(" ", item), h)
        below[id(x)] = h
    out: dict[int, tuple[int, int, bool]] = {}
    for x in nodes:
        if not x.noise and x.tag not in INLINE and not (x.main and x.tag in HEADINGS):
            look, content, _ = out.get(x.path, (0, 0, False))
            out[x.path] = (_hash(",".join(x.children), look), _hash("n", content ^ below[id(x)]), x.main)
    words = max(_blocks(nodes, events), key=len, default="").split()
    runs = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    return min(map(_hash, runs)), out


def _blocks(nodes: list[Node], events: list[tuple[Node, str | None]], low: frozenset[int] = frozenset()) -> list[str]:
    marked = any(x.main and not x.noise for x in nodes)
    if low:
        for x in nodes:
            x.noise |= x.path in low or x.parent is not None and x.parent.noise
    blocks: list[list[str]] = [[]]
    for node, text in events:
        if text is None:
            if blocks[-1]:
                blocks.append([])
        elif not node.noise and (node.main or not marked):
            blocks[-1].append(text)
    done = (_SPACE.sub(" ", entities.unescape("".join(b))).strip() for b in blocks)
    return [b for b in done if b]


def main_text(page: str, low: frozenset[int] = frozenset()) -> str:
    """Blocks of the main text; ``low``: the site's style nodes (paths) to leave out."""
    return "\n\n".join(_blocks(*walk(page), low))


#: Articles of its site that must have a node before the site judges it: outside articles, and inside them.
MIN_PAGES, MIN_INSIDE = 4, 8
#: Nodes of less importance are removed.
MIN_IMPORTANCE = 0.3
#: Share of the presentation in a node's importance.
GAMMA = 0.1

_SEEN = "site string, article long, page long, nodes array<struct<node:long,look:long,content:long,inside:boolean>>"


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _styles(batches):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.struct([("node", pa.int64()), ("look", pa.int64()), ("content", pa.int64()), ("inside", pa.bool_())])))
    for batch in cut_batches(batches, 1):
        cols: list[list] = [[], [], [], []]
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            article, nodes = style_nodes(page or "")
            listed = [{"node": _signed(k), "look": _signed(a), "content": _signed(b), "inside": c} for k, (a, b, c) in nodes.items()]
            for c, v in zip(cols, (site_of(url), _signed(article), _signed(_hash(page or "")), listed), strict=True):
                c.append(v)
        yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["site", "article", "page", "nodes"])


def importance(pages: DataFrame) -> DataFrame:
    """site, node, m (articles of the site that have it), inside, importance of every style node that is not furniture.

    With m articles, c of them showing one value: presentation importance is the entropy of the c/m to base m; content
    importance is one less the mean over contents of how evenly they spread, log c / log m. A node of one article has none.
    """
    once = pages.select("url", "html").mapInArrow(giving_back(_styles), _SEEN).groupBy("site", "article").agg(F.min_by("nodes", "page").alias("nodes"))
    seen = once.select("site", F.inline("nodes"))
    value = F.stack(F.lit(2), F.lit(False), F.col("look"), F.lit(True), F.col("content")).alias("of_content", "value")
    counts = seen.select("site", "node", "inside", value).groupBy("site", "node", "of_content", "value").agg(F.count("*").alias("c"), F.max("inside").alias("inside"))
    log_c = F.log(F.col("c").cast("double"))
    by_node = counts.groupBy("site", "node").agg(
        F.max("inside").alias("inside"), F.sum(F.when(~F.col("of_content"), F.col("c"))).alias("m"),
        F.sum(F.when(~F.col("of_content"), F.col("c") * log_c)).alias("clogc"), F.sum(F.when(F.col("of_content"), log_c)).alias("logc"), F.count_if("of_content").alias("contents"),
    )
    log_m = F.log(F.col("m").cast("double"))
    look = (log_m - F.col("clogc") / F.col("m")) / log_m
    content = 1 - F.col("logc") / F.col("contents") / log_m
    return by_node.select("site", "node", "m", "inside", F.when(F.col("m") > 1, GAMMA * look + (1 - GAMMA) * content).alias("importance"))


def low_nodes(pages: DataFrame, min_importance: float = MIN_IMPORTANCE) -> DataFrame:
    """site, low: the style nodes of each site whose importance is below the limit."""
    enough = F.col("m") >= F.when(F.col("inside"), MIN_INSIDE).otherwise(MIN_PAGES)
    return importance(pages).where(enough & (F.col("importance") < min_importance)).groupBy("site").agg(F.collect_set("node").alias("low"))


def _extract(batches):
    for batch in cut_batches(batches, 2):
        texts = []
        for page, low in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            texts.append(main_text(page or "", frozenset(k & (1 << 64) - 1 for k in low or ())))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page."""
    pages = pages.select("page_id", "url", "html")
    low = Scratch(pages.sparkSession, "style-tree").table(low_nodes(pages), "low").select(F.col("site").alias("low_site"), "low")
    met = pages.join(low, _site(F.col("url")) == F.col("low_site"), "left")
    return met.select("page_id", "url", "html", "low").mapInArrow(giving_back(_extract), "page_id long, url string, text string, n_chars long")


def op4_style_tree(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))

"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are element paths (tags with their classes,
digits aside). Each node has an importance from entropies over the host's pages. Presentation: how
varied its children's tags are. Content: a text that stands in one page of m counts 1, one that
stands in all of them 0 (one less the logarithm, to base m, of the pages that hold it), averaged over
all texts under the node. Branches in which all nodes are of low importance are taken out of each page.

Elements whose role HTML itself or their class names tell (menus, page headers and footers, asides,
notices, adverts, forms, comments, scripts) are taken out without statistics, as small hosts have
none: below ``least_pages`` pages a node is not judged. If a page has an ``article`` or ``main``
element with text, its text is that element's.

Text blocks (paragraphs, list items, headings) are leaves of the tree, by their text: one that stands
in many of the host's pages is of low importance and goes, in articles too. There, elements that text
consists of are judged by these leaves, and inline ones by their path if they have a class (others are
part of a sentence). Pages of equal text count once, and a page of which most characters would go so
is a copy of others rather than a page with notices: it keeps its blocks.

The tree is built by Spark: a small row per page and node, counted per host and node with partial
sums before the shuffle, so a host with a third of all pages costs no more than others. What meets the
pages again is a list of element paths per host.

Nulls and edge cases: a null or empty html has the empty text; a null or odd url has the empty host;
broken markup is read as browsers do (open elements are closed where the next needs it); repeated
rows get equal results; an empty table gives no rows. Further columns are kept, ``text`` and
``n_chars`` replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.folders import written
from tidewatch.llm.url_filters import url_host

#: HTML's elements without contents, with raw contents, and those that break the flow.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre search section summary table tbody tfoot thead tr ul".split()
)
FLOW = frozenset(
    "a abbr b blockquote br caption cite code dd dl dt em figcaption h1 h2 h3 h4 h5 h6 i li ol p pre q "
    "s small span strong sub sup table tbody td tfoot th thead tr u ul".split()
)
#: What a start tag closes, up to the elements that bound the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}), "option": ({"option"}, {"select"}),
}
#: Elements that are no main text, and words in class, id or role that say so (fixed values).
APART = frozenset(
    "head script style noscript template iframe object embed applet svg canvas nav menu footer aside "
    "form button select textarea input dialog noembed noframes title".split()
)
APART_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising adsense banner sponsor sponsored promo promotion "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget widgets footer masthead "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription "
    "signup login search share sharing social related recommended comment comments disqus replies "
    "respond pagination pager copyright toolbar skip complementary contentinfo".split()
)
PAGE_HEADER = frozenset(["header", "topbar", "heading-bar"])
#: Words that may stand beside such a name in one class ("share-buttons", "site-footer"). Beside others
#: ("has-sidebar", "no-ads", "comment-open") the name tells of a state or a layout, not of a role.
BESIDE = frozenset(
    "site page main primary secondary global post posts top bottom left right button buttons bar box "
    "block list link links area section container item items unit slot form icon icons panel inner".split()
)

#: Text within a block; the verdict on its path reaches it in articles if it has a class.
INLINE = FLOW - BLOCK - VOID

#: Tasks that a host's pages are dealt to where the lists of its branches are too large to broadcast.
SALTS = 64

TAG = re.compile(
    r"<(?:!--(?P<comment>.*?)(?:-->|\Z)|[!?][^>]*+>"
    r"|(?P<close>/?)(?P<name>[a-zA-Z][^\s/<>]*+)"
    r"(?P<attrs>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
NAME_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Node:
    tag: str
    name: str
    apart: bool = False
    doubtful: bool = False  # apart, but only by a name or as a form
    children: list = field(default_factory=list)  # nodes and strings


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def _named(names: str, roles: frozenset[str]) -> bool:
    """Whether a class, id or role is the name of a role, alone or beside words for a kind of box."""
    for name in names.split():
        parts = {p for p in NAME_PARTS.split(name) if p}
        if name in roles or (parts & roles and parts <= roles | BESIDE):
            return True
    return False


def _new_node(tag: str, raw: str, in_article: bool) -> Node:
    sure = (tag in APART and tag != "form") or (tag == "header" and not in_article)
    if not raw or raw.isspace():
        return Node(tag, tag, sure or tag == "form", tag == "form")
    attrs = _attributes(raw)
    names = " ".join(attrs.get(k, "") for k in ("class", "id", "role")).lower()
    sure = (
        sure or "hidden" in attrs or attrs.get("aria-hidden") == "true"
        or bool(HIDDEN.search(attrs.get("style", "")))
    )
    apart = (
        sure or tag == "form" or _named(names, APART_NAMES)
        or (not in_article and _named(names, PAGE_HEADER))
    )
    if tag in ("html", "body", "article", "main"):
        apart = False
    label = "." .join(sorted(p for p in NAME_PARTS.split(attrs.get("class", "").lower()) if p))
    return Node(tag, f"{tag}.{label}" if label else tag, apart, apart and not sure)


def _spare(root: Node) -> None:
    """Keep doubtful branches that hold the page's main elements, headings, articles or most of its text."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(
            c for c in node.children if isinstance(c, Node) and (c.doubtful or not c.apart) and c.tag not in RAW
        )
    if not any(n.doubtful for n in order):
        return
    held: dict[int, tuple[int, int, int, int]] = {}  # mains, h1, articles, characters
    for node in reversed(order):
        parts = [held[id(c)] for c in node.children if id(c) in held]
        text = sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        held[id(node)] = (
            (node.tag == "main") + sum(p[0] for p in parts), (node.tag == "h1") + sum(p[1] for p in parts),
            (node.tag == "article") + sum(p[2] for p in parts), text + sum(p[3] for p in parts),
        )
    mains, headings, articles, size = held[id(root)]
    for node in order:
        if node.doubtful:
            here = held[id(node)]
            most = 2 * here[3] > size
            node.apart = not (
                0 < mains == here[0] or 0 < headings == here[1]
                # articles beside the page's heading may be its readers' comments
                or (0 < articles == here[2] and (most or headings == here[1]))
                or (most and not mains and not articles)
            )


def parse(page: str) -> Node:
    """The element tree of a page, with open elements closed where HTML says so."""
    root = Node("#root", "")
    stack, at, size = [root], 0, len(page)
    articles = 0
    while at < size:
        found = TAG.search(page, at)
        if not found:
            stack[-1].children.append(page[at:])
            break
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        tag = name.lower()
        if found["close"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    articles -= sum(n.tag in ("article", "main") for n in stack[k:])
                    del stack[k:]
                    break
            continue
        closes, bounds = CLOSES.get(tag, (None, None))
        if tag in BLOCK:  # a block ends an open paragraph
            closes, bounds = (closes or set()) | {"p"}, (bounds or set()) | {"td", "th", "div", "article", "body"}
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    break
                if stack[k].tag in bounds:
                    break
        node = _new_node(tag, found["attrs"], articles > 0)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
        elif tag not in VOID and not found["attrs"].endswith("/"):
            stack.append(node)
            articles += tag in ("article", "main")
    _spare(root)
    return root


def _path(parent: str, node: Node) -> str:
    return f"{parent}>{node.name}"


def _feature(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)


def features(root: Node) -> set[tuple[str, int, int]]:
    """(path, kind, feature) of a page: 0 a text, 1 the children's tags, 2 that the node is there.

    Elements that are taken out by their role are left out here as well.
    """
    out: set[tuple[str, int, int]] = set()
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        tags: list[str] = []
        for child in node.children:
            if isinstance(child, str):
                text = " ".join(child.split())
                if text:
                    out.add((path, 0, _feature(text)))
            elif not child.apart:
                if not tags or tags[-1] != child.name:
                    tags.append(child.name)
                stack.append((_path(path, child), child))
        out.add((path, 1, _feature(" ".join(tags))))
        out.add((path, 2, 0))
    return out


def _blocks(node: Node, path: str, low: frozenset[str], in_article: bool) -> list[str]:
    """Texts of the blocks under a node, without those taken out, in page order."""
    out: list[str] = []
    held: list[str] = []

    def end() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append(text)

    # (node, path, inside an article), or None where a block ends
    stack: list = [(node, path, in_article)]
    while stack:
        item = stack.pop()
        if item is None:
            end()
            continue
        if isinstance(item, str):
            held.append(item)
            continue
        node, path, inside = item
        inside = inside or node.tag in ("article", "main")
        if node.tag in BLOCK:
            end()
            stack.append(None)
        elif node.tag in ("br", "td", "th"):
            held.append(" ")
        for child in reversed(node.children):
            if isinstance(child, str):
                stack.append(child)
            elif not child.apart:
                below = _path(path, child)
                spared = inside and child.tag in FLOW and (child.tag not in INLINE or child.name == child.tag)
                if below not in low or spared:
                    stack.append((child, below, inside))
    end()
    return out


def _articles(root: Node) -> list[tuple[Node, str]]:
    """The outermost article elements and their paths, else the main elements, else none."""
    for tag in ("article", "main"):
        found, stack = [], [(root, "")]
        while stack:
            node, path = stack.pop()
            if node.tag == tag:
                found.append((node, path))
                continue
            stack.extend(
                (c, _path(path, c)) for c in reversed(node.children)
                if isinstance(c, Node) and not c.apart
            )
        if found:
            return found
    return []


def _leaf(block: str) -> str:
    """The name of a text block among a host's paths."""
    return f"#{_feature(block)}"


def _main_blocks(root: Node, low: frozenset[str] = frozenset()) -> list[str]:
    """The blocks of the page's articles if these have any, else of the whole page."""
    inside = [b for n, p in _articles(root) for b in _blocks(n, p, low, True)]
    return inside or _blocks(root, "", low, False)


def main_text(page: str, low: frozenset[str] = frozenset()) -> str:
    """The main text of a page, without branches whose paths, and blocks whose leaves are in ``low``."""
    blocks = _main_blocks(parse(page), low)
    own = [b for b in blocks if _leaf(b) not in low] if low else blocks
    if 2 * sum(map(len, own)) >= sum(map(len, blocks)):
        blocks = own
    return "\n\n".join(blocks)


# ---------------------------------------------------------------- the tree, in Spark


def tree(pages: DataFrame) -> DataFrame:
    """Per host and element path or block: the pages of different text that have it, and sums over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, texts = (batch.column(k).to_pylist() for k in ("host", "html"))
            host, path, kind, feature, text = [], [], [], [], []
            for h, page in zip(hosts, texts, strict=True):
                root = parse(page or "")
                blocks = _main_blocks(root)
                key = _feature("\n\n".join(blocks))
                for p, k, f in (*features(root), *((_leaf(b), 2, 0) for b in set(blocks))):
                    host.append(h)
                    text.append(key)
                    path.append(p)
                    kind.append(k)
                    feature.append(f)
                if len(host) > 50_000:
                    yield pa.RecordBatch.from_pydict(
                        {"host": host, "path": path, "kind": pa.array(kind, pa.int32()), "feature": feature, "text": text}
                    )
                    host, path, kind, feature, text = [], [], [], [], []
            if host:
                yield pa.RecordBatch.from_pydict(
                    {"host": host, "path": path, "kind": pa.array(kind, pa.int32()), "feature": feature, "text": text}
                )

    found = pages.select(url_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    rows = found.mapInArrow(run, "host string, path string, kind int, feature long, text long")
    counts = rows.distinct().groupBy("host", "path", "kind", "feature").count()

    def total(kind: int, value) -> F.Column:
        return F.sum(F.when(F.col("kind") == kind, value).otherwise(0.0))

    n = F.col("count").cast("double")
    sums = counts.groupBy("host", "path").agg(
        total(2, n).alias("pages"), total(0, n).alias("texts"), total(0, n * F.ln(n)).alias("shared"),
        total(1, n * F.ln(n)).alias("styled"),
    )
    # blocks of a single page are never low
    return sums.where(~F.col("path").startswith("#") | (F.col("pages") > 1))


def node_importance(pages: DataFrame, damping: float = 0.9) -> DataFrame:
    """Per host and element path: pages that have it, presentation, content and joint importance."""
    return _importance(tree(pages), damping)


def _importance(sums: DataFrame, damping: float = 0.9) -> DataFrame:
    sums = sums.where(~F.col("path").startswith("#"))
    base = F.ln("pages")
    alone = F.col("pages") <= 1
    # of one page nothing is known: all of it counts
    presentation = F.when(alone, 1.0).otherwise(1 - F.col("styled") / (F.col("pages") * base))
    content = F.when(alone, F.col("texts")).otherwise(
        F.col("texts") - F.col("shared") / F.greatest(base, F.lit(1e-9))
    )
    nodes = sums.select("host", "path", "pages", presentation.alias("presentation"), "texts", content.alias("kept"))
    spread = nodes.where("texts > 0").select("host", F.explode(_ancestors("path")).alias("path"), "texts", "kept")
    under = spread.groupBy("host", "path").agg((F.sum("kept") / F.sum("texts")).alias("content"))
    joint = F.when(F.col("content").isNull(), F.col("presentation")).otherwise(
        (1 - damping) * F.col("presentation") + damping * F.col("content")
    )
    return nodes.select("host", "path", "pages", "presentation").join(under, ["host", "path"], "left").select(
        "host", "path", "pages", "presentation", "content", joint.alias("importance")
    )


def _ancestors(path: str) -> F.Column:
    """The paths of a node and of all nodes above it."""
    parts = F.split(path, ">")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), ">")
    )


def noise(nodes: DataFrame, least_importance: float, least_pages: int) -> DataFrame:
    """(host, path) of branches in which no node is important, nor too rare to be judged."""
    judged = F.when(F.col("pages") < least_pages, 1.0).otherwise(F.col("importance"))
    return nodes.select("host", F.explode(_ancestors("path")).alias("path"), judged.alias("importance")).groupBy(
        "host", "path"
    ).agg(F.max("importance").alias("most")).where(F.col("most") < least_importance).drop("most")


def shared_blocks(sums: DataFrame, least_importance: float, least_pages: int) -> DataFrame:
    """(host, path) of blocks of low importance, in hosts of enough pages."""
    hosts = sums.where("path = ''").select("host", F.col("pages").alias("all"))
    content = 1 - F.ln("pages") / F.ln("all")
    return sums.where(F.col("path").startswith("#")).join(hosts, "host").where(
        (F.col("all") >= least_pages) & (content < least_importance)
    ).select("host", "path")


def extract_text(pages: DataFrame, least_importance: float = 0.3, least_pages: int = 10,
                 broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``pages`` (url, html) with ``text`` and ``n_chars`` in place of the html."""
    sums = written(tree(pages), "style-tree")
    low = written(
        noise(_importance(sums), least_importance, least_pages)
        .unionByName(shared_blocks(sums, least_importance, least_pages))
        .groupBy(F.col("host").alias("__host")).agg(F.collect_set("path").alias("__low")),
        "style-noise",
    )
    rows = pages.drop("text", "n_chars").withColumns(
        {"__host": url_host(F.col("url")), "html": F.col("html").cast("string")}
    )
    size = low.agg(F.sum(F.octet_length(F.concat_ws(" ", "__host", "__low")) + 32)).first()[0] or 0
    if size <= broadcast_bytes:  # the html stays where it is
        rows = rows.join(F.broadcast(low), "__host", "left")
    else:  # a host's pages are dealt over several tasks
        salted = low.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int")
        rows = rows.withColumn("__salt", salt).join(salted, ["__host", "__salt"], "left").drop("__salt")
    rows = rows.drop("__host")
    schema = rows.drop("html", "__low").schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page or "", frozenset(paths or ()))
                for page, paths in zip(
                    batch.column("html").to_pylist(), batch.column("__low").to_pylist(), strict=True
                )
            ]
            kept = [n for n in batch.schema.names if n not in ("html", "__low")]
            columns = [batch.column(n) for n in kept]
            columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)

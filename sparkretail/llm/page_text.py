"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged: nodes with the same path of tags and presentation
attributes are one node of the site's tree. For each node two entropies are taken over the
distinct pages of the host: that of its content (texts that stand on every page say
nothing, texts of one page say much) and that of its parent's presentation (how
differently the parent's children are laid out). Branches whose combined importance is low
are cut from every page. Nodes whose tag, role or name says that they are a menu, header,
footer, sidebar, notice, advert, form or comment have importance 0 from the start, and so
has what stands outside the article on a page that marks one.

Pages are parsed where they are read; only hashes of paths and texts are shuffled.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkretail.llm.common import durable

GAMMA = 0.9  # weight of content against presentation
LEAST_IMPORTANCE = 0.3
LEAST_IN_ARTICLE = 0.05
LEAST_PAGES = 8  # distinct pages of a host that show a node, before the tree may cut it
BROADCAST_NODES = 200_000  # low nodes (16 bytes each) that are sent to all tasks

# Element kinds of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
CLOSED_BY_LIKE = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
SCOPE = set("html body div article main section table ul ol dl td th blockquote form nav aside header footer".split())

# Tags, roles and names that tell what is not the article.
OTHER_TAGS = set(
    "nav footer aside form button select option textarea input label fieldset legend datalist head script style "
    "noscript template iframe object embed svg canvas audio video map dialog menu".split()
)
OTHER_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice popup modal overlay newsletter subscribe signup sidebar widget menu nav navbar navigation "
    "breadcrumb breadcrumbs comment comments respond disqus share sharing social related recommended footer header "
    "masthead login search pagination pager toolbar skip alert toast".split()
)
ARTICLE_NAMES = set("article entry post content main title".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


class Element:
    __slots__ = ("article", "children", "label", "other", "path", "tag")

    def __init__(self, tag: str, given: dict[str, str], parent: Element | None):
        self.tag = tag
        names = sorted(set(re.findall(r"[A-Za-z_-]+", given.get("class", "") + " " + given.get("id", ""))))
        self.label = ".".join([tag, *names])
        self.path = f"{parent.path}/{self.label}" if parent else self.label
        self.article = bool(parent and parent.article) or tag in ("article", "main") or given.get("role") in ("main", "article")
        self.children: list[str] = []
        if parent is not None:
            parent.children.append(self.label)
        words = {w.lower() for n in names for w in NAME.findall(n)}
        inside = bool(parent and parent.article)
        named = words & OTHER_NAMES
        if named == {"header"} and (inside or words & ARTICLE_NAMES):
            named = set()
        other = (
            tag in OTHER_TAGS or (tag == "header" and not inside) or given.get("role") in OTHER_ROLES
            or "hidden" in given or given.get("aria-hidden") == "true"
            or "display:none" in given.get("style", "").replace(" ", "").lower()
            or bool(named)
        )
        if tag in ("html", "body", "article", "main"):
            other = False
        wrapped = bool(parent and parent.other) and not (tag in ("article", "main") and parent.tag == "form")
        self.other = other or wrapped


def parse(page: str) -> tuple[list[tuple[str, str, str, bool]], dict[str, str]]:
    """Blocks of a page as (path, path of the parent, text, inside an article), in page
    order, and the layout of the children of each parent. Blocks of nodes that are not
    article by their kind are left out."""
    root = Element("#", {}, None)
    stack, blocks, held = [root], [], []
    elements = [root]
    owner = [root]  # the block element that the held text belongs to

    def block_element() -> Element:
        return next(e for e in reversed(stack) if e.tag not in INLINE)

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            if text and not owner[0].other:
                e = owner[0]
                blocks.append((e.path, e.path.rpartition("/")[0], text, e.article))
            held.clear()
        owner[0] = block_element()

    def add(raw: str) -> None:
        if raw and not stack[-1].other:
            held.append(html.unescape(raw) if "&" in raw else raw)

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                add(m[0][9:-3])
            continue
        tag, given = m[2].lower(), m[3]
        while given.count('"') % 2 and at < size:  # a > inside quotes does not end the tag
            end = page.find(">", at)
            if end < 0:
                break
            given += ">" + page[at:end]
            at = end + 1
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    if tag not in INLINE:
                        flush()
                    del stack[i:]
                    owner[0] = block_element() if not held else owner[0]
                    break
                if tag in INLINE and stack[i].tag in SCOPE:
                    break
            continue
        if tag == "br":
            add(" ")
            continue
        if tag not in INLINE:
            flush()
            if tag not in VOID:
                if any(e.tag == "p" for e in stack):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == "p":
                            del stack[i:]
                            break
                        if stack[i].tag in SCOPE:
                            break
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in CLOSED_BY_LIKE.get(tag, ()):
                        del stack[i:]
                    elif stack[i].tag in SCOPE:
                        break
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        element = Element(tag, _attributes(given), stack[-1])
        if tag not in INLINE:
            elements.append(element)
        stack.append(element)
        if tag not in INLINE:
            owner[0] = element
    flush()
    if any(b[3] for b in blocks):
        blocks = [b for b in blocks if b[3]]
    layouts = {}
    for e in elements:
        runs = [c for i, c in enumerate(e.children) if i == 0 or c != e.children[i - 1]]
        layouts.setdefault(e.path, "|".join(runs))
    return blocks, layouts


def number(text: str) -> int:
    """A 64-bit hash that is the same in every process."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def host_of(url: str | None) -> str:
    """Host of an address without case and port; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and node with text: its texts and the layout of its parent, hashed."""
    for batch in batches:
        rows = {"host": [], "page": [], "path": [], "parent": [], "article": [], "layout": [], "texts": []}
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            blocks, layouts = parse(page or "")
            host, digest = host_of(url), number(",".join(map(str, sorted({number(b[2]) for b in blocks}))))
            nodes: dict[str, tuple[str, bool, set[int]]] = {}
            for path, parent, text, article in blocks:
                nodes.setdefault(path, (parent, article, set()))[2].add(number(text))
            for path, (parent, article, texts) in nodes.items():
                for name, value in zip(
                    rows,
                    (host, digest, number(path), number(parent), article, number(layouts.get(parent, "")), sorted(texts)),
                    strict=True,
                ):
                    rows[name].append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["host"], pa.string()), pa.array(rows["page"], pa.int64()), pa.array(rows["path"], pa.int64()),
             pa.array(rows["parent"], pa.int64()), pa.array(rows["article"], pa.bool_()),
             pa.array(rows["layout"], pa.int64()), pa.array(rows["texts"], pa.list_(pa.int64()))],
            names=list(rows),
        )


NODES = "host string, page long, path long, parent long, article boolean, layout long, texts array<long>"


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, path, article, pages, content, presentation, importance) of all nodes with text.

    content = 1 - mean over the node's texts of log(pages with the text) / log(pages);
    presentation = - sum p log p / log(pages) over the layouts of the parent. Both are 1
    for a single page. Pages with an equal set of texts, those of the article where one is
    marked, count once: variants of one page do not make its article a text of the layout.
    """
    nodes = pages.select("url", "html").mapInArrow(_nodes, NODES)
    # Pages of one set of texts may differ in layout: the smallest values stand for them.
    once = durable(
        nodes.groupBy("host", "page", "path").agg(
            F.min("parent").alias("parent"), F.max("article").alias("article"),
            F.min("layout").alias("layout"), F.min("texts").alias("texts"),
        )
    )
    shown = once.groupBy("host", "path").agg(
        F.count("*").alias("pages"), F.max("article").alias("article"), F.min("parent").alias("parent")
    )
    texts = once.select("host", "path", F.explode("texts").alias("text")).groupBy("host", "path", "text").agg(F.count("*").alias("c"))
    spread = texts.groupBy("host", "path").agg(F.avg(F.log("c")).alias("spread"))
    layouts = once.select("host", "parent", "page", "layout").distinct().groupBy("host", "parent", "layout").agg(F.count("*").alias("c"))
    chosen = layouts.groupBy("host", "parent").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    content = F.when(F.col("pages") > 1, 1 - F.col("spread") / F.log("pages")).otherwise(F.lit(1.0))
    presentation = F.when(
        F.col("n") > 1, (F.log("n") - F.col("clogc") / F.col("n")) / F.log("n")
    ).otherwise(F.lit(1.0))
    return (
        shown.join(spread, ["host", "path"]).join(chosen, ["host", "parent"])
        .select("host", "path", "article", "pages", content.alias("content"), presentation.alias("presentation"))
        .withColumn("importance", GAMMA * F.col("content") + (1 - GAMMA) * F.col("presentation"))
    )


def low_nodes(tree: DataFrame) -> DataFrame:
    least = F.when(F.col("article"), F.lit(LEAST_IN_ARTICLE)).otherwise(F.lit(LEAST_IMPORTANCE))
    return tree.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < least)).select("host", "path")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for page, cut in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            blocks, _ = parse(page or "")
            low = set(cut or ())
            kept = [b for b in blocks if not low or number(b[0]) not in low]
            if not kept and any(b[3] for b in blocks):
                kept = blocks  # the tree never takes the whole article
            texts.append("\n\n".join(b[2] for b in kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, broadcast_nodes: int = BROADCAST_NODES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    White space inside a block becomes one space; blocks are joined by an empty line;
    character references are decoded. Null and empty pages, and pages without article
    text, have an empty text. A page without a host belongs to the host "". Repeated rows
    and null ids keep their rows; other columns are ignored; an empty table gives an empty
    result. ``broadcast_nodes`` only chooses the join: beyond it the pages are joined with
    their own low nodes by a key.
    """
    pages = pages.select("page_id", "url", "html")
    low = durable(low_nodes(style_tree(pages)))
    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"
    if low.count() <= broadcast_nodes:
        cuts: dict[str, list[int]] = {}
        for r in low.collect():
            cuts.setdefault(r["host"], []).append(r["path"])
        shared = pages.sparkSession.sparkContext.broadcast(cuts)

        def with_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def added():
                for batch in batches:
                    own = [shared.value.get(host_of(u), []) for u in batch.column(1).to_pylist()]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, pa.array(own, pa.list_(pa.int64()))], names=["page_id", "url", "html", "cut"]
                    )

            return _extract(added())

        return pages.mapInArrow(with_cuts, schema)
    keyed = pages.withColumn("_key", F.xxhash64("url", "html"))
    nodes = keyed.select("url", "html", "_key").mapInArrow(_paths, "host string, path long, _key long")
    own = nodes.join(low, ["host", "path"]).groupBy("_key").agg(F.collect_set("path").alias("cut"))
    return keyed.join(own, "_key", "left").select("page_id", "url", "html", "cut").mapInArrow(_extract, schema)


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, key) for every node with text of every page."""
    for batch in batches:
        hosts, paths, keys = [], [], []
        columns = (batch.column(i).to_pylist() for i in range(3))
        for url, page, key in zip(*columns, strict=True):
            own = {number(b[0]) for b in parse(page or "")[0]}
            hosts += [host_of(url)] * len(own)
            paths += sorted(own)
            keys += [key] * len(own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.int64()), pa.array(keys, pa.int64())],
            names=["host", "path", "_key"],
        )

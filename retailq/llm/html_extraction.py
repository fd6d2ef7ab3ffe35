"""Main text of web pages by consensus of their host.

Method: every page scores its containers by the text that they hold and votes for the generalised path (tags and classes, no
digits, no positions) of its best one; Spark counts the votes of each host, pre-aggregated, so a host with a third of all
pages is a few rows a task; then each page is extracted again from the elements at its host's winning path. A page without
a host, or without text at the winning path, keeps its own best container.

The best container is the innermost element that holds at least ``SHARE`` of the page's text outside links and outside
excluded parts, or the article or main element around it. Excluded are menus, headers, footers, sidebars, notices, adverts,
forms, reader comments, scripts, styles and hidden parts, by tag, role, class or id.

Defined results: NULL or empty html gives empty text; a NULL or unreadable url is a page without a host; equal pages and
repeated page_ids each give their row; ties of votes go to the path with more text, then the least path; columns other than
page_id, url and html are never read. Pages are read whole, whatever their length; an element left open ends with the page.
"""
from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, stored

SHARE = 0.6
SLICE = 4 << 20

# Element names of HTML.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td template tfoot th thead tr ul".split())
CONTAINERS = frozenset("html body article main section div td center".split())
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
P_SCOPE = frozenset("html body table td th caption button object article section div main".split())

# Parts that are not the article. The weak ones count unless they hold the page's article and half of its text.
OUT_TAGS = frozenset(
    "head nav header footer aside menu search script style noscript template button select textarea iframe object svg canvas dialog "
    "title audio video map xmp noembed noframes".split())
OUT_WORDS = frozenset(
    "comment comments respond disqus replies ad ads advert adverts advertisement advertising advertisements sponsor sponsored "
    "footer".split())
WEAK_TAGS = frozenset(["form"])
WEAK_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead sidebar promo promotion banner cookie cookies consent notice "
    "notices alert popup modal overlay newsletter subscribe signup login share sharing social related recommended pagination "
    "pager".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*))(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: int
    path: str
    out: bool = False
    weak: bool = False
    block: bool = True


@dataclass
class Page:
    """Nodes in page order (parents first) and text blocks: (node, text, characters of it inside links)."""
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), references.unescape(a or b or c))
    return found


def _node(tag: str, parent: int, above: str, rest: str) -> Node:
    node = Node(tag, parent, "", block=tag in BLOCKS)
    node.out = tag in OUT_TAGS
    node.weak = tag in WEAK_TAGS
    step = tag
    if rest and not rest.isspace() and rest != "/":
        attributes = _attributes(rest)
        classes = attributes.get("class", "")
        step = ".".join([tag, *sorted(filter(None, {re.sub(r"\d+", "", c) for c in classes.lower().split()}))])
        if tag not in ("html", "body", "article", "main"):
            marks = set(re.findall(r"[a-z]+", f"{classes} {attributes.get('id', '')}".lower()))
            node.out |= bool(marks & OUT_WORDS) or "hidden" in attributes or attributes.get("aria-hidden") == "true" \
                or bool(HIDDEN.search(attributes.get("style", "")))
            node.weak |= bool(marks & WEAK_WORDS) or attributes.get("role", "").lower() in OUT_ROLES
    node.path = f"{above}>{step}" if above else step
    return node


def parse(source: str) -> Page:
    """Elements and text blocks, with the end tags that HTML implies."""
    page = Page([Node("", -1, "")])
    stack = [0]
    pieces: list[str] = []
    linked = 0

    def flush():
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", "".join(pieces)).strip()
            if text:
                page.blocks.append((block_node(), text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def block_node() -> int:
        """The nearest block element; excluded or linked inline parts have already been told apart."""
        for i in reversed(stack):
            if page.nodes[i].block:
                return i
        return 0

    def pop_to(depth: int):
        del stack[depth:]

    def close(names, scope):
        for depth in range(len(stack) - 1, 0, -1):
            tag = page.nodes[stack[depth]].tag
            if tag in names:
                pop_to(depth)
                return
            if tag in scope:
                return

    def text(piece: str):
        nonlocal linked
        if not piece:
            return
        inline_link = False
        for i in reversed(stack):
            node = page.nodes[i]
            if node.block:
                break
            if node.out or node.weak:
                return
            inline_link |= node.tag == "a"
        piece = references.unescape(piece) if "&" in piece else piece
        pieces.append(piece)
        if inline_link:
            linked += len(piece.strip())

    at = 0
    while True:
        found = TAG.search(source, at)
        if not found:
            text(source[at:])
            break
        text(source[at:found.start()])
        at = found.end()
        name = found["name"]
        if name is None:
            if found[0].startswith("<![CDATA["):
                pieces.append(found[0][9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if found["end"]:
            if name in BLOCKS:
                flush()
            for depth in range(len(stack) - 1, 0, -1):
                node = page.nodes[stack[depth]]
                if node.tag == name:
                    pop_to(depth)
                    break
                if name not in BLOCKS and node.block:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if name == "br":
            pieces.append("\n")
            continue
        if name in BLOCKS:
            flush()
            if name in CLOSES:
                close(*CLOSES[name])
            else:
                close({"p"}, P_SCOPE)
        if name in VOID:
            continue
        rest = found["rest"]
        if name in RAW:
            ending = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
            at = len(source) if not ending else ending.start()
            if name == "iframe" or ending is None:
                continue
            last = source.find(">", at)
            at = len(source) if last < 0 else last + 1
            continue
        parent = stack[-1]
        if name in BLOCKS:  # paths are of block elements; an inline element left open is no level of them
            while not page.nodes[parent].block:
                parent = page.nodes[parent].parent
        page.nodes.append(_node(name, parent, page.nodes[parent].path, rest))
        if not (rest.endswith("/") and name not in BLOCKS):
            stack.append(len(page.nodes) - 1)
    flush()
    return page


def excluded(page: Page) -> list[bool]:
    """Per node: excluded itself or inside an excluded one."""
    held = [0] * len(page.nodes)
    article = [node.tag in ("article", "main") for node in page.nodes]
    for node, text, _ in page.blocks:
        held[node] += len(text)
    for i in range(len(page.nodes) - 1, 0, -1):
        held[page.nodes[i].parent] += held[i]
        article[page.nodes[i].parent] |= article[i]
    out = [False] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        out[i] = (i > 0 and out[node.parent]) or node.out or (node.weak and not (article[i] and 2 * held[i] >= held[0]))
    return out


def best_container(page: Page, out: list[bool]) -> tuple[int, int]:
    """(node, its text outside links): see the module's docstring. The document itself for a page without elements."""
    held = [0] * len(page.nodes)
    for node, text, linked in page.blocks:
        if not out[node]:
            held[node] += len(text) - linked
    for i in range(len(page.nodes) - 1, 0, -1):
        held[page.nodes[i].parent] += held[i]
    best = 0
    for i, node in enumerate(page.nodes):  # parents come first: the last one found lies innermost
        if node.tag in CONTAINERS and not out[i] and held[i] > 0 and held[i] >= SHARE * held[0]:
            best = i
    around = best
    while around > 0 and page.nodes[around].tag not in ("article", "main"):
        around = page.nodes[around].parent
    best = around or best
    return best, held[best]


def text_at(page: Page, out: list[bool], roots: set[int]) -> str:
    inside = [False] * len(page.nodes)
    for i, node in enumerate(page.nodes):
        inside[i] = i in roots or (i > 0 and inside[node.parent])
    return " ".join(text for node, text, _ in page.blocks if inside[node] and not out[node])


def vote_of(source: str) -> tuple[str, int]:
    page = parse(source)
    node, held = best_container(page, excluded(page))
    return page.nodes[node].path, held


def main_text(source: str, path: str | None) -> str:
    """The text at ``path``; without a path, or without text there, that of the page's own best container."""
    page = parse(source)
    out = excluded(page)
    if path is not None:
        found = text_at(page, out, {i for i, node in enumerate(page.nodes) if node.path == path})
        if found:
            return found
    return text_at(page, out, {best_container(page, out)[0]})


# ---- Spark ------------------------------------------------------------------------------------------------------

def host_of(url: Column) -> Column:
    """Lower-cased host name; NULL without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the winning path of every host, from one vote a page."""

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html", SLICE):
            found = [vote_of(source or "") for source in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array([p for p, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())],
                names=["host", "path", "held"])

    cast = pages.select(host_of(F.col("url")).alias("host"), "html").where(F.col("host").isNotNull()).mapInArrow(
        votes, "host string, path string, held long").where(F.col("held") > 0)
    counted = cast.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("held").alias("held"))
    return counted.groupBy("host").agg(F.min(F.struct(
        (-F.col("votes")).alias("votes"), (-F.col("held")).alias("held"), F.col("path").alias("path"))).alias("first")).select(
        "host", F.col("first.path").alias("path"))


def extract(pages: DataFrame, paths: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, given the paths of hosts.

    ``paths`` has one row a host. Where it is a written table, Spark knows its size and broadcasts it only below its own
    threshold; beyond, a shuffle join deals a host with very many pages over several tasks.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "html", SLICE):
            found = [main_text(source or "", path)
                     for source, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    known = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host")).join(paths, "host", "left")
    return known.select("page_id", "url", "html", "path").mapInArrow(texts, f"page_id {id_type}, url string, text string, n_chars long")


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every row of ``pages`` (page_id, url, html)."""
    return extract(pages, stored(host_paths(pages), "host-paths"))

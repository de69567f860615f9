"""Main text of web pages by wrapper induction.

The pages of a host are grouped by layout (the containers right below the body), and all different pages of a group are
aligned with one of them by simple tree matching, the largest order-preserving matching of two trees whose roots agree
(children that are equal with their texts first). A leaf whose text is the same on all pages that have it, and that half
of the group's pages and at least `FEWEST` have, belongs to the host's template; a leaf that varies is a slot. The wrapper
keeps the paths and texts of the constant leaves.

Every page is then parsed whole. Elements that never hold an article's text (navigation, page headers and footers,
sidebars, forms, scripts, notices, adverts, comments: by tag, role, or words of class and id) are left out, and so are
template nodes of the host, inside the article element and outside it. If the page has an article or main element, its
blocks are the text (of several articles, teasers, mostly links, are left out); otherwise the body's remaining slots are.

Character references are decoded; white space inside a block becomes one space; blocks are joined by one space in page
order. Nothing is cut off, and elements may nest to any depth.

Defined results: null or empty html gives an empty text; unclosed and stray tags are read as browsers do in the simple
cases (p, li, td, ... close each other); a page whose host has no other page is read without a wrapper; null urls share
one host; repeated rows are read one by one; a very long page is one row's tree, and its lists of children are aligned whole;
extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm.common import bounded_batches, materialise

#: The fewest pages that make a wrapper.
FEWEST = 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("nav footer aside form script style noscript template button select option textarea iframe object embed svg canvas audio video dialog menu head title label input noembed noframes map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {
    "p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul figure details".split()),
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option", "optgroup"]),
}
CONTAINERS = frozenset("div section main article header footer nav aside form table center".split())
#: Words of a class or id that say that an element is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead topbar toolbar share sharing social related recommended recommendations trending "
    "comment comments respond reply replies disqus discussion feedback pagination pager toc login search hidden skip print copyright legal disclaimer paywall".split()
)
#: Words that may stand beside a mark in one name (ad-slot, site-footer) without changing what it says.
BESIDE = frozenset(
    "a area bar block body reader readers user users visitor visitors bottom box center class col column container content first group hidden holder inner item items js large last left link links list main mobile outer page placeholder post primary right row section "
    "secondary site slot small space spot text top unit wrap wrapper zone".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


#: Trees are walked by recursion in Python alone, which takes memory and no C stack.
sys.setrecursionlimit(max(sys.getrecursionlimit(), 10_000_000))


@dataclass(slots=True)
class Node:
    tag: str
    mark: str = ""
    boiler: bool = False
    children: list = field(default_factory=list)  # nodes and strings
    shape: tuple | None = None


@lru_cache(4096)
def marked(name: str) -> bool:
    """Does one class name or id say that an element is not the article? It must say nothing else: notice-board, feature-search
    and comment-on-policy are names of content."""
    parts = [p for x in _PARTS.split(_CAMEL.sub("-", name).lower()) if (p := x.strip("0123456789"))]
    return not MARKS.isdisjoint(parts) and all(x in MARKS or x in BESIDE for x in parts)


@lru_cache(4096)
def attributes(raw: str) -> tuple[str, bool]:
    """(class and id, is the element no part of an article) from a tag's attributes."""
    mark, boiler = [], False
    for m in _ATTR.finditer(raw):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            mark.append(value.strip())
            boiler |= any(map(marked, value.split()))
        elif name == "role":
            boiler |= value.strip().lower() in ROLES
        elif name == "hidden":
            boiler = True
        elif name == "aria-hidden":
            boiler |= value.strip().lower() == "true"
        else:
            boiler |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return " ".join(filter(None, mark)), boiler


def parse(source: str) -> Node:
    """The page's tree; the root has no tag."""
    root = Node("")
    stack, at = [root], 0
    for m in _TAG.finditer(source):
        if m.start() < at:
            continue
        if m.start() > at:
            stack[-1].children.append(source[at : m.start()])
        at = m.end()
        # the second form: a tag with an open quote ends at the next >
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        while len(stack) > 1 and tag in CLOSES.get(stack[-1].tag, ()):
            stack.pop()
        # a block also closes a paragraph that holds open inline elements
        if tag in CLOSES["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag not in INLINE:
                    break
        mark, boiler = attributes(raw) if raw else ("", False)
        node = Node(tag, mark, boiler)
        stack[-1].children.append(node)
        if tag in VOID or raw.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(source, at)
            node.children.append(source[at : end.start() if end else len(source)])
            at = end.end() if end else len(source)
            continue
        stack.append(node)
    if at < len(source):
        stack[-1].children.append(source[at:])
    return root


def own_text(node: Node) -> str:
    return _SPACE.sub(" ", html.unescape("".join(c for c in node.children if isinstance(c, str)))).strip()


def whole_text(node: Node) -> str:
    parts: list[str] = []

    def walk(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                parts.append(c)
            else:
                walk(c)
                parts.append(" ")

    walk(node)
    return _SPACE.sub(" ", html.unescape("".join(parts))).strip()


def matching(a: Node, b: Node, found: list | None = None) -> int:
    """Simple tree matching: size of the largest matching of two trees; `found` gets the matched pairs.

    Two nodes match if tag and marks agree; children are matched in order by dynamic programming. Children that are equal
    with their texts are matched first, from both ends of the lists and where a text occurs once in each list; without
    texts the matching is the largest there is. Lists of any length are aligned whole.
    """
    if a.tag != b.tag or a.mark != b.mark:
        return 0
    xs, ys = ([c for c in n.children if isinstance(c, Node)] for n in (a, b))
    if found is not None:
        found.append((a, b))
    if not xs or not ys:
        return 1
    return 1 + _lists(xs, ys, found)


def _shape(n: Node) -> tuple[int, int]:
    """Hashes of a tree with its texts and without them, kept in the node."""
    if n.shape is None:
        below = [c if isinstance(c, str) else _shape(c) for c in n.children]
        n.shape = hash((n.tag, n.mark, *[c if isinstance(c, str) else c[0] for c in below])), hash((n.tag, n.mark, *[c[1] for c in below if not isinstance(c, str)]))
    return n.shape


def _has_text(n: Node) -> bool:
    held = [n]
    while held:
        for c in held.pop().children:
            if not isinstance(c, str):
                held.append(c)
            elif c:
                return True
    return False


def _ends(xs: list, ys: list, kx: list, ky: list) -> tuple[int, int]:
    """How many children are equal at the heads, and then at the tails."""
    most = min(len(xs), len(ys))
    head = next((i for i in range(most) if kx[i] != ky[i]), most)
    tail = next((i for i in range(most - head) if kx[-1 - i] != ky[-1 - i]), most - head)
    return head, tail


def _anchors(kx: list, ky: list) -> list[tuple[int, int]]:
    """The longest increasing run of places of keys with text that occur once in each list."""
    once = {k: j for j, k in enumerate(ky) if k is not None}
    nx, ny = Counter(kx), Counter(ky)
    tops: list[int] = []
    chain: list[tuple[int, int, object]] = []
    ends: list = []
    for i, k in enumerate(kx):
        if k is None or nx[k] != 1 or ny.get(k) != 1:
            continue
        j = once[k]
        at = bisect_left(tops, j)
        link = (i, j, ends[at - 1] if at else None)
        chain.append(link)
        tops[at : at + 1] = [j]
        ends[at : at + 1] = [link]
    out, link = [], ends[-1] if ends else None
    while link:
        out.append((link[0], link[1]))
        link = link[2]
    return out[::-1]


def _lists(xs: list, ys: list, found: list | None) -> int:
    total = 0
    kx, ky = ([_shape(c)[0] for c in n] for n in (xs, ys))
    head, tail = _ends(xs, ys, kx, ky)
    # no sums over generators: calls that go through C have a small stack of their own
    for i, j in [(i, i) for i in range(head)] + [(len(xs) - 1 - i, len(ys) - 1 - i) for i in range(tail)]:
        total += matching(xs[i], ys[j], found)
    xs, ys, kx, ky = xs[head : len(xs) - tail], ys[head : len(ys) - tail], kx[head : len(kx) - tail], ky[head : len(ky) - tail]
    told = [[k if _has_text(c) else None for k, c in zip(ks, n, strict=True)] for ks, n in ((kx, xs), (ky, ys))]
    i = j = 0
    for x, y in [*_anchors(*told), (len(xs), len(ys))]:
        total += _between(xs[i:x], ys[j:y], found)
        if x < len(xs):
            total += matching(xs[x], ys[y], found)
        i, j = x + 1, y + 1
    return total


def _between(xs: list, ys: list, found: list | None) -> int:
    """Children without equal texts: those of one form at both ends as they stand, the rest by the table."""
    # from the tails first: what follows the varying part of a page is the template's more often than what precedes it
    tail, head = _ends(xs[::-1], ys[::-1], *([_shape(c)[1] for c in n[::-1]] for n in (xs, ys)))
    total = 0
    for i in [*range(head), *range(-tail, 0)]:
        total += matching(xs[i], ys[i], found)
    xs, ys = xs[head : len(xs) - tail], ys[head : len(ys) - tail]
    if not xs or not ys:
        return total
    width = len(ys) + 1
    best = [[0] * width for _ in range(len(xs) + 1)]
    size = [[0] * width for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs, 1):
        for j, y in enumerate(ys, 1):
            w = size[i][j] = matching(x, y)
            best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w)
    if found is not None:
        i, j = len(xs), len(ys)
        while i and j:
            if size[i][j] and best[i][j] == best[i - 1][j - 1] + size[i][j]:
                matching(xs[i - 1], ys[j - 1], found)
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return total + best[len(xs)][len(ys)]


def pruned(node: Node) -> Node:
    """A copy without inline, void and raw elements, for alignment; a node's last child is its text."""
    children = [pruned(c) for c in node.children if isinstance(c, Node) and c.tag not in INLINE and c.tag not in VOID and c.tag not in RAW]
    copy = Node(node.tag, node.mark, node.boiler, children[:])
    copy.children.append(whole_text(node) if not children else own_text(node))
    return copy


def step(above: str, node: Node) -> str:
    """The path of a node: a digest of the path above, its tag and its marks, so that paths stay short at any depth."""
    return hashlib.blake2b(f"{above}/{node.tag}.{node.mark}".encode("utf-8", "replace"), digest_size=8).hexdigest()


def paths(node: Node, above: str = "", out: dict | None = None) -> dict[int, str]:
    """Path of tags and marks of every node."""
    out = {} if out is None else out
    here = out[id(node)] = step(above, node)
    for c in node.children:
        if isinstance(c, Node):
            paths(c, here, out)
    return out


def leaves(tree: Node) -> list[tuple[Node, str]]:
    """(node, path) of a pruned tree's nodes that hold text and no other block, in page order."""
    where, out = paths(tree), []

    def walk(n: Node) -> None:
        if len(n.children) == 1 and n.children[0]:
            out.append((n, where[id(n)]))
        for c in n.children[:-1]:
            walk(c)

    walk(tree)
    return out


def layout(tree: Node) -> int:
    """A hash of the containers and marked elements right below the body: pages of one layout have it in common."""
    body = next((c for h in (tree, *tree.children[:-1]) if isinstance(h, Node) for c in h.children[:-1] if c.tag == "body"), tree)
    kinds = sorted({f"{c.tag}.{c.mark}" for c in body.children[:-1] if c.mark or c.tag in CONTAINERS})
    return int.from_bytes(hashlib.blake2b("\n".join(kinds).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True) or 1


def agreeing(base: Node, number: dict[int, int], other: Node) -> tuple[list[int], list[int]]:
    """Places of the base's leaves that another page has, and of those whose text is the same there."""
    found: list = []
    matching(base, other, found)
    met = [(number[id(a)], a.children[-1] == b.children[-1] and len(b.children) == 1) for a, b in found if id(a) in number]
    return [k for k, _ in met], [k for k, same in met if same]


def constant(met: int, same: int, pages: int) -> bool:
    """Is a leaf of the base, met on so many other pages of its group, the template's? (Also takes columns.)"""
    return (same == met) & (met + 1 >= FEWEST) & (2 * (met + 1) >= pages)


def induce(pages: list[str]) -> list[str]:
    """The wrapper of pages of one layout: `path TAB text` of leaves that are the same on all pages that have them."""
    trees = [pruned(parse(p)) for p in dict.fromkeys(pages)]
    if len(trees) < FEWEST:
        return []
    held = leaves(trees[0])
    number = {id(n): k for k, (n, _) in enumerate(held)}
    met, same = Counter(), Counter()
    for other in trees[1:]:
        a, b = agreeing(trees[0], number, other)
        met.update(a)
        same.update(b)
    return [f"{path}\t{n.children[-1]}" for k, (n, path) in enumerate(held) if constant(met[k], same[k], len(trees))]


def extract(source: str | None, wrapper: frozenset[str] | set[str] = frozenset()) -> str:
    """Main text of one page."""
    if not source:
        return ""
    root = parse(source)
    top = step("", root)
    articles = _whole(_find(root, "article", top)) or _find(root, "main", top)
    blocks: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            blocks.append(text)

    def walk(n: Node, path: str, inside: bool) -> None:
        path = step(path, n)
        if n.tag in DROPPED or (n.boiler and n.tag not in ("html", "body", "article", "main")) or (n.tag == "header" and not inside):
            return
        if wrapper and n.tag not in INLINE:
            leaf = not any(isinstance(c, Node) and c.tag not in INLINE and c.tag not in VOID and c.tag not in RAW for c in n.children)
            if f"{path}\t{whole_text(n) if leaf else own_text(n)}" in wrapper and leaf:
                return
        block = n.tag not in INLINE
        if block:
            flush()
        for c in n.children:
            if isinstance(c, str):
                held.append(c)
            else:
                walk(c, path, inside)
        if block:
            flush()

    if articles:
        for a, above in articles:
            walk(a, above, True)
    else:
        walk(root, "", False)
    return " ".join(blocks)


def _find(node: Node, tag: str, path: str) -> list[tuple[Node, str]]:
    """Outermost elements of a tag that no dropped element holds, each with the path of the element around it."""
    out = []
    for c in node.children:
        if isinstance(c, Node):
            if c.tag == tag:
                out.append((c, path))
            elif c.tag not in DROPPED and not (c.boiler and c.tag not in ("html", "body")):
                out += _find(c, tag, step(path, c))
    return out


def _linked(node: Node, inside: bool = False) -> tuple[int, int]:
    """Characters of an element's text that stand in links, and all of them."""
    linked = total = 0
    inside = inside or node.tag == "a"
    for c in node.children:
        a, b = (len(c.strip()) * inside, len(c.strip())) if isinstance(c, str) else _linked(c, inside)
        linked, total = linked + a, total + b
    return linked, total


def _whole(articles: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """Of several article elements those that are no teasers: at least half of a teaser's text is a link."""
    if len(articles) < 2:
        return articles
    said = [(x, *_linked(x[0])) for x in articles]
    return [x for x, linked, total in said if 2 * linked < total] or articles


def host_of(url):
    """Host of a url column, lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, wrapper): template nodes of each host, from all its different pages.

    Pages of one host and layout are a group; layouts of fewer than FEWEST pages are one group together. All pages of a
    group are aligned with one of them, each where it lies, and only counts of its leaves are brought together.
    """
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.xxhash64(html_col).alias("h"), F.col(html_col).alias("html")).filter(F.length("html") > 0)

    def framed(batches):
        for batch in batches:
            kinds = [layout(pruned(parse(x))) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kinds, pa.int64())], names=["host", "h", "layout"])

    frames = materialise(rows.mapInArrow(framed, "host string, h long, layout long").distinct(), "frames")
    kinds = frames.groupBy("host", "layout").agg(F.count("*").alias("n"), F.min("h").alias("h"))
    kinds = kinds.withColumn("layout", F.when(F.col("n") >= FEWEST, F.col("layout")).otherwise(0))
    groups = materialise(kinds.groupBy("host", "layout").agg(F.sum("n").alias("n"), F.min("h").alias("h")).filter(F.col("n") >= FEWEST), "groups")
    base = groups.select(F.col("host").alias("base_host"), F.col("h").alias("base_h"))
    bases = rows.join(base.distinct(), (F.col("host") == F.col("base_host")) & (F.col("h") == F.col("base_h")), "left_semi").groupBy("host", "h").agg(F.min("html").alias("html"))
    bases = materialise(groups.join(bases, ["host", "h"]), "bases")
    size = bases.agg(F.sum(F.length("html"))).first()[0] or 0

    def aligned(batches, known=None):
        trees: dict = {}
        for batch in batches:
            hosts, hashes, sources = (batch.column(k).to_pylist() for k in range(3))
            given = batch.column(3).to_pylist() if known is None else None
            out = []
            for k, (host, h, source) in enumerate(zip(hosts, hashes, sources, strict=True)):
                mine = known.value.get(host) if known is not None else {x["layout"]: (x["h"], x["html"]) for x in given[k] or ()}
                if not mine:
                    continue
                tree = pruned(parse(source))
                kind = layout(tree)
                kind = kind if kind in mine else 0
                if kind not in mine or mine[kind][0] == h:
                    continue
                if (host, kind) not in trees:
                    if len(trees) >= 256:
                        trees.clear()
                    first = pruned(parse(mine[kind][1]))
                    trees[host, kind] = first, {id(n): i for i, (n, _) in enumerate(leaves(first))}
                out.append((host, kind, h, *agreeing(*trees[host, kind], tree)))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["host", "layout", "h", "met", "same"])

    types = "host string, layout long, h long, met array<int>, same array<int>"
    if size <= 8 << 20:
        sent: dict = {}
        for r in bases.collect():
            sent.setdefault(r.host, {})[r.layout] = (r.h, r.html)
        sent = pages.sparkSession.sparkContext.broadcast(sent)
        compared = rows.mapInArrow(lambda it: aligned(it, sent), types)
    else:
        lists = bases.groupBy(F.col("host").alias("base_host")).agg(F.collect_list(F.struct("layout", "h", "html")).alias("bases"))
        compared = rows.join(lists, F.col("host") == F.col("base_host")).select("host", "h", "html", "bases").mapInArrow(aligned, types)
    compared = materialise(compared.dropDuplicates(["host", "layout", "h"]), "compared")
    met = compared.select("host", "layout", F.explode("met").alias("leaf"), "same")
    counts = met.groupBy("host", "layout", "leaf").agg(F.count("*").alias("met"), F.count_if(F.array_contains("same", F.col("leaf"))).alias("same"))
    kept = counts.join(groups.select("host", "layout", "n"), ["host", "layout"]).filter(constant(F.col("met"), F.col("same"), F.col("n")))
    chosen = bases.join(kept.groupBy("host", "layout").agg(F.collect_list("leaf").alias("leaf")), ["host", "layout"]).select("host", "html", "leaf")

    def named(batches):
        for batch in batches:
            out = []
            for source, places in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held = leaves(pruned(parse(source)))
                out.append([f"{held[k][1]}\t{held[k][0].children[-1]}" for k in places])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["host", "wrapper"])

    return chosen.mapInArrow(named, "host string, wrapper array<string>").groupBy("host").agg(F.array_distinct(F.flatten(F.collect_list("wrapper"))).alias("wrapper"))


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    spark = pages.sparkSession
    bounded_batches(spark, 128)
    found = materialise(wrappers(pages, url_col=url_col, html_col=html_col), "wrappers")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    size = found.agg(F.count("*"), F.sum(F.aggregate("wrapper", F.lit(0).cast("long"), lambda s, x: s + F.length(x)))).first()
    types = f"page_id {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars long"

    def texts(batches, known=None):
        sets: dict[str, frozenset] = {}
        for batch in batches:
            hosts, sources = batch.column(3).to_pylist(), batch.column(2).to_pylist()
            given = batch.column(4).to_pylist() if known is None else None
            out = []
            for k, (h, s) in enumerate(zip(hosts, sources, strict=True)):
                if known is None and h not in sets:
                    sets = {h: frozenset(given[k] or ())}
                out.append(extract(s, (known.value if known is not None else sets).get(h, frozenset())))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if (size[1] or 0) <= 8 << 20:
        # all wrappers together are small: they are sent along, and pages stay where they are
        sent = spark.sparkContext.broadcast({r.host: frozenset(r.wrapper) for r in found.collect()})
        return rows.mapInArrow(lambda it: texts(it, sent), types)
    met = rows.join(found.withColumnRenamed("host", "known_host"), F.col("host") == F.col("known_host"), "left").select("page_id", "url", "html", "host", "wrapper")
    return met.mapInArrow(texts, types)

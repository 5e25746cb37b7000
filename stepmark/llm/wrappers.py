"""HTML extraction by wrapper induction: same-host pages are aligned by simple tree matching.

Nodes that stay constant over the pages of a host are its template; slots that vary are content.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepmark.llm.common import pick, through_table

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"""
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>"']++|"[^"]*"|'[^']*')*+|[^>]*)>""",
    re.S,
)
CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
WORDS = re.compile(r"[A-Za-z]+")

# Fixed sets of HTML: elements without content, raw text, inline elements, and implied ends.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

#: Elements and names (in class, id or role) that never hold the article.
NOT_TEXT = frozenset(
    "head script style noscript template nav footer aside button select textarea iframe object svg canvas menu dialog title".split()
)
NOT_NAMES = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer contentinfo sidebar aside complementary ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal "
    "newsletter subscribe subscription comment comments disqus respond share sharing social related recommended login search "
    "toolbar alert".split()
)
#: Words that do not change what a joined name such as site-nav or comment-list stands for.
LAYOUT = frozenset(
    "site page main top bottom left right primary secondary list item items bar box block body wrapper wrap container inner outer area "
    "section widget banner links posts articles form".split()
)
#: These only count outside of an article, which may have a heading of its own.
PAGE_NAMES = frozenset("header masthead banner".split())
ROOTS = frozenset("html body main".split())

#: A slot is template if its text is the same on this share of at least so many further, differing pages.
OUTSIDE, INSIDE = (0.9, 5), (0.95, 20)
ORDINALS = 16
#: Depth of the element paths by which the pages of a host are grouped.
FRAME = 4


@dataclass
class Node:
    tag: str
    place: int
    article: bool = False
    dropped: bool = False
    doubtful: bool = False  # a form or a name says that it is no article
    children: list[Node] = field(default_factory=list)
    parent: Node | None = field(default=None, repr=False, compare=False)
    names: str = ""  # its class, without digits
    blocks: int = 0
    shape: int = 0


@dataclass
class Page:
    root: Node
    blocks: list[tuple[Node, int, str]]  # node, its how-many-th block, text
    articles: bool


def _drops(tag: str, rest: str, parent: Node) -> bool:
    """Whether the element never holds the article or is hidden."""
    if tag in NOT_TEXT or (tag == "header" and not parent.article):
        return True
    return tag not in ROOTS and _hidden(rest)


def _hidden(rest: str) -> bool:
    """Whether there is an attribute `hidden`, or a style that shows nothing; not the word in a value."""
    lower = rest.lower()
    if "hidden" not in lower and "display" not in lower:
        return False
    return any(
        found[0].lower() == "hidden" or (found[0].lower() == "style" and NOT_SHOWN.search("".join(found[1:])))
        for found in ATTRIBUTE.findall(rest)
    )


def _named(tag: str, rest: str, parent: Node) -> bool:
    """Whether a form, or a whole name in class, id or role, stands for something other than the article."""
    if tag == "form":
        return True
    if tag in ROOTS or "=" not in rest:
        return False
    for found in NAMES.findall(rest):
        for name in "".join(found).split():
            words = [w.lower() for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", name))]
            known = [w in NOT_NAMES or (w in PAGE_NAMES and not parent.article) for w in words]
            if any(known) and all(k or w in LAYOUT for k, w in zip(known, words, strict=True)):
                return True
    return False


def _settle(page: Page) -> None:
    """Drop the doubtful parts of a page, except those that hold its article.

    A form stays if it holds an article or main, or most of the page's text; a named part only
    if no article or main lies outside of all of these.
    """
    order, todo = [], [page.root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(node.children)
    size, holds = dict.fromkeys((n.place for n in order), 0), dict.fromkeys((n.place for n in order), False)
    for node, _, text in page.blocks:
        size[node.place] += len(text)
    for node in reversed(order):  # children before parents
        holds[node.place] |= not node.dropped and not node.doubtful and node.tag in ("article", "main")
        if node.parent is not None:
            size[node.parent.place] += size[node.place]
            holds[node.parent.place] |= holds[node.place] and not node.doubtful
    apart = holds[page.root.place]
    for node in order:  # parents before children
        if node.parent is not None and node.parent.dropped:
            node.dropped = True
        elif node.doubtful and (node.tag == "form" or not apart):
            node.dropped |= not (holds[node.place] or 2 * size[node.place] > size[page.root.place])
        elif node.doubtful:
            node.dropped = True
    page.blocks = [b for b in page.blocks if not b[0].dropped]
    page.articles = any(n.article and not n.dropped for n in order)


def parse(source: str) -> Page:
    """Block elements as a tree, and the text blocks in page order, without dropped parts."""
    root = Node("#page", 0)
    stack: list[tuple[str, Node]] = [(root.tag, root)]  # open elements; inline ones share the node around them
    open_: dict[str, int] = {}
    blocks: list[tuple[Node, int, str]] = []
    parts: list[str] = []
    nodes, at, hide = 1, 0, 0  # hide: open inline elements that are dropped

    def flush() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if text:
                node = stack[-1][1]
                blocks.append((node, node.blocks, text))
                node.blocks += 1

    def pop_to(depth: int) -> None:
        nonlocal hide
        if any(name not in INLINE for name, _ in stack[depth:]):
            flush()
        for name, _ in stack[depth:]:
            open_[name.removeprefix("!")] -= 1
            hide -= name[0] == "!"
        del stack[depth:]

    def nearest(names: set[str], until: set[str]) -> int:
        for depth in range(len(stack) - 1, 0, -1):
            name = stack[depth][0]
            if name in names:
                return depth
            if name in until:
                break
        return 0

    for m in TAG.finditer(source):
        if m.start() < at:
            continue
        if m.start() > at and not hide and not stack[-1][1].dropped:
            parts.append(source[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m[0].startswith("<![CDATA[") and not hide and not stack[-1][1].dropped:
                parts.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name = name.lower()
        if m["close"]:
            if open_.get(name):
                depth = next(d for d in range(len(stack) - 1, 0, -1) if stack[d][0].removeprefix("!") == name)
                pop_to(depth)
            continue
        rest = m["rest"]
        if name in ("br", "wbr", "img"):
            parts.append(" " if name == "br" else "")
            continue
        parent = stack[-1][1]
        if name in INLINE:
            dropped = _drops(name, rest, parent) or _named(name, rest, parent)
            hide += dropped
            stack.append(("!" + name if dropped else name, parent))
            open_[name] = open_.get(name, 0) + 1
            continue
        if open_.get("p"):
            depth = nearest({"p"}, {"table", "td", "th", "button", "object"})
            if depth:
                pop_to(depth)
        if name in ENDS and open_:
            depth = nearest(*ENDS[name])
            if depth:
                depth = next(d for d in range(1, depth + 1) if all(stack[k][0] in ENDS[name][0] or stack[k][0] in INLINE for k in range(d, depth + 1)))
                pop_to(depth)
        flush()
        parent = stack[-1][1]
        doubtful = _named(name, rest, parent)
        article = parent.article or (name in ("article", "main") and not doubtful)
        node = Node(name, nodes, article, parent.dropped or hide > 0 or _drops(name, rest, parent), doubtful)
        nodes += 1
        node.parent = parent
        if "=" in rest and (found := CLASS.search(rest)):
            node.names = re.sub(r"[0-9]+", "", "".join(x or "" for x in found.groups()))
        parent.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not rest.endswith("/"):
            stack.append((name, node))
            open_[name] = open_.get(name, 0) + 1
    if at < len(source) and not hide and not stack[-1][1].dropped:
        parts.append(source[at:])
    pop_to(1)
    flush()
    _shapes(root)
    page = Page(root, blocks, False)
    _settle(page)
    return page


_SHAPES: dict[tuple, int] = {}


def _shapes(root: Node) -> None:
    """Number each subtree by its structure, children before parents."""
    if len(_SHAPES) > 1_000_000:
        _SHAPES.clear()
        _reference.cache_clear()
        _SCORES.clear()
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(node.children)
    for node in reversed(order):
        key = (node.tag, *[c.shape for c in node.children])
        node.shape = _SHAPES.setdefault(key, len(_SHAPES))


_SCORES: dict[tuple[int, int], int] = {}


def _table(left: list[Node], right: list[Node]) -> list[list[int]]:
    """Best matched sizes of the first i and j children, in order."""
    rows = [[0] * (len(right) + 1)]
    for a in left:
        last, row = rows[-1], [0]
        for j, b in enumerate(right):
            row.append(max(last[j + 1], row[j], last[j] + matched(a, b)))
        rows.append(row)
    return rows


def matched(a: Node, b: Node) -> int:
    """Simple tree matching: the most node pairs of two trees, parents and order kept."""
    if a.tag != b.tag:
        return 0
    key = (a.shape, b.shape)
    found = _SCORES.get(key)
    if found is None:
        if len(_SCORES) > 1_000_000:
            _SCORES.clear()
        pairs, left, right = _equal_ends(a.children, b.children)
        found = 1 + sum(matched(x, y) for x, y in pairs) + (_table(left, right)[-1][-1] if left and right else 0)
        _SCORES[key] = found
    return found


def _equal_ends(left: list[Node], right: list[Node]) -> tuple[list[tuple[Node, Node]], list[Node], list[Node]]:
    """Children that match at both ends with the same structure; no alignment does better there."""
    n, a, b = min(len(left), len(right)), 0, 0
    while a < n and left[a].shape == right[a].shape:
        a += 1
    while b < n - a and left[-1 - b].shape == right[-1 - b].shape:
        b += 1
    pairs = list(zip(left[:a], right[:a], strict=True)) + list(zip(left[len(left) - b :], right[len(right) - b :], strict=True))
    return pairs, left[a : len(left) - b], right[a : len(right) - b]


def align(page: Node, wrapper: Node) -> dict[int, int]:
    """Place in the wrapper of each matched node of the page."""
    out, todo = {}, [(page, wrapper)]
    while todo:
        a, b = todo.pop()
        out[a.place] = b.place
        pairs, left, right = _equal_ends(a.children, b.children)
        todo.extend(pairs)
        if left and right:
            rows = _table(left, right)
            i, j = len(left), len(right)
            while i and j:
                if rows[i][j] == rows[i - 1][j]:
                    i -= 1
                elif rows[i][j] == rows[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    todo.append((left[i], right[j]))
    return out


@lru_cache(maxsize=256)
def _reference(source: str) -> Page:
    return parse(source)


def frame(source: str) -> int:
    """Number of the page's structure near the root: its distinct element paths; 0 without text."""
    page = parse(source)
    if not page.blocks:
        return 0
    paths, todo = set(), [(page.root, "", 0)]
    while todo:
        node, path, depth = todo.pop()
        paths.add(path)
        if depth < FRAME:
            todo.extend((c, f"{path}/{c.tag}", depth + 1) for c in node.children)
    return 1 + _number("\n".join(sorted(paths)))


def _number(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode("utf-8", "surrogatepass"), digest_size=7).digest(), "big")


def _slot(node: Node, nth: int, places: dict[int, int]) -> int:
    """Place in the wrapper, or else (below 0) the path from the nearest node that has one."""
    nth, path = min(nth, ORDINALS - 1), []
    while node.place not in places:
        path.append(f"{node.tag}.{node.names}")
        node = node.parent
    place = places[node.place] * ORDINALS + nth
    return -1 - _number(f"{place} {'/'.join(path)}") if path else place


def slots(source: str, reference: str) -> list[tuple[str, int, bool]]:
    """(text, slot, in the article) of each block of the page's region.

    The region is the article where the page marks one, else all that is not dropped.
    """
    page = parse(source)
    places = align(page.root, _reference(reference).root)
    return [(text, _slot(node, nth, places), node.article) for node, nth, text in page.blocks if node.article or not page.articles]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by a line feed; empty if none).

    Left out are the parts that their element, or a whole name in class, id or role, says are no
    article (unless they hold the article or, on a page without one, most of its text), everything
    outside the article where a page marks one, and the template of the host. A host's wrapper is
    a page with text of its most common structure near the root; each page is matched against it
    alone. What the wrapper lacks gets a slot by its path from the nearest matched node, so
    optional blocks and other layouts vote too. Only counts per slot and text are summed, so a
    host of any size is spread over all tasks. A text is template where it fills its slot on 90 %
    of at least 5 further pages (95 % of 20 inside a marked article). Pages that agree in all
    blocks have one vote: copies make no template.

    NULL or empty html gives an empty text, a NULL or odd url the host ''; repeated rows give
    repeated rows; an empty table gives none. Whole pages are read.
    """
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    rows = pick(pages, page_id=page_id, url=url, html=source).withColumn("host", host).withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("h", F.xxhash64("url", "html"))

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"host": batch["host"], "h": batch["h"], "frame": [frame(page) for page in batch["html"]]})

    frames = rows.select("host", "h", "html").mapInPandas(look, "host string, h bigint, frame bigint").where("frame > 0")
    frames = frames.groupBy("host", "frame").agg(F.count("*").alias("n"), F.min("h").alias("h"))
    chosen = frames.groupBy("host").agg(F.max_by("h", F.struct("n", "h")).alias("h"))
    wrappers = through_table(rows.join(chosen, ["host", "h"]).groupBy("host").agg(F.min("html").alias("wrapper")), "wrappers")

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [slots(page, wrapper) for page, wrapper in zip(batch["html"], batch["wrapper"], strict=True)]
            blocks = [[{"text": t, "slot": s, "article": a} for t, s, a in page] for page in found]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "host": batch["host"], "blocks": blocks})

    kind = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, host string, blocks array<struct<text:string,slot:bigint,article:boolean>>"
    matched_rows = rows.join(wrappers, "host", "left").withColumn("wrapper", F.coalesce("wrapper", F.lit(""))).drop("h")
    found = through_table(matched_rows.mapInPandas(match, schema), "blocks")
    filled = lambda b: F.struct(b["slot"].alias("slot"), b["article"].alias("article"), F.xxhash64(b["slot"], b["text"]).alias("filled"))
    voters = found.groupBy("host", F.xxhash64("blocks").alias("page")).agg(F.first(F.transform("blocks", filled)).alias("blocks"))
    votes = voters.select("host", F.explode("blocks").alias("b")).groupBy("host", "b.slot", "b.article", "b.filled").agg(F.count("*").alias("same"))
    votes = votes.groupBy("host", "slot", "article").agg(F.sum("same").alias("n"), F.max_by("filled", F.struct("same", "filled")).alias("filled"), F.max("same").alias("same"))
    enough = lambda rule: (F.col("n") > rule[1]) & (F.col("same") - 1 >= rule[0] * (F.col("n") - 1))
    template = votes.where(F.when(F.col("article"), enough(INSIDE)).otherwise(enough(OUTSIDE)))
    template = through_table(template.groupBy("host").agg(F.collect_set("filled").alias("template")), "template")
    content = F.filter("blocks", lambda b: ~F.coalesce(F.array_contains("template", F.xxhash64(b["slot"], b["text"])), F.lit(False)))
    joined = found.join(template, "host", "left")
    return joined.select("page_id", "url", F.array_join(F.transform(content, lambda b: b["text"]), "\n").alias("text"))

"""Main text of web pages by tree scoring.

A page is read into a tree. Parts that are no article by their element, role or class
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, reader comments) are
cut off. Each paragraph passes points, for its length and its commas, to its ancestors, in
full to the parent and less with every level; an element's points are discounted by the
share of its text that is links. The best container is the article. Siblings that score
near it, and the headings and plain paragraphs beside it, belong to it too.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import slices, text_of

# Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes svg".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
DROPPED = set(
    "head nav header footer aside form menu dialog button select option label input object "
    "embed canvas audio video map".split()
)
DROPPED_ROLES = set(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form status tablist".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: An open element of the first kind ends when one of the second begins beside it.
ENDS = {
    "p": BLOCK,
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "thead", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "thead", "tfoot"},
    "head": {"body"},
}
#: What these hold is closed off from the end tags and implied ends outside of them.
SCOPES = {"table", "td", "th", "ul", "ol", "dl", "body", "html"}
#: Words of class names and identifiers of parts that are no article.
NOT_ARTICLE = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo "
    "promotion banner sidebar sidebars side aside rail widget widgets cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup "
    "login menu menus nav navbar navigation breadcrumb breadcrumbs footer foot header masthead "
    "toolbar share sharing social related recommended recommendations pagination pager tags "
    "comment comments commentlist disqus respond replies reply discussion form search skip "
    "toc hidden outbrain taboola".split()
)
#: Of these words some are never the name of what holds an article.
ALWAYS = set(
    "ad ads advert adverts advertisement cookie comment comments commentlist disqus respond "
    "replies reply discussion popup modal".split()
)
ARTICLE = set("article articles main content story post entry body text page blog".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_EDGE = re.compile("[>\"']")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_COMMA = re.compile("[,，、،;]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


REACH = 200
"""Levels that a paragraph's points pass up; what would come after that is next to nothing."""


class Node:
    __slots__ = ("tag", "attrs", "parent", "parts", "points", "size", "linked", "level")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.parts: list = []  # texts and nodes in order
        self.points = 0.0
        self.size = self.linked = 0  # characters inside, and inside links
        self.level = 0 if parent is None else parent.level + 1


class _Tags:
    """Finds where tags end, in time that grows with the page.

    A tag ends at the first ``>`` outside of quotes. A scan that meets a quote that never closes, or
    no ``>``, finds none; the quotes it passed are remembered, as a later scan that comes upon
    one of them would end alike.
    """

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.vain: set[int] = set()
        self.name_end = 0

    def after_name(self, at: int) -> int:
        """Where the name ends of a tag that begins here, -1 if none does.

        Names that end at the same place are measured once.
        """
        if at >= self.name_end:
            found = _NAME.match(self.page, at)
            if found is None:
                return -1
            self.name_end = found.end()
        elif not (self.page[at].isascii() and self.page[at].isalpha()):
            return -1
        return self.name_end

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin here; -1 without one."""
        passed = []
        while at <= self.last:
            edge = _EDGE.search(self.page, at).start()
            if self.page[edge] == ">":
                return edge
            close = -1 if edge in self.vain else self.page.find(self.page[edge], edge + 1)
            passed.append(edge)
            if close < 0:
                break
            at = close + 1
        self.vain.update(passed)
        return -1


class _Tree:
    """The tree of a page while it is read; knows what is open without walking through it."""

    def __init__(self):
        self.root = self.node = Node("html", "", None)
        self.open: Counter[str] = Counter()
        self.scoped: list[Counter[str]] = [Counter()]  # open since each scope began
        self.frames: list[list[Node]] = [[]]  # open since each barrier that may end by itself

    def push(self, node: Node) -> None:
        tag = node.tag
        self.node = node
        self.open[tag] += 1
        self.scoped[-1][tag] += 1
        if tag in SCOPES:
            self.scoped.append(Counter())
        if _is_barrier(tag):
            self.frames.append([])
        if tag in ENDS:
            self.frames[-1].append(node)

    def pop_to(self, node: Node) -> None:
        """Close all that is open inside ``node``, and itself."""
        while True:
            last = self.node
            if last.tag in ENDS:
                self.frames[-1].pop()
            if _is_barrier(last.tag):
                self.frames.pop()
            if last.tag in SCOPES:
                self.scoped.pop()
            self.scoped[-1][last.tag] -= 1
            self.open[last.tag] -= 1
            self.node = last.parent
            if last is node:
                return

    def close(self, tag: str) -> None:
        """An end tag; one that matches nothing open, or nothing in its scope, is ignored."""
        if tag in ("html", "body"):
            return
        if not (self.open[tag] if tag in BLOCK else self.scoped[-1][tag]):
            return
        at = self.node
        while at.tag != tag:
            at = at.parent
        self.pop_to(at)

    def imply_ends(self, tag: str) -> None:
        """A new element ends those open beside it that it cannot be inside of."""
        if tag not in _ENDERS:
            return
        while True:
            ended = next((n for n in reversed(self.frames[-1]) if tag in ENDS[n.tag]), None)
            if ended is None:
                return
            self.pop_to(ended)
            if ended.tag == "p":
                return


_ENDERS = set().union(*ENDS.values())


def _is_barrier(tag: str) -> bool:
    """Does an element keep a new one inside from ending those around it?"""
    return tag in SCOPES or (tag in BLOCK and tag != "p" and tag not in ENDS)


def parse(page: str) -> Node:
    """The tree of a page. Any input gives a tree; what is not closed ends with its parent."""
    tree, tags = _Tree(), _Tags(page)
    text = at = 0
    while True:
        start = page.find("<", at)
        if start < 0 or start + 1 == len(page):
            break
        after, given, close = _markup(page, start, tags)
        if after < 0:  # no markup: the character is text
            at = start + 1
            continue
        if start > text:
            tree.node.parts.append(html.unescape(page[text:start]))
        text = at = after
        if close is None:
            if given:
                tree.node.parts.append(given)
            continue
        tag, attrs = given
        if close:
            tree.close(tag)
        elif tag in RAW:
            end = _raw_end(tag).search(page, at)
            text = at = end.end() if end else len(page)
        elif tag != "html":
            tree.imply_ends(tag)
            child = Node(tag, attrs, tree.node)
            tree.node.parts.append(child)
            if tag not in VOID and not attrs.endswith("/"):
                tree.push(child)
    if text < len(page):
        tree.node.parts.append(html.unescape(page[text:]))
    return tree.root


def _markup(page: str, start: int, tags: _Tags) -> tuple[int, object, bool | None]:
    """What the ``<`` here begins: where it ends (-1 if it is text), and what it is.

    For a tag, its lower-case name and attributes, and whether it is an end tag; for character
    data their text, and for comments and declarations nothing, each with None.
    """
    size, second = len(page), page[start + 1]
    if second in "!?":
        for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>"), (page[start:start + 2], ">")):
            if page.startswith(opening, start):
                inside = start + len(opening)
                stop = page.find(closing, inside)
                after = size if stop < 0 else stop + len(closing)
                given = page[inside : size if stop < 0 else stop] if closing == "]]>" else None
                return after, given, None
    at = start + 2 if second == "/" else start + 1
    named = tags.after_name(at)
    end = -1 if named < 0 else tags.end(named)
    if end < 0:
        return -1, None, None
    return end + 1, (page[at:named].lower(), page[named:end]), second == "/"


@cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\s*>", re.IGNORECASE)


def _attributes(raw: str) -> dict[str, str]:
    return {
        m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)
    }


def _name_parts(attrs: dict[str, str]) -> list[list[str]]:
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".split()
    return [[p.lower() for p in _NAME_PART.findall(name)] for name in names]


def is_dropped(node: Node, share: float) -> bool:
    """Is this part no article? ``share`` is the part of the page's text that it holds.

    A part with most of the text is spared if only its name speaks against it, as frames
    are named after all they hold, except for names that never frame an article.
    """
    if node.tag in DROPPED:
        return True
    if not node.attrs:
        return False
    attrs = _attributes(node.attrs)
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if attrs.get("role", "").lower() in DROPPED_ROLES or _HIDDEN.search(attrs.get("style", "")):
        return True
    if node.tag in ("body", "main", "html"):
        return False
    for parts in _name_parts(attrs):
        bad = [p for p in parts if p in NOT_ARTICLE]
        if bad and (share < 0.5 or bad[-1] in ALWAYS) and parts[-1] not in ARTICLE:
            return True
    return False


def _walk(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(p for p in reversed(node.parts) if not isinstance(p, str))
    return out


def _measure(root: Node) -> list[Node]:
    nodes = _walk(root)
    for node in reversed(nodes):
        node.size = node.linked = 0
        for part in node.parts:
            if isinstance(part, str):
                node.size += len(" ".join(part.split()))
            else:
                node.size += part.size
                node.linked += part.linked
        if node.tag == "a":
            node.linked = node.size
    return nodes


def _prune(root: Node) -> None:
    _measure(root)
    total = max(1, root.size)
    todo = [root]
    while todo:
        node = todo.pop()
        node.parts = [
            p for p in node.parts if isinstance(p, str) or not is_dropped(p, p.size / total)
        ]
        todo.extend(p for p in node.parts if not isinstance(p, str))


def _is_paragraph(node: Node) -> bool:
    """Holds text of its own, and no block."""
    if node.tag not in BLOCK or node.tag in HEADINGS or node.size == 0:
        return False
    return not any(not isinstance(p, str) and p.tag in BLOCK for p in node.parts)


def _own_text(node: Node) -> str:
    return " ".join("".join(_texts([node])).split())


def _score(nodes: list[Node]) -> None:
    for node in nodes:
        loose = "".join(p for p in node.parts if isinstance(p, str)).strip()
        if _is_paragraph(node):
            text, up = _own_text(node), node.parent or node
        elif loose and node.tag in BLOCK and node.tag not in HEADINGS and node.tag != "html":
            text, up = " ".join(loose.split()), node  # text beside blocks
        else:
            continue
        points = 1.0 + len(_COMMA.findall(text)) + min(len(text) / 100, 3.0)
        if len(text) < 25:
            points = 0.1
        share, steps = 1.0, 0
        while up is not None and steps < REACH:
            up.points += points * share
            steps += 1
            share = 0.5 if steps == 1 else 1 / (3 * steps)
            up = up.parent


def _final(node: Node) -> float:
    bonus = 1.25 if node.tag in ("article", "main") else 1.0
    return node.points * bonus * (1 - node.linked / max(1, node.size))


def _select(root: Node) -> list[Node]:
    """The best container, or the article it is part of, and the siblings that belong to it."""
    nodes = _measure(root)
    _score(nodes)
    scored = [n for n in nodes if n.points > 0 and n.tag != "a"]
    if not scored:
        return [root]
    best = max(scored, key=lambda n: (_final(n), -n.level))
    up = best
    while up is not None:
        if up.tag == "article":
            best = up
        up = up.parent
    if best.parent is None:
        return [best]
    floor = 0.2 * _final(best)
    kept = []
    for part in best.parent.parts:
        if part is best:
            kept.append(part)
        elif isinstance(part, str) or not part.size:
            continue
        elif part.linked * 4 < part.size:
            near = _final(part) >= max(floor, 0.01) and part.tag != "html"
            if near or part.tag in HEADINGS or part.tag == "p":
                kept.append(part)
    return kept


def _texts(nodes: list[Node]) -> Iterator[str]:
    """Texts in page order; a newline character stands for the border of a block."""
    todo: list = list(reversed(nodes))
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            yield part
        elif part.tag == "br":
            yield " "
        elif part.tag in BLOCK:
            yield _BORDER
            todo.append(_BORDER)
            todo.extend(reversed(part.parts))
        else:
            todo.extend(reversed(part.parts))


_BORDER = " "
"""Blocks are joined by one space in the end, as are words, so a space is border enough."""


def main_text(page: str | None) -> str:
    """The article of a page as blocks joined by one space; empty for an empty page."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    return " ".join("".join(_texts(_select(root))).split())


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    One row per input row, repeated or not; null html gives an empty text. Other columns
    are ignored. A page is read whole, however long or malformed, in time that grows with its
    length; a very long one is worked on alone.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("text", pa.string()),
            ("n_chars", pa.int64()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["page_id"].cast(pa.int64()),
                    batch["url"].cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                schema=schema,
            )

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_of("html").alias("html"),
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

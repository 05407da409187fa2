"""Main text of web pages by a maximum-scoring run of tokens.

A page is a sequence of words and tags. Words score positive and tags negative, by weights that
are learned from the pages that label themselves (those with exactly one ``article`` or ``main``
element): the log odds, within and outside of the labelled element, of a word by the kind of
element around it, and of a tag by its kind. A linear scan finds the run of tokens with the
greatest sum. Words inside it whose surroundings score negative (menus, notices, forms) are left out.

Kinds are few: an element's name, or a role that its name, class, id or role attribute tells.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import texts

# Element names and words of class, id and role attributes that tell a role.
BOILERPLATE = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs"),
    "header": ("header", "masthead", "banner"),
    "footer": ("footer", "copyright", "contentinfo"),
    "aside": ("aside", "sidebar", "related", "complementary", "widget"),
    "notice": ("notice", "cookie", "cookies", "consent", "popup", "modal", "newsletter", "subscribe"),
    "ad": ("ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo"),
    "form": ("form", "search", "login", "signup"),
    "comments": ("comment", "comments", "discussion", "replies", "respond"),
    "share": ("share", "social", "sharing"),
}
ROLE_OF = {word: role for role, words in BOILERPLATE.items() for word in words}
MAIN = ("article", "main")
#: Elements whose content is no text of the page.
HIDDEN = ("script", "style", "noscript", "template", "head", "title", "svg", "iframe", "select", "button", "textarea", "object")
INLINE = (
    "a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label",
    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
)
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
)
#: Opening one of these ends an open paragraph.
ENDS_P = (
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
    "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul",
)
BLOCK_KINDS = ("p", "h", "li", "td", "pre", "blockquote", "div", "section", "figure", "body", "other")
_NAMES = {f"h{n}": "h" for n in range(1, 7)} | {"dt": "li", "dd": "li", "th": "td", "html": "body", "figcaption": "figure"}

_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[\s_-]+")
_SPACE = re.compile(r"\s+")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")}


def _role(name: str, attributes: str) -> str | None:
    if name in ROLE_OF:
        return ROLE_OF[name]
    if attributes and name not in ("html", "body", *MAIN):
        for m in _ATTRIBUTE.finditer(attributes):
            for word in _SPLIT.split((m[1] or m[2] or m[3] or "").lower()):
                if word in ROLE_OF:
                    return ROLE_OF[word]
    return None


class Token:
    """A tag, or a stretch of text with its kind of surroundings and the number of its block."""

    __slots__ = ("block", "kind", "main", "text", "words")

    def __init__(self, kind: str, text: str | None, block: int, main: bool):
        self.kind, self.text, self.block, self.main = kind, text, block, main
        self.words = len(text.split()) if text else 0


class _Tags:
    """Where the tags of a page end, found in time that grows with the page alone, however broken it is."""

    def __init__(self, page: str):
        self.page = page
        self.special = [m.start() for m in _SPECIAL.finditer(page)]
        self.next = 0
        #: Opening quotes from which on no tag ends.
        self.dead: set[int] = set()
        self.last_end = page.rfind(">")

    def end(self, at: int) -> int:
        """Place of the ``>`` outside of quotes that ends a tag whose name ends at ``at``; -1 if there is none."""
        while self.next < len(self.special) and self.special[self.next] < at:
            self.next += 1
        i, opened, page = self.next, [], self.page
        while i < len(self.special):
            place = self.special[i]
            if page[place] == ">":
                return place
            close = -1 if place in self.dead else page.find(page[place], place + 1)
            opened.append(place)
            if close < 0:
                break
            i = bisect_right(self.special, close, i)
        self.dead.update(opened)
        return -1


class _Element(NamedTuple):
    """An open element and what holds inside it."""

    name: str
    role: str | None
    block: str
    main: bool
    hidden: bool
    #: Depth of the paragraph that a block element would end; 0 for none.
    paragraph: int

    @property
    def kind(self) -> str:
        """The innermost role around a place, or else its block element, apart inside the main element."""
        return self.role or ("main " if self.main else "") + self.block


_PAGE = _Element("", None, "other", False, False, 0)


def _inside(parent: _Element, name: str, attributes: str, depth: int) -> _Element:
    block = _NAMES.get(name, name)
    return _Element(
        name,
        _role(name, attributes) or parent.role,
        block if block in BLOCK_KINDS else parent.block,
        parent.main or name in MAIN,
        parent.hidden or name in HIDDEN,
        depth if name == "p" else 0 if name in ("td", "th", "button", "object") else parent.paragraph,
    )


def tokens(page: str) -> list[Token]:
    """The tags and texts of a page in order; scripts, styles, comments and hidden elements are left out.

    A closing tag closes the nearest open element of its name; unclosed ones end with their parent. A
    ``<`` that begins no whole tag is text. The time grows with the page, however deep or broken it is.
    """
    out: list[Token] = []
    stack: list[_Element] = [_PAGE]
    names: Counter = Counter()
    tags = _Tags(page)
    block, at, size = 0, 0, len(page)

    def close(depth: int) -> None:
        names.subtract(e.name for e in stack[depth:])
        del stack[depth:]

    while at < size:
        if page[at] != "<":
            end = page.find("<", at)
            end = size if end < 0 else end
            if not stack[-1].hidden:
                out.append(Token(f"word {stack[-1].kind}", html.unescape(page[at:end]), block, stack[-1].main))
            at = end
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if at + 1 < size and page[at + 1] in "!?" and at < tags.last_end:
            at = page.find(">", at) + 1
            continue
        m = _NAME.match(page, at)
        end = tags.end(m.end()) if m else -1
        if end < 0:
            if not stack[-1].hidden:
                out.append(Token(f"word {stack[-1].kind}", "<", block, stack[-1].main))
            at += 1
            continue
        name, attributes, at = m[2].lower(), page[m.end() : end], end + 1
        if m[1]:
            if name not in INLINE:
                block += 1
            if names[name]:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name))
        elif name in _RAW_END:
            found = _RAW_END[name].search(page, at, tags.last_end + 1)
            at = found.end() if found else size
            block += name not in INLINE
            continue
        else:
            if name in ENDS_P and stack[-1].paragraph:
                close(stack[-1].paragraph)
            if name not in INLINE and name != "br":
                block += 1
            if name not in VOID and not attributes.endswith("/"):
                stack.append(_inside(stack[-1], name, attributes, len(stack)))
                names[name] += 1
        out.append(Token(f"tag {stack[-1].kind if name not in VOID else 'void'}", None, block, stack[-1].main))
        if name == "br":
            out.append(Token("space", " ", block, False))
    return out


def _labels(page: str) -> Counter:
    """Tokens of each kind within and outside of the labelled element; nothing if the page has none."""
    found = tokens(page)
    opened = re.findall(r"<(article|main)\b", page, re.I)
    counts: Counter = Counter()
    if len(opened) == 1:
        for t in found:
            if t.kind != "space":
                counts[t.kind, t.main] += max(1, t.words) if t.text is not None else 1
    return counts


def learn_weights(pages: DataFrame) -> dict[str, float]:
    """Weight of each kind of token. Kinds are a fixed few, so the table of counts is small.

    The log odds are smoothed by one token on either side and held to between 0.1 and 3 for
    surroundings that are met within labelled elements more than outside, and to -3 and -0.1 for
    others. Roles and tags never score positive.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in texts(batch["html"]):
                counts.update(_labels(page))
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array([k for k, _ in counts], pa.string()),
                "main": pa.array([m for _, m in counts], pa.bool_()),
                "n": pa.array(list(counts.values()), pa.int64()),
            }
        )

    rows = pages.select("html").mapInArrow(run, "kind string, main boolean, n bigint").groupBy("kind", "main").agg(F.sum("n"))
    counts = {(k, m): n for k, m, n in rows.collect()}
    weights = {}
    for kind in {k for k, _ in counts}:
        odds = math.log((counts.get((kind, True), 0) + 1) / (counts.get((kind, False), 0) + 1))
        if kind.startswith("tag ") or kind[5:] in BOILERPLATE:
            weights[kind] = -min(max(-odds, 0.1), 3.0)
        else:
            weights[kind] = min(max(odds, 0.1), 3.0) if odds > 0 else max(min(odds, -0.1), -3.0)
    return weights


def default_weight(kind: str, weights: dict[str, float]) -> float:
    """The weight of a kind that no labelled page has: words 1, but -3 in a role, tags -0.5."""
    if kind in weights:
        return weights[kind]
    if kind.startswith("tag "):
        return -0.5
    return -3.0 if kind[5:] in BOILERPLATE else 1.0


def extract(page: str, weights: dict[str, float], labelled: bool | None = None) -> str:
    """Text of the best run: blocks in page order, joined by one space.

    If no labelled element is there, the weights learned inside one serve for the same kind outside.
    """
    found = tokens(page)
    has_main = any(t.main for t in found) if labelled is None else labelled
    scores = []
    for t in found:
        if t.kind == "space":
            scores.append(0.0)
            continue
        kind = t.kind
        if not has_main and kind.startswith("word ") and kind[5:] not in BOILERPLATE:
            kind = f"word main {kind[5:]}"
        weight = default_weight(kind, weights)
        scores.append(weight * t.words if t.text is not None else weight)
    best, start, end, total, begin = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += score
        if total > best:
            best, start, end = total, begin, i + 1
    blocks: list[tuple[int, list[str]]] = []
    for t, score in zip(found[start:end], scores[start:end], strict=True):
        if t.text is None or score < 0:
            continue
        if not blocks or blocks[-1][0] != t.block:
            blocks.append((t.block, []))
        blocks[-1][1].append(t.text)
    joined = (_SPACE.sub(" ", "".join(parts)).strip() for _, parts in blocks)
    return " ".join(x for x in joined if x)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) for each row of ``pages``.

    Null and empty pages, and pages without words, give an empty text. Repeated rows give repeated
    results; nulls in page_id and url stay. Character references are decoded. Without any labelled
    page, every kind has its default weight. Other columns are ignored; an empty table gives no
    rows. Two passes over the pages, no shuffle of them.
    """
    weights = learn_weights(pages)
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(p, weights) for p in texts(batch["html"])]
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch["page_id"],
                    "url": batch["url"],
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array([len(x) for x in found], pa.int64()),
                }
            )

    schema = f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)

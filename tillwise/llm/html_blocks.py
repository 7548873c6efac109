"""Blocks of text of a web page, and what is known about each of them.

A tolerant reader, linear in the page: tags need not be closed, a cut-off tag or comment ends the page.
A block is the text between two block-level tags. What is never text (scripts, styles, the head) is
left out here; everything else is a block with features, and the labelling decides.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

NEXT = re.compile(r"<(?=[a-zA-Z/!?])")
TAG = re.compile(r"""(/?)([a-zA-Z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+')?+|[^>=])*+)>""")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
MARKED = re.compile(r"class|id|role|hidden|itemprop|style", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# What HTML says about its elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p"
    " pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
)
#: What is in these is never text; that of the first kind has no tags either.
RAW = frozenset("script style textarea title noscript iframe".split())
SILENT = frozenset("template object svg math canvas audio video".split())
#: Elements that a starting tag closes if they are open inside the same parent.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"),
}

# Words in names by which pages mark their parts.
MAIN_TAGS = frozenset("main article".split())
MAIN_WORDS = frozenset("article post entry story main content body prose text".split())
ASIDE_TAGS = frozenset("nav aside footer form menu button select dialog fieldset".split())
ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments reply"
    " replies respond discussion disqus cookie cookies consent gdpr copyright disclaimer footer foot header masthead login"
    " signup menu menubar modal nav navbar navigation newsletter notice notices notification alert overlay pagination"
    " pager popup promo promotion recommended related search share sharing sidebar sidebars side social sponsor sponsored"
    " subscribe subscription tags toolbar topbar widget widgets form paywall".split()
)
#: An article of these is none; other words may speak of the layout around it.
NO_ARTICLE = frozenset("ad ads advert advertisement sponsored promo comment comments reply replies related recommended".split())
#: Inside an article these are its own head.
HEAD_WORDS = frozenset("header masthead banner".split())
#: Words behind these say what a page has or lacks, not what the element is.
STATE = re.compile(r"^(?:no|has|with|without|is)[-_]")

#: Where a block stands, by the elements around it.
NOWHERE, MAIN, ASIDE = range(3)


@dataclass
class Block:
    text: str
    tag: str
    place: int
    linked: int
    #: Steps in the tree from the block before.
    steps: int
    #: The last blocks before it of the same element, parent and grandparent (-1: none).
    near: tuple[int, ...]


class _Element:
    """An open element; ``block`` is the block-level one that it is or lies in."""

    __slots__ = ("name", "place", "kind", "last", "linked", "silent", "block", "up")

    def __init__(self, name: str, parent: _Element | None, place: int, kind: str):
        is_block = name in BLOCK
        self.name, self.place, self.kind, self.last = name, place, kind, -1
        self.linked = name == "a" or bool(parent and parent.linked and not is_block)
        self.silent = name in SILENT or bool(parent and parent.silent)
        self.up = parent.block if parent else None
        self.block = self if is_block else self.up


def _marks(attributes: str) -> tuple[set[str], str, bool]:
    """Words of class and id, the role, and whether the element is hidden."""
    words, role, hidden = set(), "", False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next(filter(None, values), "")
        if name in ("class", "id", "itemprop"):
            for one in value.split():
                if not STATE.match(one):
                    words.update(w.lower() for w in PARTS.findall(one))
        elif name == "role":
            role = value.strip().lower()
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style":
            hidden = hidden or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
    return words, role, hidden


def _place(parent: _Element | None, tag: str, attributes: str) -> tuple[int, str]:
    """The place inside an element, and by what it was set: a strong mark binds all below it."""
    place, kind = (parent.place, parent.kind) if parent else (NOWHERE, "")
    words, role, hidden = _marks(attributes) if attributes and MARKED.search(attributes) else (set(), "", False)
    if tag in ("html", "body"):
        words = set()
    if hidden or tag in ASIDE_TAGS or role in ASIDE_ROLES:
        return ASIDE, "strong"
    named = words & ASIDE_WORDS
    if tag == "main" or role == "main" or (tag == "article" and not words & NO_ARTICLE) or {"article", "body"} <= words - named:
        return (place, kind) if place == ASIDE and kind == "strong" else (MAIN, "strong")
    if tag == "header" or (named and place == MAIN and not named - HEAD_WORDS):
        return (place, kind) if place == MAIN else (ASIDE, "strong")
    if named:
        return ASIDE, "strong" if place == MAIN else "named"
    if place == NOWHERE and words & MAIN_WORDS:
        return MAIN, "named"
    return place, kind


def blocks_of(html: str) -> list[Block]:
    """Blocks in the order of the page; white space is one space, character references are decoded."""
    out: list[Block] = []
    stack: list[_Element] = []
    counts: dict[str, int] = {}
    pieces: list[str] = []
    linked = depth = low = 0  # depth of the last block, least depth since

    def flush() -> None:
        nonlocal linked, depth, low
        text = " ".join("".join(pieces).split())
        if text:
            holder = stack[-1].block if stack else None
            near, above = [], holder
            while above is not None and len(near) < 3:
                near.append(above.last)
                above.last = len(out)
                above = above.up
            out.append(
                Block(
                    text, holder.name if holder else "", stack[-1].place if stack else NOWHERE, min(linked, len(text)),
                    depth + len(stack) - 2 * low, tuple(near),
                )
            )
            depth = low = len(stack)
        pieces.clear()
        linked = 0

    def close(name: str) -> None:
        nonlocal low
        while counts.get(name):
            gone = stack.pop()
            counts[gone.name] -= 1
            low = min(low, len(stack))
            if gone.name == name:
                break

    def add(text: str) -> None:
        nonlocal linked
        if text and not (stack and stack[-1].silent):
            text = unescape(text) if "&" in text else text
            pieces.append(text)
            if stack and stack[-1].linked:
                linked += len(text.strip())

    at = 0
    while at < len(html):
        found = NEXT.search(html, at)
        add(html[at : found.start()] if found else html[at:])
        if not found:
            break
        start = found.end()
        if html.startswith("!--", start):
            stop = html.find("-->", start + 1)
            at = stop + 3 if stop >= 0 else len(html)
            continue
        tag = TAG.match(html, start)
        if not tag:  # a declaration, an odd end tag, or a tag that the end of the page cuts off
            stop = html.find(">", start)
            at = stop + 1 if stop >= 0 else len(html)
            continue
        at = tag.end()
        closing, name, attributes = tag.groups()
        name = name.lower()
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK or name in RAW:
            flush()
        if closing:
            close(name)
        elif name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.I).search(html, at)
            at = stop.start() if stop else len(html)
        elif name not in VOID:
            for other in (*CLOSES.get(name, ()), *(("p",) if name in BLOCK else ())):
                if stack and stack[-1].block is not None and stack[-1].block.name == other:
                    close(other)
            parent = stack[-1] if stack else None
            place, kind = _place(parent, name, attributes)
            stack.append(_Element(name, parent, place, kind))
            counts[name] = counts.get(name, 0) + 1
    flush()
    return out

"""Text blocks of a page with the marks of the elements around them. Tolerates unclosed markup."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from html import unescape

# Element and class names by their role.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Their content is no text of the page.
SILENT = frozenset("script style noscript template svg iframe object textarea select option title canvas audio video".split())
#: Elements that hold no main text.
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
MAIN = frozenset("article main".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr "
    "header legal login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promotion recommended related share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar topbar widget "
    "widgets".split()
)
REPLY_NAMES = frozenset("comment comments commentlist disqus replies reply respond".split())
MAIN_NAMES = frozenset("article articlebody content entry main mainbody maintext post postbody story storybody".split())
#: Two parts that together name the main text itself, whatever is around it.
TEXT_OF = (frozenset("article entry post story main".split()), frozenset("content body text".split()))
#: A name with one of these parts tells how a page is laid out, and not what the element holds.
MODIFIERS = frozenset("has have no not non with without is are hide hidden show shown fixed sticky enabled disabled on off layout wrapper".split())
#: An opening tag inside these starts after they have ended.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"'<]|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)",  # a quote is left open: the tag ends at its first ">"
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    parent: int  # number of the element around the innermost one
    depth: int  # elements around it
    shared: int  # how many of them are around the block before, too
    side: int  # 1 inside an article, -1 inside what is no main text, -2 inside replies to it, 0 unknown
    linked: int  # characters inside links


@dataclass(slots=True)
class _Open:
    tag: str
    number: int
    side: int


@dataclass(slots=True)
class _State:
    stack: list[_Open] = field(default_factory=lambda: [_Open("", 0, 0)])
    text: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    links: int = 0
    lowest: int = 1  # the least depth since the block before
    opened: Counter = field(default_factory=Counter)
    blocks: list[Block] = field(default_factory=list)

    def end_block(self) -> None:
        if self.text:
            text = " ".join(unescape("".join(self.text)).split())
            if text:
                linked = len(" ".join(unescape("".join(self.linked)).split()))
                top, depth = self.stack[-1], len(self.stack)
                parent = self.stack[-2].number if depth > 1 else -1
                shared = min(self.lowest, depth)
                self.blocks.append(Block(text, top.tag, parent, depth, shared, top.side, min(linked, len(text))))
                self.lowest = depth
        self.text.clear()
        self.linked.clear()

    def open(self, element: _Open) -> None:
        self.stack.append(element)
        self.opened[element.tag] += 1

    def close(self) -> str:
        tag = self.stack.pop().tag
        self.opened[tag] -= 1
        self.lowest = min(self.lowest, len(self.stack))
        return tag


def named_side(attributes: str) -> tuple[int, bool]:
    """(side, whether it holds inside what is no main text) by class, id and role; whole names only."""
    away = towards = replies = text = False
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").split():
            parts = {p.lower() for p in _PARTS.findall(name)}
            if parts & MODIFIERS:
                continue
            replies |= bool(parts & REPLY_NAMES)
            away |= bool(parts & ASIDE_NAMES)
            towards |= bool(parts & MAIN_NAMES)
            text |= all(parts & some for some in TEXT_OF)
    if replies:
        return -2, False
    if text and not away:
        return 1, True
    return (0, False) if away == towards else (-1 if away else 1, False)


def side_of(tag: str, attributes: str, around: int) -> int:
    """The side of an element: by its tag, then by its class, id and role, else that of what is around. An
    article, and what is named as the text of one, counts even inside what is no main text, but not inside
    replies."""
    side, strong = named_side(attributes) if "=" in attributes and tag not in ("html", "body") else (0, False)
    if around == -2 or side == -2:
        return -2
    if tag in MAIN:
        return -1 if side < 0 else 1
    if tag in ASIDE or tag == "header" and around <= 0:
        return -1
    return side if side and (around >= 0 or strong) else around


def blocks(html: str | None) -> list[Block]:
    """The page's text blocks in order."""
    page = html or ""
    s, at, number, endless = _State(), 0, 0, set()
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            s.text.append(page[at : m.start()])
            if s.links:
                s.linked.append(s.text[-1])
        at = m.end()
        closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                s.links = max(0, s.links - 1)
            elif tag in BLOCKS:
                s.end_block()
                while s.opened[tag] and s.close() != tag:
                    pass
            continue
        if tag in SILENT:
            if not attributes.rstrip().endswith("/"):
                end = None if tag in endless else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if not end:
                    endless.add(tag)  # nor is there one further on
                at = end.end() if end else (len(page) if tag in ("script", "style") else at)
            continue
        if tag == "br":
            s.text.append(" ")
        elif tag == "a":
            s.links = 1  # links do not nest
        elif tag in BLOCKS:
            s.end_block()
            s.links = 0
            while s.stack[-1].tag in _CLOSES.get(tag, {"p"}):
                s.close()
            if tag not in VOID:
                number += 1
                s.open(_Open(tag, number, side_of(tag, attributes, s.stack[-1].side)))
    s.text.append(page[at:])
    s.end_block()
    return s.blocks

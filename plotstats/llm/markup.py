"""Blocks of text of an HTML page, without what its markup itself calls menu, advert, form, comment and the like.

One pass over the page with a stack of open elements, linear in its length. Unclosed and stray tags are taken as
browsers take them: an end tag closes what was opened inside, one without a start is ignored.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

# comments, elements whose content is not markup, declarations, tags
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(script|style|textarea|title|iframe|xmp)\b[^<>]*>.*?(?:</\1\b[^<>]*>|\Z)"
    r"|<[!?][^<>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+|[^<>]*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden|style)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[a-z]+")

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that never hold the article.
CHROME = frozenset("nav footer aside form button select noscript template svg canvas audio video object map datalist dialog menu".split())
#: Elements that are kept on the stack; the others only separate blocks or do nothing.
NESTING = frozenset("div section article main header ul ol table tbody tr figure dl blockquote body details fieldset".split()) | CHROME
#: Words of class, id or role that name something other than the article.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie "
    "cookies discussion disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "promoted promotion recommended related replies respond search share sharing sidebar signup social sponsor sponsored subscribe subscription "
    "toolbar widget widgets".split()
)
#: Classes and properties that name the body of an article.
BODIES = frozenset("articlebody article-body article-content article-text entry-content post-body post-content story-body story-content".split())

NOWHERE, HIDDEN_ARTICLE, MAIN, ARTICLE = range(4)


class Block(NamedTuple):
    text: str
    level: int
    linked: int


def _marks(tag: str, attributes: str) -> str | None:
    """'chrome', 'article', 'main' or None, as said by the element's attributes."""
    kind = None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" and not value or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "chrome"
        if name == "role" and value == "main":
            kind = "main"
        elif name in ("class", "id", "itemprop") and BODIES.intersection(value.split()):
            kind = "article"
        elif name in ("class", "id", "role") and kind is None and tag not in ("html", "body", "main") and not HINTS.isdisjoint(_NAME.findall(value)):
            kind = "chrome"
    return kind


def blocks(page: str) -> list[Block]:
    """Blocks in page order, white space turned into single spaces, character references decoded, chrome left out."""
    out: list[Block] = []
    parts: list[str] = []
    stack: list[tuple[str, str | None]] = []
    open_ = {"chrome": 0, "hint": 0, "article": 0, "main": 0, "link": 0, "buried": 0}
    linked = 0

    def level() -> int:
        if open_["buried"]:
            return HIDDEN_ARTICLE
        return ARTICLE if open_["article"] else MAIN if open_["main"] else NOWHERE

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, level(), linked))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        for _, kind in stack[at:]:
            if kind:
                open_[kind] -= 1
        del stack[at:]

    def opened(tag: str) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                return i
        return -1

    def take(text: str) -> None:
        nonlocal linked
        if text and not open_["chrome"] and (not open_["hint"] or open_["buried"]):
            parts.append(text)
            if open_["link"]:
                linked += len(text)

    end = 0
    for token in _TOKEN.finditer(page):
        take(page[end : token.start()])
        end = token.end()
        if not token[3]:
            continue
        tag, attributes = token[3].lower(), token[4]
        if tag == "br":
            take(" ")
            continue
        if tag in BLOCKS:
            flush()
        if token[2]:
            if tag in NESTING or tag == "a" or (stack and any(t == tag for t, _ in stack)):
                at = opened(tag)
                if at >= 0:
                    if any(kind and kind != "link" for _, kind in stack[at:]):
                        flush()
                    close(at)
            continue
        if tag in VOID:
            continue
        if tag in BLOCKS and stack and stack[-1][0] in ("p", tag) and stack[-1][0] not in NESTING:
            close(len(stack) - 1)  # a marked paragraph or item ends where the next block begins
        kind = _marks(tag, attributes) if attributes else None
        if tag in CHROME or tag == "header" and not open_["article"] and not open_["main"]:
            kind = "chrome"
        elif kind == "chrome":
            kind = "hint"
        elif tag == "article":
            kind = "article"
        elif tag == "main":
            kind = "main"
        if kind in ("article", "main") and open_["hint"]:
            kind = "buried"
        elif tag == "a":
            kind = kind or "link"
        if kind or tag in NESTING:
            if kind and kind != "link":
                flush()
            stack.append((tag, kind))
            if kind:
                open_[kind] += 1
    take(page[end:])
    flush()
    return out


def article(page: str) -> tuple[list[str], bool]:
    """The blocks that may be the article, and whether the page names its article itself.

    These are the blocks inside article elements; without any, those inside main; without any, article elements within something
    that is named otherwise; without any, all blocks that are not mostly links.
    """
    found = blocks(page)
    best = max((b.level for b in found), default=NOWHERE)
    if best:
        return [b.text for b in found if b.level == best], True
    return [b.text for b in found if 2 * b.linked <= len(b.text)], False

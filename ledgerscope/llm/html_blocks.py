"""Text blocks of a web page: a tolerant tag scan with a stack of open elements."""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre script search section select style summary table tbody template tfoot thead title tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Never text of an article.
DROPPED = frozenset("head script style noscript template iframe object svg canvas math audio video map nav footer aside form button select textarea input dialog menu search title xmp noembed noframes".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist status".split())
#: Words of class and id names that mark page furniture.
FURNITURE = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar sidenav aside ad ads advert advertisement advertising adsense banner promo promotion sponsor sponsored cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup share sharing social related recommended recommendations comment comments disqus replies reply respond search login pagination pager widget toolbar masthead skip copyright".split())
#: Those that mark lists of other articles; the others can also name a layout around the page's own.
LISTS = frozenset("related recommended recommendations comment comments disqus replies reply respond".split())
_STATE = re.compile(r"(?<![^\s])comments?-(?:open|closed|enabled|disabled)(?![^\s])", re.I)
_COMMENT = re.compile(r"(?<![^\s])(?:comment|reply)(?:-body|-item)?(?![^\s])", re.I)
NEGATED = frozenset("with has no without".split())
CONTENT = frozenset("article main".split())
#: Elements that a new one of the key's kind closes.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
_STOPS = frozenset("table ul ol dl article section main div body td th aside nav header footer blockquote form".split())


class Block(NamedTuple):
    text: str
    content: bool  # within an article or main element
    furniture: bool


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _marks(tag: str, raw: str) -> tuple[bool, bool, bool]:
    """(content, furniture, kept) by an element's name and attributes. An article,
    main or articleBody element within resets furniture that isn't ``kept``: what
    only a class or id marks, but for lists of comments and related articles."""
    content, kept = tag in CONTENT, tag in DROPPED
    if not raw.strip():
        return content, kept, kept
    a = _attributes(raw)
    role = a.get("role", "").lower()
    content |= role in ("main", "article") or a.get("itemprop", "").lower() == "articlebody"
    named = False
    if tag not in ("html", "body", "main"):
        names = _STATE.sub(" ", a.get("class", "") + " " + a.get("id", ""))
        words = [w.lower() for w in _TOKEN.findall(names)]
        if content:
            kept |= bool(_COMMENT.search(names))
        elif not NEGATED.intersection(words):
            named = bool(FURNITURE.intersection(words))
            kept |= bool(LISTS.intersection(words))
        kept |= role in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
        kept |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", ""), re.I))
    return content, named or kept, kept


def blocks(html: str) -> list[Block]:
    """The page's non-empty blocks in order, white space in each as one space."""
    out: list[Block] = []
    parts: list[str] = []
    # open elements: (tag, content, furniture, a page header, kept furniture) with the parents' marks in them
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    named: list[int] = []  # furniture by class or id alone
    where: dict[str, list[int]] = {}  # places of each open element by name, so that no tag walks the stack
    stops: list[int] = [0]  # places of open elements that an unfinished one doesn't reach beyond

    def push(item: tuple[str, bool, bool, bool, bool]) -> None:
        where.setdefault(item[0], []).append(len(stack))
        if item[0] in _STOPS:
            stops.append(len(stack))
        stack.append(item)

    def cut(to: int) -> None:
        for item in stack[to:]:
            where[item[0]].pop()
            if item[0] in _STOPS:
                stops.pop()
        del stack[to:]

    def last(tag: str) -> int:
        places = where.get(tag)
        return places[-1] if places else 0

    def close() -> None:
        text = _SPACE.sub(" ", unescape("".join(parts))).strip()
        parts.clear()
        if text:
            _, content, furniture, header, kept = stack[-1]
            heading = header and content and any(where.get(h) for h in HEADINGS)
            if furniture and not kept and not header:
                named.append(len(out))
            out.append(Block(text, content, furniture or (header and not heading)))

    at, n = 0, len(html)
    last_end = html.rfind(">")
    while at < n:
        if at > last_end:  # only a comment or declaration is a tag without its end
            start = html.find("<!", at)
            m = _TAG.match(html, start) if start >= 0 else None
        else:
            m = _TAG.search(html, at)
        if not m:
            parts.append(html[at:])
            break
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:  # comment, doctype; CDATA is text
            if m[0].startswith("<![CDATA["):
                parts.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        raw = m[3] or m[6] or ""
        if m[1] or m[4]:
            if tag in BLOCKS:
                close()
            i = last(tag)
            if i and (tag in _STOPS or tag in ("html", "body") or i > stops[-1]):
                if any(s[2] != stack[i - 1][2] or s[1] != stack[i - 1][1] for s in stack[i:]):
                    close()
                cut(i)
            if tag in ("td", "th"):
                parts.append(" ")
            continue
        if tag in ("br", "td", "th"):
            parts.append(" ")
        if tag in BLOCKS:
            close()
        if tag in CLOSES or tag in BLOCKS:
            i = max(map(last, CLOSES.get(tag, {"p"})))
            if i and i >= stops[-1]:
                cut(i)
        if tag in VOID or raw.endswith("/") and tag in ("svg", "path", "iframe"):
            continue
        content, furniture, kept = _marks(tag, raw)
        above = stack[-1]
        kept |= above[4]
        furniture |= kept or (above[2] and not content)
        if (furniture, content or above[1]) != (above[2], above[1]):
            close()
        push((tag, above[1] or content, furniture, above[3] or tag == "header", kept))
        if tag in RAW:  # nothing inside is markup
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            inner, at = html[at : end.start() if end else n], end.end() if end else n
            if tag == "title" and inner.strip():
                parts.append(inner)
                close()
            cut(len(stack) - 1)
            parts.clear()
    close()
    if named and all(b.furniture for b in out):  # a page within such an element, with no article marked
        for i in named:
            out[i] = out[i]._replace(furniture=False)
    return out

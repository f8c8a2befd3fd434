"""One page as a sequence of tokens: tags by their place, runs of text by place and role."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import xxhash

#: A comment, a declaration, or a tag whose quoted values may hold ``>``; an unclosed comment or tag reaches to the end.
MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
DIGITS = re.compile(r"\d+")
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|[^A-Za-z0-9]+")

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark meter nobr output q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split())
#: Cells and line breaks part words, but not blocks.
SPACED = frozenset("br td th".split())
#: Opening one of these ends an open one of the same set.
SIBLINGS = [frozenset(x.split()) for x in ("li", "dt dd", "tr", "td th", "option", "tbody thead tfoot")]
#: A sibling isn't ended across one of these.
HOLDERS = frozenset("ul ol menu dl table select".split())
NEVER = frozenset(
    "head script style title noscript template iframe object svg math canvas audio video select button textarea datalist noembed noframes".split())
ASIDE = frozenset("nav aside footer form menu dialog fieldset".split())
#: Of these, such as an article or main element inside leads out of: a form around the page, a menu that never ends.
LOOSE_NAMES = frozenset("nav form header".split())
IN_HEAD = frozenset("head title base link meta style script noscript template".split())
# Roles of the ARIA standard that aren't main text.
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
# First or last words of class names and ids that aren't main text.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners sponsor sponsors sponsored promo promos promotion "
    "nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead topbar toolbar notice notices cookie "
    "cookies consent gdpr alert alerts popup modal overlay newsletter subscribe subscription signup login search form forms share sharing social "
    "related recommended recommendations pagination pager skip copyright comment comments commentlist disqus reply replies respond".split())
HEAD_WORDS = frozenset("header headers".split())
#: Names that begin so say what an element has or lacks, not what it is.
NOT_ITSELF = frozenset("has with without no is not".split())
MAIN_NAMES = frozenset(
    "article content main post entry story main-content maincontent article-body article-content articlebody post-content post-body entry-content "
    "story-body page-content content-main content-body".split())

#: Roles of text: dropped, or the rank of the region it is in.
DROPPED, PLAIN, NAMED, MAIN, ARTICLE = -1, 0, 1, 2, 3
#: Elements open at once. Deeper ones end what is open at that depth, as in browsers: no text is lost, and
#: a page of tags alone takes time in proportion to its length.
DEEPEST = 512
#: Regions that aren't main text.
LOOSE, FIRM, NO_TEXT = 1, 2, 3


class Token(NamedTuple):
    mark: int  # hash of the tag or text at its place
    text: str | None  # raw text, if it is one
    role: int  # of a text
    inside: tuple[int, ...]  # hashes of the containers around, outermost first
    link: bool  # a text in a link
    breaks: int  # a tag: 2 begins a block, 1 parts words, 0 neither


class _Open(NamedTuple):
    name: str
    mark: int
    aside: int  # 0, LOOSE, FIRM, NO_TEXT
    rank: int
    link: bool
    inside: tuple[int, ...]


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


def _aside(name: str, attributes: dict[str, str], rank: int) -> int:
    """Whether an element, in a region of this rank, begins something that isn't main text."""
    if name in NEVER:
        return NO_TEXT
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        return NO_TEXT
    if name in ("html", "body", "article", "main"):
        return 0
    if name in ASIDE or name == "header" and rank < NAMED or attributes.get("role", "").lower() in ASIDE_ROLES:
        return LOOSE if name in LOOSE_NAMES else FIRM
    for value in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in CAMEL.split(value) if w]
        if not words or words[0] in NOT_ITSELF:
            continue
        if not ASIDE_WORDS.isdisjoint((words[0], words[-1])) or rank < NAMED and words[-1] in HEAD_WORDS:
            return FIRM
    return 0


def _rank(name: str, attributes: dict[str, str]) -> int:
    role = attributes.get("role", "").lower()
    if name == "article" or role == "article" or "articlebody" in attributes.get("itemprop", "").lower().split():
        return ARTICLE
    if name == "main" or role == "main":
        return MAIN
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().replace("_", "-").split()
    return NAMED if any(n in MAIN_NAMES for n in names) else PLAIN


def walk(page: str) -> Iterator[Token]:
    """The tokens of a page in order. Bad nesting is read as browsers do: an end tag ends what is open inside, one without a start is nothing."""
    stack = [_Open("", _hash(""), 0, PLAIN, False, ())]
    at, end = 0, len(page)
    while at < end:
        found = MARKUP.search(page, at)
        start = found.start() if found else end
        if start > at:
            top, run = stack[-1], page[at:start]
            if run.strip():
                role = DROPPED if top.aside else top.rank
                yield Token(_hash("text", str(top.mark), " ".join(run.split())), run, role, top.inside, top.link, 0)
        if not found:
            return
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        breaks = 0 if name in INLINE else 1 if name in SPACED else 2
        if found[1]:
            depth = len(stack) - 1
            while depth and stack[depth].name != name and not (name in INLINE and stack[depth].name not in INLINE and stack[depth].name != "p"):
                depth -= 1
            if depth and stack[depth].name == name:
                yield Token(_hash("end", str(stack[depth].mark)), None, 0, (), False, breaks)
                del stack[depth:]
            elif breaks:
                yield Token(_hash("end", name), None, 0, (), False, breaks)
            continue
        if stack[-1].name == "head" and name not in IN_HEAD:
            stack.pop()
        if breaks == 2:  # a block ends an open paragraph
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == "p":
                    del stack[depth:]
                if depth >= len(stack) or stack[depth].name not in INLINE:
                    break
        for group in SIBLINGS:
            if name in group:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name in HOLDERS and not (name in ("td", "th") and stack[depth].name != "table"):
                        break
                    if stack[depth].name in group:
                        del stack[depth:]
                        break
        top = stack[-1]
        attributes = _attributes(found[3])
        key = DIGITS.sub("#", " ".join((name, attributes.get("class", ""), attributes.get("id", ""), attributes.get("role", ""))))
        mark = _hash("start", str(top.inside[-1] if top.inside else 0), key)
        yield Token(mark, None, 0, (), False, breaks)
        if name in VOID or found[3].endswith("/") and name in ("svg", "path"):
            continue
        aside, rank = max(top.aside, _aside(name, attributes, top.rank)), _rank(name, attributes)
        if aside == LOOSE and rank >= MAIN:
            aside = 0
        container = name not in INLINE and name not in ("p", "li", "tr", "td", "th", "dt", "dd", "br") and not re.fullmatch("h[1-6]", name)
        del stack[DEEPEST:]
        stack.append(_Open(name, mark, aside, max(top.rank, rank), top.link or name == "a", (*top.inside, mark) if container else top.inside))
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else end

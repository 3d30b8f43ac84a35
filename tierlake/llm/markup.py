"""Blocks of text in HTML, inside tasks."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

# HTML elements by role, and words of class names, ids and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style title noscript template iframe object svg math canvas audio video".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead tr ul".split()
)
MAIN = frozenset("article main".split())
BESIDE = frozenset("nav footer aside form menu button select textarea dialog datalist label".split())
BESIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising advertorial banner breadcrumb breadcrumbs comment comments"
    " commentlist complementary consent contentinfo cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation"
    " newsletter notice notices popup promo promotion related replies respond search share sharing sidebar signup"
    " social sponsor sponsored subscribe toolbar widget".split()
)
# Words that may stand beside those in a name: where a block is, what holds it, or whose it is.
PLACE_WORDS = frozenset(
    "area bar block bottom box container form google inner items left links list main page post primary reader readers"
    " right secondary section site slot thread top unit user users wrap wrapper".split()
)
# Names that inside an article may as well be those of its own sections.
OWN_WORDS = frozenset("related search social share notice notices respond".split())
HEADER_WORDS = frozenset("header banner masthead".split())
CLOSES_P = BLOCKS - {"option", "summary", "caption", "tbody", "tfoot", "thead", "tr", "td", "th", "body", "html"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|([^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORDS = re.compile(r"[a-z]+")


@dataclass(frozen=True)
class Element:
    """An open element: its tag, its path with names, and where it stands."""

    tag: str
    path: str
    main: bool
    beside: bool
    hidden: bool
    #: Main text that was opened inside a block beside, as by a wrapper around the page.
    lifted: bool = False
    #: The paths of the block elements it stands in, itself last if it is one.
    within: tuple[str, ...] = ()


ROOT = Element("", "", False, False, False)


def named(names: list[str], wanted: frozenset[str]) -> bool:
    """Whether a whole name is made of wanted words, and of words of place beside them."""
    for name in names:
        words = set(WORDS.findall(name))
        if words & wanted and words <= wanted | PLACE_WORDS:
            return True
    return False


def child(above: Element, tag: str, attributes: str) -> Element:
    names = " ".join(x for match in NAMES.findall(attributes) for x in match if x).lower()
    words = set(WORDS.findall(names))
    main = above.main or tag in MAIN or "main" in words and "role" in attributes
    # An article in a block beside is main text of second choice; one inside the article stays what it is there.
    lifted = above.lifted or above.beside and tag in MAIN and not above.main
    beside = above.beside and (above.main or tag not in MAIN) or tag in BESIDE
    if tag not in ("html", "body") and tag not in MAIN:
        beside = beside or named(names.split(), BESIDE_WORDS - HEADER_WORDS - OWN_WORDS if above.main else BESIDE_WORDS)
        beside = beside or not above.main and (tag == "header" or named(names.split(), HEADER_WORDS))
    path, within = above.path, above.within
    if tag in BLOCKS:
        path = f"{path}/{tag}" + (f"[{names}]" if names else "")
        within = (*within, path)
    return Element(tag, path, main, beside, above.hidden or tag in HIDDEN, lifted, within)


@dataclass
class Block:
    """A run of text between block boundaries, with the element it stands in."""

    element: Element
    text: str


def blocks(html: str) -> Iterator[Block]:
    """Blocks in page order, and an empty block where a block element opens."""
    stack, gathered = [ROOT], []
    start = ROOT

    def flush() -> list[Block]:
        text = " ".join("".join(gathered).split())
        gathered.clear()
        return [Block(start, text)] if text else []

    for match in TOKEN.finditer(html):
        _, closing, tag, attributes, text = match.groups()
        if text is not None:
            if not stack[-1].hidden:
                start = start if gathered else stack[-1]
                gathered.append(unescape(text))
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            gathered.append("\n")
            continue
        block = tag in BLOCKS
        if block or tag in HIDDEN:
            yield from flush()
        if closing:
            if any(element.tag == tag for element in stack):
                while stack.pop().tag != tag:
                    pass
            continue
        if block:
            if tag in CLOSES_P and any(element.tag == "p" for element in stack):
                closed = next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == "p")
                if all(element.tag not in BLOCKS for element in stack[closed + 1 :]):
                    del stack[closed:]
            if tag == "li" and stack[-1].tag == "li":
                stack.pop()
        element = child(stack[-1], tag, attributes)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(element)
        if block:
            yield Block(element, "")
    yield from flush()

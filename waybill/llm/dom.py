"""A page as flat arrays of block elements, read leniently in one pass."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# HTML's element classes as far as they matter here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("head script style textarea title iframe noembed noframes noscript template object svg math select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# an element, and the open elements it ends up to the given borders
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>")
TOKENS = re.compile(r"""(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")


@dataclass
class Page:
    """Elements in page order; a child comes after its parent and before its end."""

    tags: list[str] = field(default_factory=list)
    tokens: list[str] = field(default_factory=list)  # attribute values, as written
    parents: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)  # first element after the subtree
    hidden: list[bool] = field(default_factory=list)
    tag_count: list[int] = field(default_factory=list)  # inline elements that belong here
    pieces: list[tuple[int, str, bool, int]] = field(default_factory=list)  # element, text, in a link, block


def parse(source: str) -> Page:
    """The page's block elements and texts.

    Inline elements belong to the block around them.  A new block of text begins where
    a block element begins or ends.  Text that stands in no block element gets one of its
    own, a body, for each stretch between block elements.
    """
    page = Page()

    def opened(tag: str, attributes: str, parent: int) -> int:
        page.tags.append(tag)
        page.tokens.append(" ".join("".join(m) for m in TOKENS.findall(attributes)) if attributes else "")
        page.parents.append(parent)
        page.ends.append(0)
        page.hidden.append(tag in HIDDEN or (parent >= 0 and page.hidden[parent]))
        page.tag_count.append(0)
        return len(page.tags) - 1

    root = opened("#root", "", -1)
    stack: list[tuple[str, int]] = [("#root", root)]  # tag, block element
    links = 0
    block = 0
    bare = (-1, -1)  # the last body made for bare text, and its block
    at, size = 0, len(source)

    def said(text: str) -> None:
        nonlocal bare
        element = stack[-1][1]
        if element == root:
            if bare[1] != block:
                if text.isspace():
                    return
                bare = opened("body", "", root), block
                page.ends[bare[0]] = len(page.tags)
            element = bare[0]
        page.pieces.append((element, text, links > 0, block))

    def close_to(depth: int) -> None:
        nonlocal links, block
        while len(stack) > depth:
            tag, element = stack.pop()
            if tag == "a":
                links -= 1
            if stack[-1][1] != element:
                page.ends[element] = len(page.tags)
                block += 1

    def end_open(which: frozenset, borders: frozenset) -> None:
        lowest = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in borders:
                break
            if stack[depth][0] in which:
                lowest = depth
        if lowest:
            close_to(lowest)

    while at < size:
        less = source.find("<", at)
        text = source[at:less if less >= 0 else size]
        if text:
            said(text)
        if less < 0:
            break
        follows = source[less + 1:less + 2]
        if follows == "!" or follows == "?":
            if source.startswith("<!--", less):
                end = source.find("-->", less + 4)
                at = end + 3 if end >= 0 else size
            else:
                end = source.find(">", less)
                at = end + 1 if end >= 0 else size
            continue
        match = TAG.match(source, less) or LOOSE_TAG.match(source, less) if follows.isalpha() or follows == "/" else None
        if match is None:
            if follows == "/" and (end := source.find(">", less)) >= 0:
                at = end + 1  # an end tag without a name
            else:
                said("<")
                at = less + 1
            continue
        at = match.end()
        closing, tag, attributes = match[1], match[2].lower(), match[3]
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close_to(depth)
                    break
            continue
        if tag == "br":
            said(" ")
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close_to(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        if tag in ENDS:
            end_open(*ENDS[tag])
        parent = stack[-1][1]
        if tag in VOID:
            page.tag_count[parent] += 1
            if tag not in INLINE:
                block += 1
            continue
        if tag in RAW:
            element = opened(tag, "", parent)
            page.ends[element] = len(page.tags)
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            at = source.find(">", end.end()) + 1 or size if end else size
            if tag not in INLINE and tag not in ("script", "style"):
                block += 1
            continue
        if tag in INLINE:
            page.tag_count[parent] += 1
            links += tag == "a"
            stack.append((tag, parent))
            continue
        block += 1
        stack.append((tag, opened(tag, attributes, parent)))
    close_to(1)
    page.ends[root] = len(page.tags)
    return page


def words_of(tokens: str) -> list[str]:
    """The words of attribute values: lower case, letters only, cut at capitals."""
    return WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", tokens).lower())


def decoded(text: str) -> str:
    return html.unescape(text) if "&" in text else text

"""One page of HTML to its text blocks, with the style path of each; a helper of `site_style`."""

import re
import zlib
from collections import Counter
from html import unescape
from typing import NamedTuple

import xxhash

#: Controls and what is not shown: their text is never the page's.
HIDDEN = frozenset(
    "button select textarea input script style noscript template iframe object embed svg canvas audio video map"
    " head title".split()
)
#: What HTML itself calls furniture.
FURNITURE = frozenset("nav footer aside form dialog menu".split())
#: Words of class, id and role by which sites name reader comments.
COMMENT_WORDS = frozenset("comment comments commentlist respond disqus replies reply".split())
#: Words that name furniture whatever else is in the name.
STRONG_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion cookie cookies"
    " consent gdpr popup modal overlay sidebar newsletter subscribe signup breadcrumb breadcrumbs navbar masthead"
    " topbar pagination pager contentinfo complementary".split()
)
#: Words that may name furniture or a subject: beside other words they need evidence.
WEAK_WORDS = frozenset(
    "banner notice notices alert aside widget widgets share sharing social related recommended recommendations login"
    " menu nav navigation toolbar footer skip search dialog".split()
)
#: Words that tell nothing about a name's other words.
PLAIN_WORDS = frozenset(
    "left right top bottom list box bar wrapper wrap container item items button buttons link links section block area"
    " inner outer primary secondary slot site page posts articles icons form field module panel".split()
)
#: A name that begins so speaks of the element's surroundings.
STATES = frozenset("has no with without is not".split())
#: Names that are furniture only outside the article.
OUTER_WORDS = frozenset(("header", "head"))
#: Elements of running text: a weak name alone does not take them out.
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt blockquote span b i em strong a figcaption pre".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of a block that make it prose, and of a linked paragraph that make it text.
PROSE_WORDS, LINKED_WORDS = 12, 4
BLOCKS = frozenset(
    "html body p div h1 h2 h3 h4 h5 h6 li ul ol dl dt dd table caption thead tbody tfoot tr td th section"
    " article main blockquote pre figure figcaption address header footer aside nav form fieldset hr details"
    " summary center hgroup search menu dialog".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: A start tag ends the open element of its group, up to the given borders.
_ENDS_P = BLOCKS - {"html", "body"}
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P_BORDERS = (BLOCKS - {"p"}) | frozenset("table td th button object".split())
#: Of a block's branches the innermost; more are found in no site's style.
_MOST_BRANCHES = 40

_RAW = {
    tag: re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I)
    for tag in "script style template noscript iframe svg textarea select title".split()
}
# Every quantifier is possessive, and a tag that is never closed ends before the next "<":
# matching takes time in proportion to the page.
_NAME = r"[^\s/<>][^\s/<>=]*+"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s<>]*+)"""
_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<[!?][^>]*+>?"
    r"|</([a-z][^\s/<>]*+)[^<>]*+>?"
    rf"|<([a-z][^\s/<>]*+)((?:[\s/]*+{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+)[\s/]*+(?:>|(?=<)|\Z)",
    re.I | re.S,
)
_ATTRIBUTE = re.compile(rf"[\s/]*+({_NAME})(?:\s*+=\s*+({_VALUE}))?+")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    """A text block: hashes of its own path, its parent's and its text, and those of the paths around it."""

    node: int
    parent: int
    feature: int
    branches: tuple[int, ...]
    text: str


class _Open(NamedTuple):
    tag: str
    path: int
    parent: int
    above: "tuple | None"  # (path, above) of the elements around, innermost first
    skips: bool
    region: int
    named: int  # the innermost element with a name of furniture


class _Named:
    """An element that its name or tag calls furniture, and the evidence."""

    __slots__ = ("around", "level", "tag", "article", "chars", "linked", "prose", "regional")

    def __init__(self, around: int, level: int, tag: str):
        self.around, self.level, self.tag = around, level, tag
        self.article = self.prose = False
        self.chars = self.linked = self.regional = 0


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(text):
        if value[:1] in ("'", '"') and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


#: Levels of a name: evidence is needed, the name suffices, reader comments.
_WEAK, _STRONG, _COMMENTS = 1, 2, 3


def _level(attributes: dict[str, str], inside: bool) -> int:
    """What class, id and role call the element, by their strongest name."""
    level = 0
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split():
        words = [w.lower() for w in _WORDS.findall(name)]
        if not words or words[0] in STATES:
            continue
        listed = [w for w in words if w in STRONG_WORDS or w in WEAK_WORDS or not inside and w in OUTER_WORDS]
        if any(w in COMMENT_WORDS for w in words):
            level = max(level, _COMMENTS)
        elif any(w in STRONG_WORDS for w in words) or listed and all(w in listed or w in PLAIN_WORDS for w in words):
            level = max(level, _STRONG)
        elif listed:
            level = max(level, _WEAK)
    return level


def _is_hidden(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    return bool(re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I))


def _goes(e: _Named, total: int, regional: int) -> bool:
    """Whether a named element is furniture. One that holds the page's article never is."""
    if e.article:
        return False
    if e.level == _COMMENTS:
        return True
    if e.level == _STRONG:
        # Without an article or main part elsewhere, most of the text is the page's text.
        return regional > e.regional or 2 * e.chars <= total
    return 2 * e.linked >= max(e.chars, 1) or not e.prose and e.tag not in TEXT_TAGS


def blocks_of(html: str) -> tuple[list[Block], list[tuple[int, int]]]:
    """The page's text blocks in order, and (node, style) of its elements: the tags of their children.

    What is hidden gives no block. An element that its tag or name calls furniture gives
    none if the evidence agrees (`_goes`). If a page has an article (or else a main part)
    with a quarter of the remaining text, only its blocks count, and the headings of the first
    rank before it; else blocks that are links alone go, but for paragraphs and headings.
    """
    root = _Open("", 0, 0, None, False, 0, 0)
    stack = [root]
    children = [0]
    opened: Counter[str] = Counter()
    named = [_Named(0, 0, "")]
    found: list[tuple[int, bool, int, str, Block]] = []
    styles: set[tuple[int, int]] = set()
    pieces: list[str] = []
    around = [root]  # the open blocks
    linked = 0
    links = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                top = around[-1]
                above, branches = top.above, []
                while above is not None and len(branches) < _MOST_BRANCHES:
                    branches.append(above[0])
                    above = above[1]
                e = named[stack[-1].named]
                e.chars += len(text)
                e.linked += min(linked, len(text))
                e.regional += len(text) * (top.region > 0)
                e.prose |= text.count(" ") >= PROSE_WORDS - 1
                block = Block(top.path, top.parent, _hash(text), tuple(branches), text)
                found.append((top.region, linked >= len(text), stack[-1].named, top.tag, block))
            pieces.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            top = stack.pop()
            style = children.pop()
            opened[top.tag] -= 1
            if around[-1] is top:
                around.pop()
            if not top.skips:
                styles.add((top.path, style))
            links -= top.tag == "a"

    def close_open(group: set[str] | frozenset[str], borders: frozenset[str] | set[str]) -> bool:
        """Close the innermost open element of the group, unless a border is nearer."""
        if not any(opened[t] > 0 for t in group):
            return False
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in group:
                flush()
                close(i)
                return True
            if stack[i].tag in borders:
                return False
        return False

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        start = m.start() if m else size
        if start > at and not stack[-1].skips:
            piece = html[at:start]
            pieces.append(unescape(piece) if "&" in piece else piece)
            if links:
                linked += len(piece)
        if m is None:
            break
        at = m.end()
        tag = m[1]
        if tag is not None:
            tag = tag.lower()
            if opened[tag] > 0:
                depth = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
                if around[-1] is not root and any(x.tag in BLOCKS for x in stack[depth:]):
                    flush()
                close(depth)
            continue
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            if not stack[-1].skips:
                pieces.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            if tag in _ENDS_P:
                close_open({"p"}, _ENDS_P_BORDERS)
        if tag in _ENDS:
            group, borders = _ENDS[tag]
            while close_open(group, borders) and tag == "tr" and stack[-1].tag in ("tr", "td", "th"):
                pass
        if tag in VOID:
            continue
        if tag in _RAW:
            # What is inside is no markup, or nobody reads it.
            children[-1] = zlib.crc32(tag.encode(), children[-1])
            end = _RAW[tag].search(html, at)
            at = size if end is None else (html.find(">", end.end()) + 1 or size)
            if not stack[-1].skips:
                pieces.append(" ")
            continue
        over = stack[-1]
        attributes = _attributes(m[3]) if m[3] else {}
        level = _level(attributes, over.region == 2) if attributes else 0
        region = over.region
        if tag == "article" and level != _COMMENTS or attributes.get("itemprop") == "articleBody":
            region = 2
        elif tag == "main" or attributes.get("role") == "main":
            region = max(region, 1)
        inner = over.named
        if region > over.region and over.region < 2:
            # The elements around hold the page's article.
            if not named[inner].article:
                e = inner
                while not named[e].article:
                    named[e].article = True
                    e = named[e].around
        elif tag in FURNITURE or tag == "header" and over.region < 2:
            level = max(level, _STRONG)
        if level and not (tag in ("html", "body", "main") or region > over.region):
            named.append(_Named(inner, level, tag))
            inner = len(named) - 1
        skips = over.skips or tag in HIDDEN or bool(attributes) and tag not in ("html", "body", "main") and _is_hidden(attributes)
        if skips and not over.skips and tag not in BLOCKS:
            pieces.append(" ")
        children[-1] = zlib.crc32(tag.encode(), children[-1])
        name = attributes.get("class") or attributes.get("id")
        label = f"{tag}.{'.'.join(name.split())}" if name else tag
        path = _hash(f"{over.path}/{label}")
        entry = _Open(tag, path, over.path, (over.path, over.above), skips, region, inner)
        stack.append(entry)
        children.append(0)
        opened[tag] += 1
        if tag in BLOCKS:
            around.append(entry)
        links += tag == "a"
    flush()
    close(1)
    return _chosen(found, named), sorted(styles)


def _chosen(found: list, named: list[_Named]) -> list[Block]:
    total = sum(len(b.text) for *_, b in found)
    regional = sum(len(b.text) for region, *_, b in found if region)
    for e in reversed(named[1:]):
        outer = named[e.around]
        outer.chars += e.chars
        outer.linked += e.linked
        outer.regional += e.regional
        outer.prose |= e.prose
    gone = [False] * len(named)
    for i, e in enumerate(named):
        gone[i] = i > 0 and (gone[e.around] or _goes(e, total, regional))
    found = [x for x in found if not gone[x[2]]]
    total = sum(len(b.text) for *_, b in found)
    for least in (2, 1):
        inside = [i for i, x in enumerate(found) if x[0] >= least]
        if inside and 4 * sum(len(found[i][-1].text) for i in inside) >= total:
            titles = [i for i in range(inside[0]) if found[i][3] == "h1" and not found[i][1]]
            return [found[i][-1] for i in [*titles, *inside]]
    return [
        b
        for _, link, _, tag, b in found
        if not link or (tag in HEADINGS or tag == "p") and b.text.count(" ") >= LINKED_WORDS - 1
    ]

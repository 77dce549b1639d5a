"""One pass over a page's markup: tags and text to a flat list of nodes.

Kept free of Spark so that it can be shipped to the executors by value; the
table operator around it is ``newsloom.operators.dom.dom_nodes``.

Nodes are in document order, so the subtree of node *i* is exactly the index
range ``i..last[i]``.  ``within`` carries, as bits, which kinds of elements
enclose a node (the node itself not counted).
"""

import re
from collections import defaultdict
from html import unescape

IN_ARTICLE = 1
IN_MAIN = 2
IN_TEXT_BLOCK = 4
IN_RICH_TEXT = 8
IN_FURNITURE = 16
IN_HIDDEN = 32
IN_LINK = 64

TEXT = "#text"

# Elements and class words that mark page furniture.
FURNITURE_TAGS = ("figure", "figcaption", "aside", "header", "footer", "nav")
FURNITURE_WORDS = ("promo", "share", "related", "advert", "cookie")

# Elements whose text is never part of visible text.
_HIDDEN_TAGS = ("script", "style", "template", "rt", "rp")
_RAW_TAGS = ("script", "style")

_TAG_MARKS = {
    "article": IN_ARTICLE,
    "main": IN_MAIN,
    "a": IN_LINK,
    **dict.fromkeys(FURNITURE_TAGS, IN_FURNITURE),
    **dict.fromkeys(_HIDDEN_TAGS, IN_HIDDEN),
}

_VOID = frozenset(
    "area base basefont br col embed frame hr img input isindex link meta param "
    "source track wbr".split()
)

# HTML 4 block elements: their start ends an open paragraph.
_ENDS_PARAGRAPH = frozenset(
    "address blockquote body caption center col colgroup dd dir div dl dt fieldset "
    "form frameset h1 h2 h3 h4 h5 h6 head hr li listing menu multicol ol p pre "
    "table tbody td tfoot th thead title tr ul xmp".split()
)
# An open element of the value set is ended by the start of the key.
_ENDS_SIBLING = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "tr": {"tr", "td", "th"},
    "option": {"option"},
    "body": {"head"},
}
# Inline elements: they are ended together with the block around them.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
    "mark q s samp small span strike strong sub sup time tt u var".split()
)
# A misplaced end tag does not reach beyond an element of higher rank.
_RANK = {
    "div": 150, "td": 160, "th": 160, "tr": 170, "thead": 180, "tbody": 180,
    "tfoot": 180, "table": 190, "head": 200, "body": 200, "html": 220,
}
_DEFAULT_RANK = 100

# A tag that is never closed ends before the next "<"; that keeps matching linear.
_NAME = r"[^\s/<>][^\s/<>=]*+"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s<>]*+)"""
_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<[!?][^>]*+>?"
    r"|</([a-zA-Z][^\s/<>]*+)[^<>]*+>?"
    rf"|<([a-zA-Z][^\s/<>]*+)((?:[\s/]*+{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+)([\s/]*+)(>|(?=<)|\Z)",
    re.S,
)
_ATTRS = re.compile(rf"[\s/]*+({_NAME})(?:\s*+=\s*+({_VALUE}))?+")
_RAW_END = {t: re.compile("</" + t + r"(?=[\s/>])", re.I) for t in _RAW_TAGS}
_ATTR_REF = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*+(?:;|(?!=)))")


def _attributes(source):
    found = {}
    for name, value in _ATTRS.findall(source):
        name = name.lower()
        if name in found:
            continue
        if value[:1] in "\"'" and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        if "&" in value:
            value = _ATTR_REF.sub(lambda m: unescape(m.group()), value)
        found[name] = value
    return found


def _marks(tag, attrs):
    marks = _TAG_MARKS.get(tag, 0)
    if attrs:
        if attrs.get("data-component") == "text-block":
            marks |= IN_TEXT_BLOCK
        classes = attrs.get("class")
        if classes:
            if "RichTextComponentWrapper" in classes:
                marks |= IN_RICH_TEXT
            lowered = classes.lower()
            if any(word in lowered for word in FURNITURE_WORDS):
                marks |= IN_FURNITURE
    return marks


def scan(html):
    """``html`` -> list of (parent, within, tag, attrs, text) and list of subtree ends."""
    nodes = []
    last = []
    stack = []  # (node, tag, marks for children)
    opened = defaultdict(int)  # tag -> how many are on the stack
    pending = []

    def flush():
        text = "".join(pending).strip()
        pending.clear()
        if text:
            parent, _, marks = stack[-1] if stack else (-1, "", 0)
            last.append(len(nodes))
            nodes.append((parent, marks, TEXT, None, text))

    def cut(depth):
        end = len(nodes) - 1
        for node, tag, _ in stack[depth:]:
            last[node] = end
            opened[tag] -= 1
        del stack[depth:]

    def implied_ends(tag):
        ended = _ENDS_SIBLING.get(tag, ())
        ends_p = tag in _ENDS_PARAGRAPH
        if not (ends_p and opened["p"]) and not any(opened[t] for t in ended):
            return
        depth = None
        for i in range(len(stack) - 1, -1, -1):
            open_tag = stack[i][1]
            if open_tag in ended or (ends_p and open_tag == "p"):
                depth = i
            elif open_tag not in _INLINE:
                break
        if depth is not None:
            cut(depth)

    pos, size = 0, len(html)
    search = _MARKUP.search
    while pos < size:
        m = search(html, pos)
        start = m.start() if m else size
        if start > pos:
            piece = html[pos:start]
            pending.append(unescape(piece) if "&" in piece else piece)
        if not m:
            break
        pos = m.end()
        end_tag, tag = m.group(1), m.group(2)
        if tag:
            flush()
            tag = tag.lower()
            implied_ends(tag)
            attrs = _attributes(m.group(3)) if m.group(3) else None
            parent, _, marks = stack[-1] if stack else (-1, "", 0)
            node = len(nodes)
            nodes.append((parent, marks, tag, attrs, None))
            last.append(node)
            if tag in _VOID or m.group(4).endswith("/") or not m.group(5):
                continue
            marks |= _marks(tag, attrs)
            if tag in _RAW_TAGS:
                close = _RAW_END[tag].search(html, pos)
                stop = close.start() if close else size
                if stop > pos:
                    nodes.append((node, marks, TEXT, None, html[pos:stop]))
                    last.append(node + 1)
                    last[node] = node + 1
                pos = size if close is None else (html.find(">", stop) + 1 or size)
                continue
            stack.append((node, tag, marks))
            opened[tag] += 1
        elif end_tag:
            end_tag = end_tag.lower()
            if not opened[end_tag]:
                continue
            rank = _RANK.get(end_tag, _DEFAULT_RANK)
            for i in range(len(stack) - 1, -1, -1):
                open_tag = stack[i][1]
                if open_tag == end_tag:
                    flush()
                    cut(i)
                    break
                if _RANK.get(open_tag, _DEFAULT_RANK) > rank:
                    break
        else:
            flush()
    flush()
    cut(0)
    return nodes, last

"""HTML pages as trees of block elements whose leaves are blocks of text.

A forgiving reader in the spirit of the HTML standard: void elements, omitted end tags, raw text
elements, stray end tags and unclosed quotes or comments. Elements that never show text of an article
(scripts, styles, form controls, embedded objects) are passed over with all they hold. Inline elements
do not part a block; one whose class or id says what it is for (an inline advert, say) does.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Fixed values of the HTML standard: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
PASSED = frozenset("noscript template select button svg math object canvas audio video map datalist".split())
BLOCKS = frozenset(
    """address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p pre search section
    summary table tbody td tfoot th thead tr ul""".split()
)
IGNORED = frozenset("html head body".split())
#: Open elements that a start tag ends, and the elements beyond which it does not look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
PARAGRAPH_SCOPE = {"table", "td", "th", "caption"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Words of classes, ids and roles, by what they say about an element.
HINTS = {
    "main": "article content main post entry story prose body text richtext markdown",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs crumb crumbs pagination pager toc tabs toolbar skip",
    "head": "header masthead topbar logo branding brand",
    "foot": "footer foot copyright colophon legal bottom contentinfo",
    "side": "sidebar aside rail widget widgets related recommended popular trending teaser teasers complementary",
    "notice": "notice notices alert cookie cookies consent gdpr privacy modal popup overlay toast dialog paywall newsletter subscribe subscription",
    "ad": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors banner promo promotion promoted",
    "comment": "comment comments commentlist reply replies respond response responses discussion disqus feedback thread reviews guestbook",
    "share": "share sharing social follow likes",
    "form": "form search login signin signup register subscribe",
}
HINT_OF = {word: kind for kind, words in HINTS.items() for word in words.split()}
HINT_KINDS = tuple(HINTS)
#: Elements that say the same by their tag.
TAG_HINTS = {"nav": "menu", "menu": "menu", "footer": "foot", "aside": "side", "form": "form", "search": "form", "dialog": "notice"}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</[^A-Za-z][^>]*(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?:>|\Z)""",
    re.DOTALL,
)
NAMING = re.compile(r"""(?<![^\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
HIDDEN = re.compile(r"""(?<![^\s"'/])hidden(?![\w-])|display\s*:\s*none""", re.IGNORECASE)
NAME_PART = re.compile("[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Tree:
    """Nodes in page order, so that parents come before children; node 0 is the body.

    ``tag`` is empty for a leaf, whose text is in ``text``. ``linked`` counts a leaf's characters in links.
    """

    tag: list[str] = field(default_factory=lambda: ["body"])
    parent: list[int] = field(default_factory=lambda: [-1])
    hints: list[frozenset[str]] = field(default_factory=lambda: [frozenset()])
    text: list[str] = field(default_factory=lambda: [""])
    linked: list[int] = field(default_factory=lambda: [0])

    def add(self, tag: str, parent: int, hints: frozenset[str], text: str = "", linked: int = 0) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.hints.append(hints)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1


def hints_of(attributes: str) -> frozenset[str]:
    found = set()
    if "=" in attributes:
        for value in NAMING.findall(attributes):
            for part in NAME_PART.findall("".join(value)):
                kind = HINT_OF.get(part.lower())
                if kind:
                    found.add(kind)
    if "hidden" in attributes or "none" in attributes:
        if HIDDEN.search(attributes):
            found.add("hidden")
    return frozenset(found)


class Reader:
    """Reads one page into a :class:`Tree`."""

    def __init__(self) -> None:
        self.tree = Tree()
        self.stack: list[tuple[str, int]] = []  # open elements; the node of a block, -1 for inline
        self.nodes = [0]  # open nodes
        self.open: dict[str, int] = {}
        self.parts: list[str] = []
        self.in_links: list[str] = []

    def flush(self) -> None:
        """Ends the block of text that is open."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                linked = len(" ".join("".join(self.in_links).split()))
                self.tree.add("", self.nodes[-1], frozenset(), text, linked)
            self.parts, self.in_links = [], []

    def say(self, text: str) -> None:
        if text:
            if "&" in text:
                text = html.unescape(text)
            self.parts.append(text)
            if self.open.get("a"):
                self.in_links.append(text)

    def push(self, tag: str, node: int) -> None:
        self.stack.append((tag, node))
        self.open[tag] = self.open.get(tag, 0) + 1
        if node >= 0:
            self.nodes.append(node)

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            tag, node = self.stack.pop()
            self.open[tag] -= 1
            if node >= 0:
                self.flush()
                self.nodes.pop()

    def end_open(self, tags: set[str], beyond: set[str]) -> None:
        """Ends the outermost open element of these tags that is not beyond an element of the others."""
        if not any(self.open.get(t) for t in tags):
            return
        at = None
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in tags:
                at = k
            elif tag in beyond:
                break
        if at is not None:
            self.pop_to(at)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.say(" ")
            return
        hints = hints_of(attributes) if attributes else frozenset()
        block = tag in BLOCKS
        if block:
            self.flush()
            if self.open.get("p"):
                self.end_open({"p"}, PARAGRAPH_SCOPE)
            if tag in ENDS:
                self.end_open(*ENDS[tag])
            elif tag in HEADINGS and self.stack and self.stack[-1][0] in HEADINGS:
                self.pop_to(len(self.stack) - 1)
        elif tag == "a" and self.open.get("a"):
            self.end("a")
        if tag in VOID or tag in IGNORED:
            return
        own = block or bool(hints - {"main"})
        if own:
            self.flush()
            if tag in TAG_HINTS:
                hints = hints | {TAG_HINTS[tag]}
            self.push(tag, self.tree.add(tag, self.nodes[-1], hints))
        else:
            self.push(tag, -1)

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if not self.open.get(tag):
            return
        block = tag in BLOCKS
        for k in range(len(self.stack) - 1, -1, -1):
            name, node = self.stack[k]
            if name == tag:
                self.pop_to(k)
                return
            if not block and name in BLOCKS:
                return  # an inline element that a block has cut in two

    def read(self, page: str) -> Tree:
        at, size = 0, len(page)
        while at < size:
            found = TOKEN.search(page, at)
            if found is None:
                self.say(page[at:])
                break
            if found.start() > at:
                self.say(page[at : found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                self.end(tag)
            elif tag in RAW or tag in PASSED:
                at = self.after(page, at, tag)
            else:
                self.start(tag, found[3])
        self.flush()
        self.pop_to(0)
        return self.tree

    @staticmethod
    def after(page: str, at: int, tag: str) -> int:
        """Where a passed-over element ends; one that is never closed holds the rest of the page."""
        depth = 1
        for found in re.compile(rf"<(/?){tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).finditer(page, at):
            depth += -1 if found[1] else (0 if tag in RAW else 1)
            if not depth:
                return found.end()
        return len(page)


def tree_of(page: str | None) -> Tree:
    return Reader().read(page or "")

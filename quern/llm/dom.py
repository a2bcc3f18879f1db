"""A page's markup as a small tree of block elements and text blocks.

Inline elements do not split a text; scripts, styles, comments and other contents that no reader sees never become text. End
tags may be missing, as in most pages: a block ends an open paragraph, a list item the one before it, and so on.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Kinds of elements, after the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe noembed noframes xmp svg math object canvas select".split())
BLOCKS = set(
    "address article aside blockquote button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup ins legend li main menu nav ol optgroup option p pre search section summary table tbody tfoot "
    "thead tr ul".split()
)
IGNORED = set("html head body".split())
#: What a start tag ends, if it is open before one of the tags that bound the search.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table"}),
    "option": ({"option"}, {"optgroup"}),
}
#: Tags whose borders are spaces of the text around them.
SPACES = set("br td th img hr input wbr".split()) - {"wbr"}

MARK = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
REST = re.compile(r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""")
COMMENT_END = re.compile(r"--!?>")
NAMED = re.compile(r"""(?:^|[\s"'/])(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""(?:^|[\s"'/])hidden(?:[\s=/>]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
WORD = re.compile(r"[A-Z]*[a-z]+|[A-Z]+")


@dataclass
class Node:
    """An element (with its tag and attributes as written) or, with tag None, a text block (with its text).

    `size` is the number of characters of text in it and below it, `titled` whether there is a first heading in it.
    """

    parent: int
    depth: int
    tag: str | None
    attributes: str = ""
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""
    size: int = 0
    titled: bool = False


def _finished(nodes: list[Node]) -> list[Node]:
    for node in reversed(nodes):
        if node.tag is None:
            node.text = " ".join("".join(node.pieces).split())
            node.size, node.pieces = len(node.text), []
        if node.depth:
            above = nodes[node.parent]
            above.size += node.size
            above.titled = above.titled or node.titled or node.tag == "h1"
    return nodes


def name_tokens(attributes: str) -> set[str]:
    """Lower-case words of an element's class, id, role and itemprop, without a plural's s."""
    found = set()
    for groups in NAMED.findall(attributes) if "=" in attributes else ():
        for word in WORD.findall("".join(groups)):
            word = word.lower()
            if len(word) > 1:
                found.add(word[:-1] if len(word) > 3 and word.endswith("s") and not word.endswith("ss") else word)
    if attributes and HIDDEN.search(attributes):
        found.add("hidden")
    return found


class _Builder:
    def __init__(self) -> None:
        self.nodes = [Node(-1, 0, "")]
        self.stack = [0]
        self.open: dict[str, int] = {}
        self.block: Node | None = None
        self.links = 0

    def close_to(self, size: int) -> None:
        for at in self.stack[size:]:
            self.open[self.nodes[at].tag] -= 1
        del self.stack[size:]

    def find(self, tags: set[str], bounds: set[str]) -> int | None:
        """Place in the stack of the nearest open element of one of the tags, not looking past the bounds."""
        if not any(self.open.get(t) for t in tags):
            return None
        for place in range(len(self.stack) - 1, 0, -1):
            tag = self.nodes[self.stack[place]].tag
            if tag in tags:
                return place
            if tag in bounds:
                return None
        return None

    def start(self, tag: str, attributes: str) -> None:
        self.block, self.links = None, 0
        if tag in ENDS and (place := self.find(*ENDS[tag])) is not None:
            self.close_to(place)
        elif self.nodes[self.stack[-1]].tag == "p" or (tag[0] == "h" and tag[1:].isdigit() and self.nodes[self.stack[-1]].tag == tag):
            self.close_to(len(self.stack) - 1)
        self.nodes.append(Node(self.stack[-1], len(self.stack), tag, attributes))
        self.stack.append(len(self.nodes) - 1)
        self.open[tag] = self.open.get(tag, 0) + 1

    def end(self, tag: str) -> None:
        self.block, self.links = None, 0
        if self.open.get(tag):
            place = len(self.stack) - 1
            while self.nodes[self.stack[place]].tag != tag:
                place -= 1
            self.close_to(place)

    def say(self, text: str) -> None:
        if self.block is None:
            if text.isspace():
                return
            self.block = Node(self.stack[-1], len(self.stack), None)
            self.nodes.append(self.block)
        self.block.pieces.append(text)
        if self.links:
            self.block.linked += len(text.strip())


def parse(page: str) -> list[Node]:
    """The nodes of a page, parents before children and text blocks in page order; the first is the page itself.

    Any text is taken: what is not markup is text, an unfinished tag at the end is dropped, and an unfinished script or
    comment reaches to the end. Time grows with the length of the page.
    """
    tree, at, quoted = _Builder(), 0, True
    while True:
        found = MARK.search(page, at)
        if at < (end := found.start() if found else len(page)):
            text = page[at:end]
            tree.say(html.unescape(text) if "&" in text else text)
        if not found:
            return _finished(tree.nodes)
        at = found.end()
        if found[0] == "<!--":
            # `<!-->` and `<!--->` are whole comments.
            stop = COMMENT_END.search(page, max(at - 2, 0))
            at = stop.end() if stop else len(page)
            continue
        if found[0] in ("<!", "<?"):
            stop = page.find(">", at)
            at = stop + 1 if stop >= 0 else len(page)
            continue
        name = NAME.match(page, found.start() + 1)
        closing, tag = found[0][1] == "/", name[1].lower()
        stop = REST.match(page, name.end()) if quoted else None
        if stop:
            end = stop.end()
        else:
            # A quote without an end: from here on a tag goes to the next `>`.
            quoted = False
            end = page.find(">", name.end()) + 1
            if not end:
                return _finished(tree.nodes)
        attributes, at = page[name.end() : end - 1], end
        if tag in RAW and not closing and not attributes.endswith("/"):
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if not stop:
                return _finished(tree.nodes)
            at = page.find(">", stop.end()) + 1 or len(page)
        elif tag in BLOCKS:
            tree.end(tag) if closing else tree.start(tag, attributes)
        elif tag == "a":
            tree.links = 0 if closing else 1
        elif tag in SPACES and tree.block is not None:
            tree.say(" ")

"""A small forgiving HTML tree: block elements with their text, in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element groups (fixed values of the HTML language).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg object select option button".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
               "hr main menu nav ol p pre section table ul".split())
ITEMS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"),
         "td": ("tr",), "th": ("tr",)}
SCOPE = set("article aside body div section main table td th li ul ol dl form fieldset nav header footer blockquote figure".split())

#: Without an end tag these hide the rest of a page, as in browsers (fixed values).
SCRIPTS = {"script", "style"}

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"[>\"']")
_ATTR = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Tags:
    """Tags of a page from left to right, in one pass.

    What was not found behind one place (a closing quote, an end tag) is not
    looked for again behind a later one, so the time is linear in the page.
    """

    def __init__(self, source: str):
        self.source, self.last = source, source.rfind(">")
        self.none: set[str] = set()

    def _find(self, what: str, at: int) -> int:
        """Place of a quote at or behind ``at``, -1 if there is none."""
        if what in self.none:
            return -1
        k = self.source.find(what, at)
        if k < 0:
            self.none.add(what)
        return k

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag; comments and
        declarations have no name.  A ``<`` that opens nothing is text."""
        source = self.source
        while (k := source.find("<", at)) >= 0:
            if source.startswith("<!--", k):
                end = source.find("-->", k + 4)
                return k, (end + 3 if end >= 0 else len(source)), "", "", ""
            if k > self.last:
                return None
            if source[k + 1:k + 2] in ("!", "?"):
                return k, source.index(">", k) + 1, "", "", ""
            m = _NAME.match(source, k)
            if m:
                end = self._end(m.end())
                return k, end + 1, m[1], m[2].lower(), source[m.end():end]
            at = k + 1
        return None

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag: not inside quotes, unless one is left open."""
        first = self.source.index(">", at)
        while m := _STOP.search(self.source, at):
            if m[0] == ">":
                return m.start()
            close = self._find(m[0], m.end())
            if close < 0 or close > self.last:
                return first
            at = close + 1
        return first

    def end_tag(self, name: str, at: int) -> int | None:
        """Place behind the next end tag of ``name``."""
        if name in self.none:
            return None
        m = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(self.source, at)
        if m is None:
            self.none.add(name)
            return None
        return m.end()


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    tokens: list[str] = field(default_factory=list)
    parts: list = field(default_factory=list)  # texts, and numbers of child blocks
    links: int = 0  # characters of its own text inside links
    marks: int = 0  # inline tags in its own text
    fields: int = 0  # form controls

    def children(self) -> list[int]:
        return [p for p in self.parts if isinstance(p, int)]


def parse(source: str) -> list[Node]:
    """Block elements of a page; node 0 is the page itself."""
    nodes = [Node("body", -1, 0)]
    open_ = [0]
    stack: list[tuple[str, bool]] = [("body", True)]  # open elements, and whether they are blocks
    in_link = 0
    at, n = 0, len(source)

    def text(raw: str) -> None:
        if raw:
            t = html.unescape(raw)
            node = nodes[open_[-1]]
            node.parts.append(t)
            if in_link:
                node.links += len(t.strip())

    def pop_until(depth: int) -> None:
        nonlocal in_link
        while len(stack) > depth:
            name, block = stack.pop()
            if block:
                open_.pop()
            elif name == "a":
                in_link = max(0, in_link - 1)

    tags = Tags(source)
    while at < n:
        m = tags.next(at)
        if m is None:
            text(source[at:])
            break
        start, end, slash, name, attributes = m
        text(source[at:start])
        at = end
        if not name:
            continue
        if slash:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    pop_until(k)
                    break
                if stack[k][0] in SCOPE and name in INLINE:
                    break
            continue
        if name in RAW:
            nodes[open_[-1]].fields += name in ("textarea", "select", "button")
            if attributes.rstrip().endswith("/"):
                continue
            end = None if name == "option" else tags.end_tag(name, at)
            if end is None and name not in SCRIPTS:
                # No end tag (an option needs none): only its own text goes.
                end = source.find("<", at)
            at = end if end is not None and end >= 0 else n
            continue
        if name in ("html", "body", "head"):
            continue
        if name in VOID:
            node = nodes[open_[-1]]
            node.fields += name == "input"
            if name in ("br", "hr", "wbr") and name != "wbr":
                node.parts.append(" ")
            node.marks += 1
            continue
        if name in CLOSES_P:
            _close(stack, {"p"}, SCOPE, pop_until)
        if name in ITEMS:
            _close(stack, {"li"} if name == "li" else {"dt", "dd"} if name in ("dt", "dd") else {"td", "th"} if name in ("td", "th") else {"tr"},
                   set(ITEMS[name]), pop_until)
        block = name not in INLINE
        stack.append((name, block))
        if block:
            parent = open_[-1]
            tokens = [t.lower() for v in _ATTR.findall(attributes) for t in _PART.findall(v)] if "=" in attributes else []
            nodes.append(Node(name, parent, nodes[parent].depth + 1, tokens))
            nodes[parent].parts.append(len(nodes) - 1)
            open_.append(len(nodes) - 1)
        else:
            nodes[open_[-1]].marks += 1
            in_link += name == "a"
    return nodes


def _close(stack: list, names: set[str], scope: set[str], pop_until) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k][0] in names:
            pop_until(k)
            return
        if stack[k][0] in scope:
            return


def runs(node: Node) -> list[str]:
    """The node's own text, cut where child blocks stand; white space as one space."""
    out, run = [], []
    for p in [*node.parts, 0]:
        if isinstance(p, int):
            t = _SPACE.sub(" ", "".join(run)).strip()
            out.append(t)
            run = []
        else:
            run.append(p)
    return out


def collect(nodes: list[Node], keep: list[bool]) -> str:
    """Text of the kept nodes in page order, blocks joined by one space."""
    out: list[str] = []
    todo: list = [0]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        own, kids = runs(nodes[x]), nodes[x].children()
        if not keep[x]:
            own = [""] * len(own)
        for k in range(len(own) - 1, -1, -1):
            if k < len(kids):
                todo.append(kids[k])
            if own[k]:
                todo.append(own[k])
    return " ".join(out)

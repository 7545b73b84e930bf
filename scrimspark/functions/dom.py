"""A light tree of a page and the few selectors that record extraction needs.

A page's elements are numbered in document order, and listed by tag, class and id while the tree is built, so a selector
looks only at elements that can fit. Plain markup (quoted attributes; no comments, scripts or other text that isn't markup)
is read piece by piece, with what a tag says remembered between pages; any other page goes through HTMLParser as a whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
STEP = re.compile(r"(?P<tag>[a-zA-Z][\w-]*)?(?P<rest>(?:[.#][\w-]+|\[[^\]]+\])*)")
PART = re.compile(r"\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:(?P<op>\^?=)'?(?P<value>[^'\]]*)'?)?\]")


class Page:
    """The elements of a page in document order, and their numbers by tag, ".class" and "#id"."""

    __slots__ = ("index", "nodes")

    def __init__(self):
        self.nodes: list[Node] = []
        self.index: dict[str, list[int]] = defaultdict(list)


class Node:
    """An element; those below it have the numbers from ``at`` + 1 up to ``end``, which is set when it is closed."""

    __slots__ = ("at", "attrs", "children", "classes", "end", "page", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], classes: frozenset[str], parent: Node | None, page: Page):
        self.tag, self.attrs, self.classes, self.parent, self.page, self.children = tag, attrs, classes, parent, page, []
        self.at = self.end = len(page.nodes)
        page.nodes.append(self)

    def walk(self) -> list[Node]:
        """All elements below, in document order."""
        return self.page.nodes[self.at + 1 : self.end]

    def _among(self, key: str | None) -> list[Node]:
        """The elements below that are listed under a key."""
        if key is None:
            return self.walk()
        listed = self.page.index.get(key)
        if not listed:
            return []
        nodes = self.page.nodes
        return [nodes[i] for i in listed[bisect_left(listed, self.at + 1) : bisect_left(listed, self.end)]]

    def select(self, selector: str) -> list[Node]:
        chains = _parsed(selector)
        if len(chains) == 1:
            key, chain = chains[0]
            return [n for n in self._among(key) if _fits(n, chain, self)]
        return [n for n in self.walk() if any(_fits(n, chain, self) for _, chain in chains)]

    def first(self, selector: str) -> Node | None:
        chains = _parsed(selector)
        if len(chains) == 1:
            key, chain = chains[0]
            return next((n for n in self._among(key) if _fits(n, chain, self)), None)
        return next((n for n in self.walk() if any(_fits(n, chain, self) for _, chain in chains)), None)

    def text(self, joint: str = "", strip: bool = True) -> str:
        """The strings below, each stripped if asked for (empty ones left out), joined."""
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children[0].strip() if strip else self.children[0]
        out, waiting = [], list(reversed(self.children))
        while waiting:
            c = waiting.pop()
            if isinstance(c, Node):
                waiting.extend(reversed(c.children))
            elif not strip:
                out.append(c)
            elif c.strip():
                out.append(c.strip())
        return joint.join(out)


@lru_cache(maxsize=1024)
def _parsed(selector: str) -> list[tuple[str | None, list[tuple]]]:
    """For each alternative: the key that lists all elements that can fit, if there is one, and the steps from the last to
    the first: (how the step before it relates, tag, classes, ids, other conditions)."""
    out = []
    for one in selector.split(","):
        steps, joint = [], " "
        for token in one.replace(">", " > ").split():
            if token == ">":
                joint = ">"
                continue
            m = STEP.fullmatch(token)
            if not m:
                raise ValueError(f"unknown selector: {selector}")
            parts = list(PART.finditer(m["rest"]))
            classes = frozenset(p["cls"] for p in parts if p["cls"])
            ids = [p["id"] or p["value"] for p in parts if p["id"] or p["attr"] == "id" and p["op"] == "="]
            others = [(p["attr"], p["op"], p["value"]) for p in parts if p["attr"] and not (p["attr"] == "id" and p["op"] == "=")]
            steps.append((joint, m["tag"], classes, ids, others))
            joint = " "
        _, tag, classes, ids, _ = steps[-1]
        out.append((f"#{ids[0]}" if ids else f".{min(classes)}" if classes else tag, steps[::-1]))
    return out


def _fits(node: Node, chain: list[tuple], top: Node) -> bool:
    joint, tag, classes, ids, others = chain[0]
    if tag and node.tag != tag or not classes <= node.classes:
        return False
    for i in ids:
        if node.attrs.get("id") != i:
            return False
    for name, op, wanted in others:
        value = node.attrs.get(name)
        if value is None or op == "=" and value != wanted or op == "^=" and not value.startswith(wanted):
            return False
    if len(chain) == 1:
        return joint == " " or node.parent is top
    up = node.parent
    while up is not None:
        if _fits(up, chain[1:], top):
            return True
        if joint == ">":
            return False
        up = up.parent
    return False


def _keys(tag: str, attrs: dict[str, str]) -> tuple[frozenset[str], tuple[str, ...]]:
    """(classes, the keys under which an element is listed)."""
    classes = frozenset(attrs.get("class", "").split())
    return classes, (tag, *[f".{c}" for c in classes], *([f"#{attrs['id']}"] if "id" in attrs else []))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.root = self.at = Node("", {}, frozenset(), None, self.page)

    def handle_starttag(self, tag, attrs):
        found = {k: v or "" for k, v in reversed(attrs)}
        classes, keys = _keys(tag, found)
        node = Node(tag, found, classes, self.at, self.page)
        for k in keys:
            self.page.index[k].append(node.at)
        self.at.children.append(node)
        node.end = node.at + 1
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        self.at = _closed(self.at, tag)

    def handle_data(self, data):
        self.at.children.append(data)


def _closed(at: Node, tag: str) -> Node:
    """Where text goes on after an end tag: it closes the innermost element of its name with all in it, or none."""
    node = at
    while node.parent is not None and node.tag != tag:
        node = node.parent
    if node.parent is None:
        return at
    end = len(node.page.nodes)
    while at is not node:
        at.end = end
        at = at.parent
    node.end = end
    return node.parent


def _ended(at: Node) -> Node:
    """The root, once all that is still open is closed."""
    end = len(at.page.nodes)
    while True:
        at.end = end
        if at.parent is None:
            return at
        at = at.parent


# Elements whose content HTMLParser (of one Python or another) doesn't read as markup.
RAW = frozenset("iframe noembed noframes noscript plaintext script style textarea title xmp".split())
START = re.compile(r"""([a-zA-Z][a-zA-Z0-9-]*)((?:[ \t\r\n\f]+[a-zA-Z][a-zA-Z0-9_-]*="[^"]*")*)[ \t\r\n\f]*(/?)""")
END = re.compile(r"/([a-zA-Z][a-zA-Z0-9-]*)[ \t\r\n\f]*")
ATTRIBUTE = re.compile(r"""([a-zA-Z][a-zA-Z0-9_-]*)="([^"]*)\"""")


@lru_cache(maxsize=1 << 13)
def _tag(head: str) -> tuple | None:
    """What stands between < and >: (name,) of an end tag, (name, attributes, classes, keys, whether it can hold anything)
    of a start tag, None where it isn't plain."""
    if m := END.fullmatch(head):
        return (m[1].lower(),)
    m = START.fullmatch(head)
    if not m or m[1].lower() in RAW or "&" in head:
        return None
    tag = m[1].lower()
    attrs = {k.lower(): v for k, v in reversed(ATTRIBUTE.findall(m[2]))}
    classes, keys = _keys(tag, attrs)
    return tag, attrs, classes, keys, tag not in VOID and not m[3]


def _plain(html: str) -> Node | None:
    """The tree of a page of plain markup; None for any other."""
    before, *pieces = html.split("<")
    page = Page()
    index = page.index
    at = root = Node("", {}, frozenset(), None, page)
    if before:
        root.children.append(unescape(before))
    for piece in pieces:
        head, closed, text = piece.partition(">")
        found = _tag(head) if closed else None
        if found is None:
            return None
        if len(found) == 1:
            if at.tag == found[0] and at.parent is not None:
                at.end = len(page.nodes)
                at = at.parent
            else:
                at = _closed(at, found[0])
        else:
            tag, attrs, classes, keys, holds = found
            node = Node(tag, attrs, classes, at, page)
            at.children.append(node)
            for k in keys:
                index[k].append(node.at)
            if holds:
                at = node
            else:
                node.end += 1
        if text:
            at.children.append(unescape(text) if "&" in text else text)
    return _ended(at)


def parse(html: str | None, references: bool = True) -> Node:
    """The tree of a page. Without ``references`` the strings (but those of scripts and styles) hold them as written."""
    html = html or ""
    if not references:
        html = html.replace("&", "&amp;")
    plain = _plain(html)
    if plain is not None:
        return plain
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return _ended(builder.at)

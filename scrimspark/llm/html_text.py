"""Operator 8: HTML extraction by layout-aware rendering.

A tree builder reads the tags, opens and closes what HTML lets authors leave out, and hands each element's start and end to
a renderer. Visibility rules leave out what a reader wouldn't see; everything else that is text is emitted: blocks on
lines of their own, paragraphs and the like with an empty line around them, list items with bullets or numbers and
indents, table cells in aligned columns (also where they span several or reach down over rows), preformatted text as it
is. Neither part recurses, so nesting may be any depth. Hidden visibility can be undone by an element inside, no display
can't.

Padding is bounded: lines wider than WIDEST don't widen their column, and a table that would be more than PADDED times as
long as the text in it is emitted without alignment.

Nulls, ties, empty input: a null or empty page gives an empty text; a very long page is one row and rendered whole; broken
markup never fails, it is read the way browsers recover from it; repeated rows give repeated rows; an empty table gives an
empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

TAG = re.compile(
    r"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|/[^a-zA-Z>][^>]*(?:>|\Z)|/>"
    r"|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>)",
    re.S,
)
ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
SPACE = " \t\n\r\f"
WORDS = re.compile("[^ \\t\\n\\r\\f]+")

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style title template noscript iframe noembed noframes object audio video canvas svg math datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure fieldset hr xmp listing plaintext".split())
BLOCK = SPACED | frozenset("html body div article section nav aside header footer main address form li dt dd tr td th caption thead tbody tfoot legend details summary figcaption center dialog hgroup search optgroup option".split())
#: A start tag of these closes an open p.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p plaintext pre search section summary table ul dd dt".split())
#: name: (elements that its start closes, elements that stop the search for them)
SIBLINGS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup", "tr"]), frozenset(["table"])),
    "tbody": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup", "tr"]), frozenset(["table"])),
    "tfoot": (frozenset(["thead", "tbody", "tfoot", "caption", "colgroup", "tr"]), frozenset(["table"])),
}
#: What may stand in head; anything else opens the body.
IN_HEAD = frozenset("head base link meta title style script noscript template html".split())
CELLS = frozenset(["td", "th"])
#: End tags don't reach over these.
WALLS = CELLS | {"table", "caption"}


class Flow:
    """Text of one flow of blocks: collapses white space and keeps the breaks that blocks ask for."""

    def __init__(self):
        self.out: list[str] = []
        self.breaks, self.space, self.indents = 0, False, []
        self.markers: list[tuple[int, str]] = []  # of items that have no line yet, with the place of their indent

    def block(self, breaks: int) -> None:
        self.breaks, self.space = max(self.breaks, breaks), False

    def _begin(self) -> None:
        if self.breaks or not self.out:
            if self.out:
                self.out.append("\n" * self.breaks)
            indents = list(self.indents)
            for at, marker in self.markers:
                indents[at] = marker
            self.out.append("".join(indents))
            self.breaks, self.space, self.markers = 0, False, []
        elif self.space:
            self.out.append(" ")
            self.space = False

    def text(self, text: str) -> None:
        if text.strip(SPACE):
            if text[0] in SPACE:
                self.space = True
            self._begin()
            self.out.append(" ".join(WORDS.findall(text)))
            self.space = text[-1] in SPACE
        elif text:
            self.space = True

    def lines(self, lines: list[str]) -> None:
        """Lines as they are, each with the indent."""
        for i, line in enumerate(lines):
            if i:
                self.breaks += 1
            if line:
                self.space = False
                self._begin()
                self.out.append(line)

    def result(self) -> str:
        return "".join(self.out)


#: Longest line of a cell that its column is widened for.
WIDEST = 160
#: Most characters of an aligned table for each character of the text in it.
PADDED = 16
#: Most columns and rows that a cell may span (the standard's own limits).
COLSPAN, ROWSPAN = 1000, 65534


class Grid:
    """A table's rows of cells (lines, first column, column after the last)."""

    def __init__(self):
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.reaching: list[tuple[int, int, int]] = []  # columns from, to, of cells of earlier rows, and the last row
        self.at = 0

    def row(self) -> None:
        self.rows.append([])
        self.at, before, self.reaching = 0, self.reaching, []
        for first, after, last in sorted(r for r in before if r[2] >= len(self.rows)):
            if self.reaching and self.reaching[-1][1:] == (first, last):
                first = self.reaching.pop()[0]
            self.reaching.append((first, after, last))

    def end_rows(self) -> None:
        """A group of rows is over; cells don't reach into the next."""
        self.reaching = []

    def cell(self, text: str, span: int, down: int) -> None:
        if not self.rows:
            self.row()
        for first, after, _ in self.reaching:
            if first <= self.at < after:
                self.at = after
        self.rows[-1].append((text.split("\n"), self.at, self.at + span))
        if down != 1:
            self.reaching.append((self.at, self.at + span, len(self.rows) - 1 + (down or ROWSPAN)))
        self.at += span

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if any(x for c, _, _ in r for x in c)]
        # columns that no cell begins at only widen the one before
        begins = sorted({first for r in rows for _, first, _ in r})
        rows = [[(c, bisect_left(begins, first), bisect_left(begins, after)) for c, first, after in r] for r in rows]
        widths = [0] * len(begins)
        for row in rows:
            for cell, first, after in row:
                if after == first + 1:
                    widths[first] = max(widths[first], max((n for n in map(len, cell) if n <= WIDEST), default=0))
        edges = [0]
        for w in widths:
            edges.append(edges[-1] + w + 2)
        size = visible = 0
        for row in rows:
            last, first, _ = max((x for x in row if any(x[0])), key=lambda x: x[1])
            size += max(len(c) for c, _, _ in row) * (edges[first] + max(map(len, last)))
            visible += sum(len(x) - x.count(" ") for c, _, _ in row for x in c)
        out = []
        for row in rows:
            if size > PADDED * visible:
                cells = [[x for x in c if x] for c, _, _ in row if any(c)]
                out += ["  ".join(c[0] for c in cells)] if all(len(c) == 1 for c in cells) else [x for c in cells for x in c]
                continue
            for i in range(max(len(c) for c, _, _ in row)):
                line = ""
                for cell, first, _ in row:
                    if i < len(cell) and cell[i]:
                        line = (line + "  " * bool(line)).ljust(edges[first]) + cell[i]
                out.append(line.rstrip())
        return out


#: Width, in pixels, of the window that pages are laid out for.
WIDTH = 1280
#: Rules with these apply only while a reader does something, or to text that isn't in the page.
NOT_AT_REST = re.compile(r":(?:hover|focus|active|:?before|:?after|:)", re.I)


def applies(media: str) -> bool | None:
    """Whether a media query list holds on a screen of WIDTH; None if that isn't known."""
    found: list[bool | None] = []
    for q in media.lower().split(","):
        kind, *rest = re.split(r"\s+and\s+", re.sub(r"^only\s+", "", q.strip()))
        parts = [kind, *rest]
        holds: bool | None = True
        for part in parts:
            width = re.fullmatch(r"\(\s*(min|max)-width\s*:\s*([\d.]+)(px|em|rem)\s*\)", part)
            if part in ("", "all", "screen"):
                continue
            if part in ("print", "speech", "tty", "tv", "projection", "handheld", "braille", "embossed", "aural"):
                holds = False
            elif width and width[2].replace(".", "", 1).isdigit():
                size = float(width[2]) * (1 if width[3] == "px" else 16)
                if size > WIDTH if width[1] == "min" else size < WIDTH:
                    holds = False
            elif holds:
                holds = None
        found.append(holds)
    return True if True in found else None if None in found else False


def rules(css: str, state: bool | None = True) -> Iterator[tuple[str, str, bool | None]]:
    """(selectors, declarations, whether it is known to apply) of the rules that may apply."""
    css = re.sub(r"(?s)/\*.*?(?:\*/|\Z)", "", css)
    css = re.sub(r""" "(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*' """.strip(), '""', css)
    open_: list[tuple[str, bool | None, list[str]]] = []
    at = 0
    for m in re.finditer("[{};]", css):
        piece, at = css[at : m.start()].strip(), m.end()
        if m[0] != "{":
            if open_:
                open_[-1][2].append(piece)
                if m[0] == "}":
                    head, holds, body = open_.pop()
                    if holds is not False and not head.startswith("@"):
                        yield head, ";".join(body), holds
            continue
        outer = open_[-1][1] if open_ else state
        own: bool | None = True
        if piece.lower().startswith("@media"):
            own = applies(piece[6:])
        elif re.match(r"(?i)@(?:supports|layer|container|scope)", piece) or open_ and not open_[-1][0].startswith("@"):
            own = None
        elif piece.startswith("@"):
            own = False
        open_.append((piece, False if outer is False or own is False else None if outer is None or own is None else True, []))


def declared(style: str) -> Iterator[tuple[str, bool, bool]]:
    """(property, whether it hides, whether it is important) of the declarations that decide on visibility."""
    for name, value in re.findall(r"(?i)(?:^|;)\s*(display|visibility)\s*:\s*([^;]*)", style):
        words = re.findall(r"[\w-]+", value.lower())
        if words and not (name.lower() == "visibility" and words[0] in ("inherit", "unset", "revert")):
            yield name.lower(), words[0] == "none" if name.lower() == "display" else words[0] in ("hidden", "collapse"), "important" in words[1:]


def compound(selector: str) -> tuple[str, set[str], set[str]]:
    """(tag, classes, ids) of a compound selector."""
    return re.match(r"[\w-]*", selector)[0].lower(), set(re.findall(r"\.([\w-]+)", selector)), set(re.findall(r"#([\w-]+)", selector))


class Sheet:
    """What a page's style sheets hide: by selectors of a tag, classes and ids, unless a rule that comes later in the
    cascade shows the element. Of a rule that shows, only the last compound is compared; in doubt, text is emitted."""

    def __init__(self, html: str):
        self.hidden: dict[str, list[tuple]] = {}
        self.shown: dict[str, list[tuple]] = {"display": [], "visibility": []}
        order = 0
        for attrs, css in re.findall(r"(?is)<style([^>]*)>(.*?)</style", html):
            media = re.search(r"""(?i)\bmedia\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", attrs)
            for selectors, body, known in rules(css, applies(unescape(media[1] or media[2] or media[3] or "")) if media else True):
                order += 1
                for prop, hide, important in declared(body):
                    for one in map(str.strip, re.sub(r"\([^()]*\)", "()", selectors).split(",")):
                        if hide and (not known or not re.fullmatch(r"[\w-]*(?:[.#][\w-]+)*", one) or not one) or not hide and NOT_AT_REST.search(one):
                            continue
                        rank = (important, (9,) if "()" in one or not known else (one.count("#"), len(re.findall(r"[.:\[]", one)), len(re.findall(r"(?:^|[\s>+~])[\w-]", one))), order)
                        if hide:
                            tag, classes, ids = compound(one)
                            key = "#" + min(ids) if ids else "." + min(classes) if classes else tag
                            self.hidden.setdefault(key, []).append((prop, rank, tag, classes, ids))
                        else:
                            last = re.split(r"[\s>+~]+(?![^\[]*\])", one)[-1]
                            self.shown[prop].append((prop, rank, *compound(re.sub(r"\[[^\]]*\]|:[\w-]+(?:\(\))?", "", last))))

    def verdict(self, name: str, values: dict) -> dict[str, tuple[bool, bool]]:
        """For display and visibility, where a rule decides: (whether it hides, whether it is important)."""
        classes, key = set(values.get("class", "").split()), values.get("id", "")

        def matching(found) -> dict:
            best: dict = {}
            for prop, rank, tag, c, i in found:
                if tag in ("", name) and c <= classes and i <= {key} and (prop not in best or rank > best[prop]):
                    best[prop] = rank
            return best

        against = matching(x for s in (name, f"#{key}", *[f".{c}" for c in classes]) for x in self.hidden.get(s, ()))
        shown = matching(self.shown["visibility"])
        if "display" in against or "style" in values:
            shown |= matching(self.shown["display"])
        return {p: (p not in shown or against[p] > shown[p], against[p][0]) if p in against else (False, shown[p][0]) for p in against | shown}


def styled(name: str, values: dict, sheet: Sheet | None) -> dict[str, bool]:
    """For display and visibility, where style decides: whether it hides."""
    found = sheet.verdict(name, values) if sheet else {}
    for prop, hide, important in declared(unescape(values.get("style", ""))):
        if prop not in found or important >= found[prop][1]:
            found[prop] = hide, important
    return {p: hide for p, (hide, _) in found.items()}


class Page:
    """Builds the tree as a stack of open elements and renders on the way."""

    def __init__(self, html: str):
        self.html, self.sheet = html, Sheet(html) if "<style" in html.lower() else None
        self.stack: list[tuple[str, bool, bool, object]] = []  # name, hidden with all in it, invisible before, state
        self.flows, self.grids, self.lists = [Flow()], [], []
        self.unseen = self.pre = 0
        self.invisible = False
        self.open: Counter[str] = Counter()
        self.body = False

    def render(self) -> str:
        html, at = self.html, 0
        while at < len(html):
            lt = html.find("<", at)
            if lt < 0:
                self.text(html[at:])
                break
            m = TAG.match(html, lt)
            if not m:
                if re.match(r"</?[a-zA-Z]", html[lt : lt + 3]) and html.find(">", lt) < 0:
                    self.text(html[at:lt])  # the file ends inside a tag
                    break
                self.text(html[at : lt + 1])
                at = lt + 1
                continue
            if lt > at:
                self.text(html[at:lt])
            at = m.end()
            name = (m["name"] or "").lower()
            if m["cdata"] is not None and any(x[0] in ("svg", "math") for x in self.stack):
                self.text(m["cdata"], raw=True)
            elif name and m["close"]:
                self.end(name)
            elif name:
                self.start(name, m["attrs"])
                if name == "plaintext":  # nothing ends it
                    self.text(html[at:], raw=True)
                    break
                if name in RAW:
                    close = re.compile(f"(?i)</{name}(?=[\\s/>])").search(html, at)
                    stop = close.start() if close else len(html)
                    self.text(html[at:stop], raw=name not in ("textarea", "title"))
                    at = html.find(">", stop) + 1 if close else stop
                    at = at or len(html)
                    self.end(name)
        while self.stack:
            self._pop()
        return self.flows[0].result()

    def text(self, text: str, raw: bool = False) -> None:
        if self.unseen or not text or self.invisible:
            return
        if not self.body and not self.stack_has("head", ()) and text.strip(SPACE):
            self.body = True
        if "&" in text and not raw:
            text = unescape(text)
        flow = self.flows[-1]
        if self.pre:
            flow.lines(text.replace("\r\n", "\n").replace("\r", "\n").split("\n"))
        else:
            flow.text(text)

    def stack_has(self, name: str, walls) -> bool:
        if not self.open[name]:
            return False
        for entry in reversed(self.stack):
            if entry[0] == name:
                return True
            if entry[0] in walls:
                return False
        return False

    def start(self, name: str, attrs: str) -> None:
        if name in ("html", "body"):
            self.body |= name == "body"
            if name == "body":
                self._close_head()
            if self.stack_has(name, ()):
                return
        elif name not in IN_HEAD:
            self._close_head()
            self.body = True
        if name in ENDS_P and self.stack_has("p", WALLS):
            self.end("p")
        if name in SIBLINGS:
            closes, walls = SIBLINGS[name]
            for i in range(len(self.stack) - 1 if any(self.open[c] for c in closes) else -1, -1, -1):
                if self.stack[i][0] in closes:
                    while len(self.stack) > i:
                        self._pop()
                elif self.stack[i][0] in walls:
                    break
        if name in CELLS and self.grids:  # a cell opens its row
            if not self.stack_has("tr", ("table",)):
                self.start("tr", "")
        if re.fullmatch("h[1-6]", name) and self.stack and re.fullmatch("h[1-6]", self.stack[-1][0]):
            self._pop()
        values = {}
        if attrs.strip(" /\t\r\n\f"):
            for k, a, b, c in ATTR.findall(attrs):
                values.setdefault(k.lower(), a or b or c)
        style = styled(name, values, self.sheet) if self.sheet or "style" in values else {}
        hidden = name in UNSEEN or "hidden" in values or style.get("display", False) or (name == "dialog" and "open" not in values)
        before, self.invisible = self.invisible, style.get("visibility", self.invisible)
        if name in VOID:
            if not self.unseen and not hidden and not self.invisible:
                self._void(name, values)
            self.invisible = before
            return
        state = None
        if not hidden and not self.unseen:
            state = self._open(name, values)
        self.unseen += hidden
        self.stack.append((name, hidden, before, state))
        self.open[name] += 1

    def _close_head(self) -> None:
        if self.stack_has("head", ("body",)):
            self.end("head")

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "")
            return
        if name == "p" and not self.stack_has("p", WALLS):
            self.start("p", "")
        walls = () if name in WALLS or name in ("tr", "tbody", "thead", "tfoot", "html", "body") else WALLS
        walls = ("table",) if name in CELLS or name in ("tr", "tbody", "thead", "tfoot", "caption") else walls
        for i in range(len(self.stack) - 1 if self.open[name] else -1, -1, -1):
            if self.stack[i][0] == name:
                while len(self.stack) > i:
                    self._pop()
                return
            if self.stack[i][0] in walls:
                return

    def _void(self, name: str, values: dict) -> None:
        flow = self.flows[-1]
        if name == "br":
            flow.breaks, flow.space = flow.breaks + 1 if flow.out else 0, False
        elif name == "hr":
            flow.block(2)
        elif name == "input" and values.get("type", "").lower() in ("submit", "button", "reset") and values.get("value"):
            flow.text(unescape(values["value"]))

    def _open(self, name: str, values: dict) -> object:
        flow = self.flows[-1]
        if name == "table":
            flow.block(2)
            self.grids.append(Grid())
            return ("table", len(self.flows))
        if name == "tr" and self.grids:
            self.grids[-1].row()
            return ("tr",)
        if name in ("thead", "tbody", "tfoot") and self.grids:
            self.grids[-1].end_rows()
        if name in CELLS and self.grids:
            self.flows.append(Flow())
            span, down = (int(v[:9]) if re.fullmatch("[0-9]+", v := values.get(k, "").strip(SPACE)) else 1 for k in ("colspan", "rowspan"))
            return ("cell", max(1, min(COLSPAN, span)), min(ROWSPAN, down))
        if name in ("ul", "ol", "menu"):
            flow.block(1 if self.lists else 2)
            start = values.get("start", "")
            self.lists.append([name == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            return ("list",)
        if name == "li":
            flow.block(1)
            ordered = self.lists[-1] if self.lists else [False, 1]
            marker = f"{ordered[1]}. " if ordered[0] else "- "
            ordered[1] += 1
            flow.markers.append((len(flow.indents), marker))
            flow.indents.append(" " * len(marker))
            return ("item",)
        if name in ("blockquote", "dd"):
            flow.block(2 if name == "blockquote" else 1)
            flow.indents.append("  ")
            return ("indent", 2 if name == "blockquote" else 1)
        if name in ("pre", "textarea", "xmp", "listing", "plaintext"):
            if name != "textarea":
                flow.block(2)
            self.pre += 1
            return ("pre", name != "textarea")
        if name in BLOCK:
            breaks = 2 if name in SPACED else 1
            flow.block(breaks)
            return ("block", breaks)
        return None

    def _pop(self) -> None:
        name, hidden, self.invisible, state = self.stack.pop()
        self.unseen -= hidden
        self.open[name] -= 1
        if not state:
            return
        kind = state[0]
        if kind == "cell":
            text = self.flows.pop().result()
            self.grids[-1].cell(text, *state[1:])
            return
        flow = self.flows[-1]
        if kind == "table":
            flow.block(2)
            flow.lines(self.grids.pop().lines())
            flow.block(2)
        elif kind == "list":
            self.lists.pop()
            flow.block(1 if self.lists else 2)
        elif kind == "item":
            flow.indents.pop()
            if flow.markers and flow.markers[-1][0] == len(flow.indents):
                flow.markers.pop()
            flow.block(1)
        elif kind == "indent":
            flow.indents.pop()
            flow.block(state[1])
        elif kind == "pre":
            self.pre -= 1
            if state[1]:
                flow.block(2)
        elif kind == "block":
            flow.block(state[1])


def render(html: str | None) -> str:
    return Page(html or "").render()


def extract(pages: DataFrame) -> DataFrame:
    """pages (html and any more) with text in place of html. Each page is a row; nothing is shuffled."""
    pages = pages.drop("text")
    schema = T.StructType([*[f for f in pages.schema.fields if f.name != "html"], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.drop(columns="html").assign(text=[render(h) for h in b["html"]])

    return pages.mapInPandas(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))

"""Operator 10, HTML extraction: layout-aware rendering.

``build`` turns markup into a tree: tags that HTML lets one leave out are
implied (a block ends a paragraph; items, rows, cells, options and terms end
their predecessors; rows and cells get the table parts around them), end tags
without a start are dropped, and what is left open is closed.  ``render`` walks
the tree and emits all visible text: white space collapses outside ``pre``;
blocks begin lines, and headings, paragraphs, lists and tables have an empty
line around them; list items have a dash or their number, indented by depth
(as deep as ``DEEPEST`` levels); the cells of a table are aligned in columns.

A table that holds other tables only lays out a page: its cells are blocks, one
below the other.  In any other table each row begins a line and each column has
its place, with column and row spans kept; lines of over ``CELL_WIDTH`` characters
are wrapped at blanks within their column, and a row is as high as its highest
cell.  Where the blanks for that would take over ``MOST_BLANKS`` times the
table's text, rows stay rows, with two blanks between cells instead.  No text is
lost in any of these.

Not visible: the head, scripts, styles, templates, fallback of embedded
objects, elements with ``hidden``, ``display: none``, ``visibility: hidden`` or
``collapse`` (until a descendant sets it to ``visible``), ``input`` and comments.

Null or empty markup gives an empty text.  Any markup gives a text: a text of
any length or depth is handled without recursion.  Rows repeat and pass through
as they are; null ids stay null; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_blocks

# Fixed values of the HTML language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style title template noscript datalist iframe object audio video canvas noembed noframes "
    "base link meta input rp".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol optgroup option p plaintext "
    "pre search section summary table caption colgroup tbody thead tfoot tr td th ul xmp".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul listing xmp".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p plaintext pre search section summary table ul dd dt "
    "xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base link meta title style script".split())
#: What a start tag ends, if open, up to the given borders.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "caption", "colgroup"), ("table",)),
    "caption": (("caption", "colgroup"), ("table",)),
}
#: End tags do not reach out of these.
FENCES = frozenset("table td th caption button".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|--!>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.S)
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility|white-space)\s*:\s*([a-z-]+)")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]+)")
_LONG_CHARACTER = re.compile(r"&#[0-9]{20,};?")


def unescape(text: str) -> str:
    """Character references resolved; numbers beyond all characters are U+FFFD."""
    return html.unescape(_LONG_CHARACTER.sub("\ufffd", text) if "&#" in text else text)


def integer(text: str | None, default: int, low: int, high: int) -> int:
    """The number that an attribute begins with, within bounds."""
    m = _INTEGER.match(text or "")
    if not m:
        return default
    if len(m[1]) > 12:
        return low if m[1][0] == "-" else high
    return min(max(int(m[1]), low), high)


@dataclass(slots=True)
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # Nodes and texts
    holds_table: bool = False


def attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(raw):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


class _Builder:
    def __init__(self) -> None:
        self.root = Node("html")
        self.open = [self.root]
        self.places: dict[str, list[int]] = {}  # of the open elements of a tag, but for the root
        self.tables: list[Node] = []
        self.in_body = False

    def push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)
        if node.tag == "table":
            if self.tables:
                self.tables[-1].holds_table = True
            self.tables.append(node)

    def pop_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.places[node.tag].pop()
            if node.tag == "table":
                self.tables.pop()
        del self.open[at:]

    def find(self, tags, fences) -> int:
        """Place of the innermost open element of these tags within fences."""
        at = self.last(tags)
        return at if at > 0 and at >= self.last(fences) else -1

    def last(self, tags) -> int:
        """Place of the innermost open element of these tags, 0 if there is none."""
        return max((held[-1] for t in tags if (held := self.places.get(t))), default=0)

    def end(self, tags, fences) -> None:
        if (at := self.find(tags, fences)) > 0:
            self.pop_to(at)

    def body(self) -> None:
        if not self.in_body:
            self.in_body = True
            self.pop_to(1)
            self.push(Node("body"))

    def text(self, text: str) -> None:
        if not self.in_body:
            if not text.strip():
                return
            self.body()
        self.open[-1].children.append(text)

    def start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            self.root.attrs = {**attrs, **self.root.attrs}
            return
        if tag == "head":
            if not self.in_body and not self.places.get("head"):
                self.push(Node("head", attrs))
            return
        if tag == "body":
            if not self.in_body:
                self.body()
                self.open[-1].attrs = attrs
            return
        if not self.in_body and tag not in HEAD_ONLY and not (tag in ("noscript", "template") and self.places.get("head")):
            self.body()
        if tag in CLOSES_P:
            self.end(("p",), FENCES)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        if tag in ENDS:
            tags, fences = ENDS[tag]
            while (at := self.find(tags, fences)) > 0:
                self.pop_to(at)
        if tag in ("td", "th") and self.places.get("table") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", {})
        if tag == "tr" and self.open[-1].tag == "table":
            self.push(Node("tbody"))
        if tag == "a":
            self.end(("a",), FENCES)
        node = Node(tag, attrs)
        if tag in VOID:
            self.open[-1].children.append(node)
        else:
            self.push(node)

    def close(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag in ("html", "body"):
            pass
        elif tag == "head":
            self.end(("head",), ())
        elif tag == "p" and self.find(("p",), FENCES) < 0:
            self.start("p", {})
            self.end(("p",), FENCES)
        elif tag in HEADINGS:
            self.end(HEADINGS, FENCES)
        elif tag in FENCES or tag in ("tr", "tbody", "thead", "tfoot"):
            self.end((tag,), ("table",) if tag != "table" else ())
        else:
            self.end((tag,), FENCES)


def build(markup: str) -> Node:
    b = _Builder()
    at, low = 0, None
    while True:
        m = _TOKEN.search(markup, at)
        text = markup[at : m.start() if m else len(markup)]
        if text:
            b.text(unescape(text))
        if not m:
            return b.root
        at = m.end()
        if m[1]:
            b.close(m[1].lower())
            continue
        if not m[2]:
            continue
        tag, raw = m[2].lower(), m[3] or ""
        b.start(tag, attributes(raw) if raw.strip(" /\t\r\n") else {})
        if tag in RAW and b.open[-1].tag == tag:
            if low is None:
                low = markup.lower()
                if len(low) != len(markup):  # a few capitals change their length
                    low = re.sub("[A-Z]", lambda c: c[0].lower(), markup)
            stop = low.find(f"</{tag}", at)
            stop = len(markup) if stop < 0 else stop
            content = markup[at:stop]
            b.open[-1].children.append(unescape(content) if tag in ("textarea", "title") else content)
            at = stop
        elif tag == "plaintext":
            b.text(markup[at:])
            return b.root


#: Levels of lists that are indented further.
DEEPEST = 40


class _Flow:
    """Lines of one column of text; ``base`` is the number of lists around it."""

    def __init__(self, base: int = 0) -> None:
        self.base = base
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = False  # a collapsed blank waits
        self.skip = 0  # empty lines that wait
        self.indent = ""
        self.mark: str | None = None  # list marker of the coming line

    def add(self, text: str, keep: bool) -> None:
        if keep:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.newline(force=True)
                self._put(line)
            return
        parts = _SPACE.split(text)
        for i, part in enumerate(parts):
            if i and self.now:
                self.gap = True
            if part:
                self._put(part)

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.now and self.mark is not None:
            self.now.append(self.mark)
            self.mark = None
        elif self.gap:
            self.now.append(" ")
        self.gap = False
        self.now.append(text)

    def newline(self, force: bool = False) -> None:
        if self.now or force:
            if self.lines and self.skip:
                self.lines.append("")
            self.skip = 0
            self.lines.append((self.indent + "".join(self.now)).rstrip())
        self.now, self.gap = [], False

    def space(self) -> None:
        self.newline()
        self.skip = 1

    def put_lines(self, lines: list[str]) -> None:
        for line in lines:
            self.now = [line]
            self.newline(force=True)

    def done(self) -> list[str]:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


#: Longest line of a cell, in characters, that is not wrapped.
CELL_WIDTH = 120
#: Padding that a table may take, as a multiple of its text (and so many more).
MOST_BLANKS, FREE_BLANKS = 16, 1 << 16
#: Fixed values of the HTML language: most columns and rows a cell may span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


@dataclass(slots=True)
class _Cell:
    columns: int
    rows: int
    lines: list[str]


@dataclass(slots=True)
class _Table:
    rows: list[list[_Cell]] = field(default_factory=list)
    captions: list[str] = field(default_factory=list)


def wrapped(line: str) -> list[str]:
    """A line in parts of at most ``CELL_WIDTH`` characters, cut at blanks; a
    longer word stays whole."""
    out, at = [], 0
    while len(line) - at > CELL_WIDTH:
        cut = line.rfind(" ", at + 1, at + CELL_WIDTH + 1)
        if cut < 0 or not line[at:cut].strip():
            cut = line.find(" ", at + CELL_WIDTH)
        if cut < 0:
            break
        out.append(line[at:cut])
        at = cut + 1
    return [*out, line[at:]]


def _places(rows: list[list[_Cell]]) -> list[list[tuple[int, _Cell]]]:
    """Each row's cells with the column each begins at, clear of the cells of
    earlier rows that reach into it."""
    out, held = [], []  # held: (first column, column after the last, rows left)
    for below, r in zip(range(len(rows) - 1, -1, -1), rows):
        placed, at, k, new = [], 0, 0, []
        for cell in r:
            while k < len(held) and held[k][0] < at + 1:
                at = max(at, held[k][1])
                k += 1
            placed.append((at, cell))
            if cell.rows > 1:
                new.append((at, at + cell.columns, cell.rows))
            at += cell.columns
        wide: list[tuple[int, int, int]] = []
        for a, b, n in sorted((a, b, min(n - 1, below)) for a, b, n in held + new if n > 1):
            if wide and wide[-1][1] == a and wide[-1][2] == n:
                wide[-1] = (wide[-1][0], b, n)
            else:
                wide.append((a, b, n))
        held = wide
        out.append(placed)
    return out


def layout(rows: list[list[_Cell]]) -> list[str]:
    """Lines of a table: its columns aligned, its rows as high as need be."""
    for r in rows:
        for cell in r:
            cell.lines = [part for line in cell.lines for part in wrapped(line)]
    placed = [r for r in _places(rows) if any(cell.lines for _, cell in r)]
    widths: dict[int, int] = {}
    text = 0
    for r in placed:
        for at, cell in r:
            longest = max(map(len, cell.lines), default=0)
            text += sum(map(len, cell.lines))
            if cell.columns == 1 and longest:
                widths[at] = max(widths.get(at, 0), min(longest, CELL_WIDTH))
            elif longest:
                widths.setdefault(at, 0)
    offsets, total = {}, 0
    for column in sorted(widths):
        offsets[column] = total
        total += widths[column] + 2
    high = [max(len(cell.lines) for _, cell in r) for r in placed]
    reach = [max(offsets[at] for at, cell in r if cell.lines) for r in placed]
    if sum(h * w for h, w in zip(high, reach)) > MOST_BLANKS * text + FREE_BLANKS:
        return [line for r in placed for line in _unaligned([cell.lines for _, cell in r])]
    out = []
    for r, n in zip(placed, high):
        for k in range(n):
            line: list[str] = []
            used = 0
            for at, cell in r:
                if k < len(cell.lines) and cell.lines[k]:
                    gap = max(offsets[at] - used, 2 if used else 0)
                    line += [" " * gap, cell.lines[k]]
                    used += gap + len(cell.lines[k])
            out.append("".join(line).rstrip())
    return out


def _unaligned(cells: list[list[str]]) -> list[str]:
    if all(len(lines) < 2 for lines in cells):
        return ["  ".join(line for lines in cells for line in lines if line)]
    return [line for lines in cells for line in lines]


def _style(node: Node) -> dict[str, str]:
    return dict(_DECLARED.findall(node.attrs["style"].lower())) if "style" in node.attrs else {}


def render(root: Node) -> str:
    flow = _Flow()
    flows, tables, lists = [flow], [], []
    # entries: (node, leaving, visible, keep white space)
    todo: list[tuple] = [(root, False, True, False)]
    while todo:
        node, leaving, visible, keep = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if visible:
                flow.add(node, keep)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and tables and tables[-1]:
                span = integer(node.attrs.get("colspan"), 1, 1, MOST_COLUMNS)
                down = integer(node.attrs.get("rowspan"), 1, 0, MOST_ROWS) or MOST_ROWS
                tables[-1].rows[-1].append(_Cell(span, down, flows.pop().done()))
            elif tag == "caption" and tables and tables[-1]:
                tables[-1].captions.extend(flows.pop().done())
            elif tag == "table":
                table = tables.pop()
                flow.space()
                if table:
                    flow.put_lines(table.captions + layout(table.rows))
                    flow.space()
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.newline()
                inner = len(lists) - flow.base
                flow.indent = "  " * min(max(inner - 1, 0), DEEPEST)
                if not inner:
                    flow.space()
            elif tag == "q":
                flow.add('"', False) if visible else None
            elif tag in SPACED:
                flow.space()
            elif tag in BLOCK:
                flow.newline()
            if tag == "li":
                flow.mark = None
            continue
        style = _style(node)
        if tag in UNSEEN or "hidden" in node.attrs or style.get("display") == "none":
            continue
        if "visibility" in style:
            visible = style["visibility"] not in ("hidden", "collapse")
        keep = keep or tag in ("pre", "textarea", "listing", "xmp", "plaintext")
        if "white-space" in style:
            keep = style["white-space"].startswith(("pre", "break"))
        if tag == "br":
            flow.newline(force=True) if visible else None
            continue
        if tag == "wbr" or tag in VOID and tag != "hr":
            continue
        if tag in ("td", "th") and tables and tables[-1]:
            if not tables[-1].rows:
                tables[-1].rows.append([])
            flows.append(_Flow(len(lists)))
        elif tag == "caption" and tables and tables[-1]:
            flows.append(_Flow(len(lists)))
        elif tag == "tr" and tables and tables[-1]:
            tables[-1].rows.append([])
        elif tag == "table":
            flow.space() if node.holds_table else flow.newline()
            tables.append(None if node.holds_table else _Table())
        elif tag in ("ul", "ol", "menu", "dir"):
            inner = len(lists) - flow.base
            flow.newline() if inner else flow.space()
            flow.indent = "  " * min(inner, DEEPEST)
            lists.append([tag, integer(node.attrs.get("start"), 1, -(1 << 31), (1 << 31) - 1)])
        elif tag == "li":
            flow.newline()
            kind = lists[-1] if lists[flow.base :] else ["ul", 1]
            flow.mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
            kind[1] += 1
        elif tag in SPACED:
            flow.space()
        elif tag in BLOCK:
            flow.newline()
        elif tag == "q" and visible:
            flow.add('"', False)
        todo.append((node, True, visible, keep))
        todo.extend((child, False, visible, keep) for child in reversed(node.children))
    return "\n".join(flow.done())


def extract(markup: str | None) -> str:
    return render(build(markup)) if markup else ""


def page_texts(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) of every page; one pass without a shuffle."""

    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            return {"page_id": cols["page_id"], "text": [extract(m) for m in cols["text"]]}

        return run

    cols = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("text"))
    return map_blocks(cols, make, "page_id long, text string")

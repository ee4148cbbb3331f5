"""Visible text of HTML pages, laid out as a reader would see it.

A page becomes a tree with the tags that HTML implies (a new ``li`` ends the last one, a block ends a paragraph, a
cell opens a row). Elements that are not shown are left out: head matter, scripts, hidden attributes, inline
``display:none``, the descriptions inside drawings and formulas. What ``visibility`` hides is left out too, but not the
parts of it that are visible again. The rest is rendered by layout: blocks on lines of their own, paragraphs and headings
with a blank line around them, list marks by nesting, table cells in aligned columns that may span several columns and
rows, ``pre`` as it is. Elements may be nested to any depth.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Fixed values of HTML: element classes by their default display.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object canvas audio video select datalist meta link base".split())
#: Not shown inside these elements, though it would be elsewhere.
UNSEEN_IN = {"svg": frozenset("desc metadata defs symbol".split()), "math": frozenset(["annotation", "annotation-xml"])}
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr".split())
BLOCK = SPACED | frozenset("html body div article section nav aside header footer main address form fieldset li dt dd tr caption "
                           "thead tbody tfoot details summary dialog figcaption legend center option".split())
ROW_GROUP = frozenset(["thead", "tbody", "tfoot"])
#: An opening tag ends these open elements, up to the nearest element in the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"table"}), "th": ({"td", "th", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "caption", *ROW_GROUP}, {"table"}), "tbody": ({"td", "th", "tr", "caption", *ROW_GROUP}, {"table"}),
    "tfoot": ({"td", "th", "tr", "caption", *ROW_GROUP}, {"table"}), "body": ({"head"}, {"html"}),
}
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
#: Widest span of a cell that is heeded.
MOST_SPAN = 1_000
WHITE = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Element:
    tag: str
    shown: bool = True
    start: int = 1
    #: Whether ``visibility`` shows it; None as in the element around it.
    visible: bool | None = None
    columns: int = 1
    rows: int = 1
    children: list[Element | str] = field(default_factory=list)


def _number(text: str, default: int) -> int:
    return int(text) if re.fullmatch(r"-?[0-9]{1,9}", text) else default


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html")
        self.open = [self.root]
        #: How many elements of each tag are open.
        self.held = Counter()

    def parse_html_declaration(self, i):  # "<![" of any kind is a comment
        return self.parse_bogus_comment(i) if self.rawdata.startswith("<![", i) else super().parse_html_declaration(i)

    def _end(self, at: int):
        self.held.subtract(e.tag for e in self.open[at:])
        del self.open[at:]

    def _close(self, names, until=()):
        """End the open elements from the outermost of ``names`` above the nearest of ``until``."""
        if not any(self.held[name] for name in names):
            return
        for at in range(len(self.open) - 1, 0, -1):
            tag = self.open[at].tag
            if tag in until:
                return
            if tag in names:
                self._end(at)

    def _push(self, element: Element):
        self.open[-1].children.append(element)
        self.open.append(element)
        self.held[element.tag] += 1

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in ENDS:
            self._close(*ENDS[tag])
        if tag in BLOCK:
            if tag not in ("html", "body") and self.open[-1].tag == "head":
                self._end(len(self.open) - 1)
            self._close({"p"}, BLOCK - {"p"})
        if tag in ("td", "th") and self.open[-1].tag != "tr":
            self._push(Element("tr"))
        given = {k: v or "" for k, v in reversed(attrs)}
        style = given.get("style", "")
        shown = not (tag in UNSEEN or "hidden" in given or NO_DISPLAY.search(style) or (tag == "dialog" and "open" not in given)
                     or any(self.held[outer] and tag in names for outer, names in UNSEEN_IN.items()))
        stated = VISIBILITY.findall(style)
        span = lambda name, least: max(least, min(_number(given.get(name, ""), 1), MOST_SPAN))
        element = Element(tag, shown, _number(given.get("start", ""), 1), stated[-1].lower() == "visible" if stated else None,
                          span("colspan", 1), span("rowspan", 0))
        if tag in VOID:
            self.open[-1].children.append(element)
        else:
            self._push(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if self.held[tag]:
            # An end tag of an inline element does not end the block it stands in.
            self._close_last(tag)

    def _close_last(self, tag):
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                return self._end(at)
            if tag not in BLOCK and self.open[at].tag in BLOCK:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


class Lines:
    """Text lines that know where a block ends and how many blank lines are due."""

    def __init__(self):
        self.done: list[str] = []
        self.current, self.due = "", 0

    def text(self, data: str, kept: bool):
        if kept:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.current += first
            for line in rest:
                self.line(True)
                self.current = line
        else:
            data = WHITE.sub(" ", data)
            self.current += data.lstrip(" ") if not self.current or self.current.endswith(" ") else data

    def line(self, always: bool = False):
        if self.current.strip(" ") or always:
            self.done += [""] * (self.due if self.done else 0) + [self.current.rstrip(" ")]
            self.due = 0
        self.current = ""

    def space(self):
        self.line()
        self.due = 1

    def add(self, lines: list[str]):
        if lines:
            self.line()
            self.done += [""] * (self.due if self.done else 0) + lines
            self.due = 0


def _rows(table: Element) -> tuple[list[Element], list[Element]]:
    """(rows, everything else) of a table, through its row groups."""
    rows, others, inside = [], [], list(table.children)[::-1]
    while inside:
        child = inside.pop()
        if isinstance(child, Element) and child.shown and child.tag in ROW_GROUP:
            inside += child.children[::-1]
        elif isinstance(child, Element) and child.tag == "tr":
            rows += [child] if child.shown else []
        else:
            others.append(child)
    return rows, others


def _placed(rows: list[Element]) -> list[list[tuple[int, Element]]]:
    """(first column, cell) of every row's cells. A cell keeps its columns in the rows that it spans."""
    taken: dict[int, int] = {}  # column -> rows that it is still taken for
    placed = []
    for left, row in zip(range(len(rows), 0, -1), rows):
        cells, column, spans = [], 0, {}
        for cell in row.children:
            if isinstance(cell, Element) and cell.shown and cell.tag in ("td", "th"):
                while taken.get(column):
                    column += 1
                cells.append((column, cell))
                for c in range(column, column + cell.columns):
                    spans[c] = max(taken.get(c, 0), min(cell.rows or left, left))
                column += cell.columns
        taken = {c: n - 1 for c, n in {**taken, **spans}.items() if n > 1}
        placed.append(cells)
    return placed


def _table(table: Element, seen: bool) -> Task:
    """Captions and stray text, then the rows with their cells padded to the width of the columns."""
    rows, others = _rows(table)
    lines = yield render(Element("div", children=others), seen)
    stray = [c for row in rows for c in row.children if isinstance(c, str) or c.tag not in ("td", "th")]
    for child in stray:
        lines += yield render(Element("div", children=[child]), seen)
    grid = []
    for cells, row in zip(_placed(rows), rows):
        line = []
        for column, cell in cells:
            line.append((column, cell.columns, (yield render(cell, _seen(cell, _seen(row, seen))))))
        grid.append(line)
    widths: dict[int, int] = {}
    for wanted in sorted({span for row in grid for _, span, _ in row}):  # a wider cell gets what its columns have and widens the last
        for row in grid:
            for column, span, text in row:
                if span == wanted:
                    own = [widths.get(c, 0) for c in range(column, column + span)]
                    lack = max(map(len, text), default=0) - sum(own) - 2 * (sum(w > 0 for w in own) - 1)
                    if lack > 0 and max(map(len, text), default=0):
                        widths[column + span - 1] = own[-1] + (lack if any(own) else lack - 2)
    held = sorted(c for c, w in widths.items() if w)
    for row in grid:
        for n in range(max((len(text) for _, _, text in row), default=0)):
            at = {column: (span, text[n] if n < len(text) else "") for column, span, text in row}
            parts, free = [], 0
            for c in held:
                begun = [(k, v) for k, v in at.items() if k <= c < k + v[0]]
                if c < free:
                    continue
                if begun:
                    first, (span, text) = begun[0]
                    free = first + span
                    inside = [widths[x] for x in held if first <= x < free]
                    parts.append(text.ljust(sum(inside) + 2 * (len(inside) - 1)))
                else:
                    parts.append(" " * widths[c])
            line = "  ".join(parts).rstrip(" ")
            lines += [line] if line else []
    return lines


#: A step of rendering: yields the steps it needs and gets what they return, so depth costs no stack.
Task = Generator["Task", "list[str]", "list[str]"]


def finished(task: Task) -> list[str]:
    """What a step returns, its inner steps done one after another."""
    stack, value = [task], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def _seen(element: Element, around: bool) -> bool:
    return around if element.visible is None else element.visible


def render(element: Element, seen: bool) -> Task:
    lines = Lines()
    yield _render(element, lines, element.tag == "pre", seen)
    lines.line()
    return lines.done


def _render(element: Element, lines: Lines, kept: bool, seen: bool) -> Task:
    number = element.start
    for child in element.children:
        if isinstance(child, str):
            if seen:
                lines.text(child, kept)
            continue
        if not child.shown:
            continue
        visible = _seen(child, seen)
        if child.tag == "br":
            lines.line(True)
        elif child.tag == "hr":
            lines.space()
            lines.add(["----"] if visible else [])
            lines.space()
        elif child.tag == "li":
            mark = f"{number}. " if element.tag == "ol" else "- "
            number += 1
            inner = yield render(child, visible)
            mark = mark if visible else " " * len(mark)
            lines.add([(mark if i == 0 else " " * len(mark)) + line if line else "" for i, line in enumerate(inner)])
        elif child.tag == "table":
            lines.space()
            lines.add((yield _table(child, visible)))
            lines.space()
        elif child.tag in SPACED and not (child.tag in ("ul", "ol") and element.tag == "li"):
            lines.space()
            yield _render(child, lines, kept or child.tag == "pre", visible)
            lines.space()
        elif child.tag in BLOCK:
            lines.line()
            yield _render(child, lines, kept, visible)
            lines.line()
        else:
            yield _render(child, lines, kept, visible)


def visible_text(html: str | None) -> str:
    """All visible text of a page; a null or empty page has none."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return "\n".join(finished(render(builder.root, True))).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: id and text. Null and empty pages give an empty text; every row is rendered for itself.

    Other columns are not looked at.
    """

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for htmls in parts:
            yield pd.Series([visible_text(h) for h in htmls], dtype=object)

    return pages.select(pages[id_col], F.pandas_udf(run, "string")(pages[html_col]).alias("text"))

"""HTML extraction: the visible text as a reader sees it laid out.

A small tree builder tokenises the page, closes elements that HTML closes by implication (a paragraph before a
block, a list item before the next, table rows and cells), and marks what is not shown: script, style, head and the
like, `hidden`, `display:none` and `visibility:hidden`. Rendering keeps one blank line between
paragraph-like blocks and one line break between other blocks, marks list items with their numbers, indents nested lists, keeps
preformatted text, and pads table cells to aligned columns, over columns and rows that a cell spans; a cell
may have several lines. Building takes time linear in the page, for any depth: open elements are found by their tag. Neither
building nor rendering recurses; inner tables are laid out before the tables around them.

Defined results: a null page gives an empty text. Unclosed tags, comments and unknown entities do not fail; text
outside any element is kept. Repeated rows are rendered alike. An empty table gives an empty result. Extra columns
pass through; the operator's own columns replace columns of the same name.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
UNSEEN = frozenset("head script style title noscript template iframe noembed noframes object datalist canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary "
                  "table tbody td tfoot th thead tr ul caption xmp".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr xmp".split())
# Elements on lines of their own that do not end a paragraph, and what svg and math do not show.
LINES = frozenset("option optgroup text".split())
FOREIGN = {"svg": frozenset("title desc metadata defs symbol".split()), "math": frozenset("annotation annotation-xml".split())}
SECTIONS = ("thead", "tbody", "tfoot")
# Open elements that a start tag ends, and the elements at which the search for them stops.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th", "caption"), "td": ("td", "th"),
        "th": ("td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"), "body": ("head",),
        "thead": ("caption", *SECTIONS, "tr", "td", "th"), "tfoot": (*SECTIONS, "tr", "td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
         "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",), "thead": ("table",), "body": (), "option": ("select",)}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"'][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"?|'([^']*)'?|([^\s>]*)))?|["'/=]""")
_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!|;|$)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("tag", "shown", "inside", "mark", "given", "lines")

    def __init__(self, tag: str, shown: bool = True, given: dict[str, str] | None = None):
        self.tag, self.shown, self.inside, self.mark, self.given = tag, shown, [], "- ", given or {}
        # A table's text, once it is laid out.
        self.lines: list[str] = []

    def number(self, name: str, default: int, least: int, most: int) -> int:
        """A whole-number attribute within bounds."""
        found = re.match(r"\s*([+-]?[0-9]{1,9})", self.given.get(name, ""))
        return max(least, min(most, int(found.group(1)))) if found else default


def _attributes(text: str) -> dict[str, str]:
    """Names and values; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        if m.group(1):
            found.setdefault(m.group(1).lower(), unescape(m.group(2) or m.group(3) or m.group(4) or ""))
    return found


def _seen(tag: str, found: dict[str, str]) -> bool:
    return not (tag in UNSEEN or "hidden" in found or _STYLE.search(found.get("style", "")))


class Path:
    """The open elements, and for each tag the depths at which it is open."""

    def __init__(self, root: Element):
        self.open, self.depths = [root], {}

    def push(self, element: Element) -> None:
        self.depths.setdefault(element.tag, []).append(len(self.open))
        self.open.append(element)

    def cut(self, depth: int) -> None:
        """Close the element at a depth and all in it."""
        for element in self.open[depth:]:
            self.depths[element.tag].pop()
        del self.open[depth:]

    def nearest(self, tag: str) -> int:
        """The depth of the innermost open element of a tag, 0 if there is none."""
        found = self.depths.get(tag)
        return found[-1] if found else 0

    def end(self, tags: tuple[str, ...], stops: tuple[str, ...]) -> None:
        """Close the outermost open element of `tags` inside the nearest of `stops`."""
        stop, outer = max(map(self.nearest, stops), default=0), []
        for tag in tags:
            held = self.depths.get(tag, ())
            at = bisect_right(held, stop)
            outer += held[at:at + 1]
        if outer:
            self.cut(min(outer))


def build(page: str) -> Element:
    """The tree of elements and texts."""
    root = Element("html")
    place = Path(root)
    path = place.open
    # Open svg and math elements, by their depth.
    foreign: list[int] = []
    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        begin = token.start() if token else len(page)
        if begin > at:
            path[-1].inside.append(unescape(page[at:begin]))
        if not token:
            break
        at = token.end()
        closing, tag = token.group(1), token.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "form" and path[-1].tag in ("table", "tr", *SECTIONS):
            # A form between the parts of a table holds nothing.
            continue
        if closing:
            if place.nearest(tag):
                place.cut(place.nearest(tag))
            continue
        if tag in ENDS:
            place.end(ENDS[tag], SCOPE[tag])
        if tag in BLOCK and tag not in ("html", "body"):
            place.end(("p",), ("td", "th", "table", "button", "object"))
        if tag == "html" and path[-1] is root:
            continue
        if tag in ("td", "th") and path[-1].tag in ("table", *SECTIONS):
            row = Element("tr")
            path[-1].inside.append(row)
            place.push(row)
        while foreign and (foreign[-1] >= len(path) or path[foreign[-1]].tag not in FOREIGN):
            foreign.pop()
        within = path[foreign[-1]].tag if foreign else None
        given = _attributes(token.group(3)) if token.group(3).strip() else {}
        element = Element(tag, _seen(tag, given) and not (within and tag in FOREIGN[within]),
                          given if tag in ("ol", "li", "td", "th") else None)
        if tag == "optgroup" and given.get("label"):
            # A line of its own, as an option has.
            label = Element("option")
            label.inside.append(given["label"])
            element.inside.append(label)
        path[-1].inside.append(element)
        if (within or tag in FOREIGN) and token.group(3).endswith("/"):
            continue
        if tag in FOREIGN:
            foreign.append(len(path))
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            if tag in ("textarea", "xmp"):
                inner = page[at:close.start()]
                element.inside.append(unescape(inner) if tag == "textarea" else inner)
            at = close.end()
        elif tag not in VOID:
            place.push(element)
    return root


class Layout:
    """Lines of text with pending breaks: 1 ends the line, 2 leaves a blank one."""

    def __init__(self):
        self.parts: list[str] = []
        self.breaks, self.blank, self.indent, self.marked = 0, False, "", False

    def text(self, text: str, kept: bool) -> None:
        if kept:
            self._open()
            self.parts.append(text)
            self.blank = False
            return
        joined = _BLANKS.sub(" ", text)
        if joined == " " or not joined:
            self.blank = self.blank or bool(joined)
            return
        begins = joined[0] == " " or self.blank
        if self._open() and begins:
            self.parts.append(" ")
        self.parts.append(joined.strip(" "))
        self.blank = joined[-1] == " "

    def _open(self) -> bool:
        """Write pending breaks; true if the line already had text."""
        if self.marked:
            # The first text of a list item follows its mark, whatever block it stands in.
            self.breaks, self.marked = 0, False
            return False
        inline = bool(self.parts) and not self.breaks
        if not inline:
            self.parts.append("\n" * (self.breaks if self.parts else 0) + self.indent)
        self.breaks = 0
        return inline

    def line(self, count: int) -> None:
        self.breaks, self.blank = max(self.breaks, count), False

    def result(self) -> str:
        return "".join(self.parts).strip("\n")


def _parts(table: Element) -> tuple[list[Element], list[Element | str]]:
    """The rows of a table, and what stands between them."""
    rows, strays, stack = [], [], table.inside[::-1]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            strays += [x] if x.strip() else []
        elif not x.shown:
            continue
        elif x.tag in SECTIONS:
            stack += x.inside[::-1]
        elif x.tag == "tr":
            rows.append(x)
        else:
            strays.append(x)
    return rows, strays


class Cell:
    __slots__ = ("column", "span", "lines")

    def __init__(self, column: int, span: int, lines: list[str]):
        self.column, self.span, self.lines = column, span, lines


def _grid(rows: list[Element]) -> list[list[Cell]]:
    """The cells of each row in their columns; a cell that spans rows keeps its columns from later rows."""
    grid, held = [], []
    for number, row in enumerate(rows):
        # (first column, end column, end row) of cells from rows above, from the left.
        held = sorted(h for h in held if h[2] > number)
        cells, column, new, left = [], 0, [], list(reversed(held))
        for x in row.inside:
            if isinstance(x, str) and not x.strip() or not isinstance(x, str) and not x.shown:
                continue
            spans = (1, 1) if isinstance(x, str) else (x.number("colspan", 1, 1, 1000), x.number("rowspan", 1, 0, 65534))
            while left and left[-1][0] <= column:
                column = max(column, left.pop()[1])
            lines = [x.strip()] if isinstance(x, str) else rendered(x).split("\n")
            cells.append(Cell(column, spans[0], [line.rstrip() for line in lines]))
            if spans[1] != 1:
                new.append((column, column + spans[0], number + (spans[1] or len(rows))))
            column += spans[0]
        held += new
        grid.append(cells)
    return grid


def _table_lines(table: Element) -> list[str]:
    """A table's text: cells of one column start at the same place."""
    rows, strays = _parts(table)
    out = [line for x in strays for line in rendered(x).split("\n")]
    grid = _grid(rows)
    # The last cell of a row may be longer than its column.
    inner = [cell for cells in grid for cell in cells[:-1]]
    widths: dict[int, int] = {}
    for cell in inner:
        if cell.span == 1:
            widths[cell.column] = max(widths.get(cell.column, 0), max(map(len, cell.lines)))
    for cell in inner:
        if cell.span > 1:
            last = cell.column + cell.span - 1
            room = sum(widths[c] + 2 for c in range(cell.column, last) if c in widths) + widths.get(last, 0)
            widths[last] = widths.get(last, 0) + max(0, max(map(len, cell.lines)) - room)
    used = sorted({cell.column for cells in grid for cell in cells})
    starts, place, at = {}, 0, 0
    for column in used:
        while at < column:
            # Columns in which nothing begins or ends take no room.
            place += widths[at] + 2 if at in widths else 0
            at += 1
        starts[column] = place
    for cells in grid:
        for n in range(max((len(cell.lines) for cell in cells), default=0)):
            line = ""
            for cell in cells:
                text = cell.lines[n] if n < len(cell.lines) else ""
                line = line.ljust(starts[cell.column]) + text if text else line
            if line or n:
                out.append(line)
    return out


def _render(node: Element | str, layout: Layout, kept: bool, depth: int) -> None:
    """Depth-first with a stack of its own, since pages may nest deeply."""
    stack: list = [(node, kept, depth, None)]
    while stack:
        node, kept, depth, after = stack.pop()
        if after is not None:
            count, indent = after
            if indent is not None:
                layout.indent = indent
            layout.line(count)
            continue
        if isinstance(node, str):
            layout.text(node, kept)
            continue
        if not node.shown:
            continue
        tag = node.tag
        if tag == "br":
            layout.breaks = min(2, layout.breaks + 1)
            layout.blank = False
            continue
        count = 2 if tag in SPACED and not (tag in ("ul", "ol") and depth) else 1 if tag in BLOCK or tag in LINES else 0
        if tag == "table":
            layout.line(2)
            for line in node.lines:
                if line:
                    layout.text(line, True)
                layout.line(1 if line else 2)
            layout.line(2)
            continue
        indent, inner = None, depth
        if count:
            layout.line(count)
            if tag in ("ul", "ol", "menu"):
                inner = depth + 1
            if tag == "li":
                indent = layout.indent
                layout._open()
                layout.parts.append(node.mark)
                layout.marked = True
                layout.indent = "  " * depth
            stack.append((None, kept, depth, (count, indent)))
        if tag == "ol":
            number = node.number("start", 1, -10**9, 10**9)
            for item in node.inside:
                if isinstance(item, Element) and item.tag == "li" and item.shown:
                    number = item.number("value", number, -10**9, 10**9)
                    item.mark = f"{number}. "
                    number += 1
        as_is = kept or tag in ("pre", "textarea", "xmp")
        stack.extend((x, as_is, inner, None) for x in reversed(node.inside))


def rendered(node: Element) -> str:
    layout = Layout()
    _render(node, layout, False, 0)
    return layout.result()


def _lay_out_tables(root: Element) -> None:
    """The text of all tables that are shown, inner ones first."""
    tables, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "table":
            tables.append(node)
        stack.extend(x for x in node.inside if not isinstance(x, str) and x.shown)
    for table in reversed(tables):
        table.lines = _table_lines(table)


def visible_text(page: str | None) -> str:
    if not page:
        return ""
    root = build(page)
    _lay_out_tables(root)
    return rendered(root)


@F.pandas_udf(T.StringType())
def _extract(pages: pd.Series) -> pd.Series:
    return pages.map(visible_text, na_action=None)


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every page with its visible `text` instead of the markup, and `n_lines`."""
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in {"text", "n_lines", html.lower()}]
    out = pages.select(*kept, _extract.asNondeterministic()(F.col(html)).alias("text"))
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n")))
    return out.withColumn("n_lines", lines.cast("long"))

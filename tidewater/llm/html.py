"""Visible text of HTML pages with its layout.

A tree is built from the tags, with the end tags that HTML lets authors leave out. What a browser
would not show is skipped; the rest is rendered as plain text: blocks apart, list items with their
marks, preformatted text as it is, the cells of a table in aligned columns.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Generator, Iterable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that show no text of their own.
UNSEEN = frozenset("head title script style template noscript iframe object canvas audio video datalist annotation annotation-xml desc metadata defs symbol".split())
#: Elements whose contents are text, tags and all; of textarea character references are read.
RAW = frozenset("textarea xmp plaintext".split())
#: What can stand in a head; other start tags and text end it.
IN_HEAD = frozenset("html head base basefont bgsound link meta noframes noscript script style template title".split())
#: Parts of a table, each with the open elements that it can stand in.
TABLE_PARTS = {t: ("table",) for t in ("caption", "colgroup", "tbody", "thead", "tfoot")} | {"col": ("table", "colgroup"), "tr": ("table", "tbody", "thead", "tfoot")}
TABLE_PARTS |= {t: ("table", "tbody", "thead", "tfoot", "tr") for t in ("td", "th")}
_FOSTERING = frozenset("table tbody thead tfoot tr".split())
#: Blocks with a blank line around them, and blocks that only begin a line.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure form fieldset hr".split())
BLOCK = SPACED | frozenset("html body div section article header footer nav aside main address li dt dd figcaption caption legend tr td th thead tbody tfoot details summary option center dialog textarea xmp plaintext".split())
#: A start tag ends these open elements, unless one of the barriers is open within.
_CLOSES_P = SPACED | frozenset("div section article header footer nav aside main address li dt dd details fieldset figcaption".split())
IMPLIED = {
    "li": (("li",), ("ul", "ol")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "body": (("head",), ()),
}
_SCOPE = frozenset("table td th caption body html".split())
_LEAVES_CELLS = frozenset("tr tbody thead tfoot table td th body html template".split())
_GONE = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
COLUMN_GAP = "  "
INDENT = "  "
#: Deeper indents than this look alike.
MOST_INDENT = 32
#: Tables within so many others are rendered as blocks.
MOST_NESTED = 32
#: A table whose aligned columns would take more than so many times its visible characters, and 4 for each cell, has its cells one gap apart instead.
MOST_PADDING = 3


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], None

    def hidden(self) -> bool:
        """Whether neither it nor anything in it is shown."""
        a = self.attrs
        return self.tag in UNSEEN or "hidden" in a or (self.tag == "dialog" and "open" not in a) or bool(_GONE.search(a.get("style") or "")) or (self.tag == "input" and a.get("type") == "hidden")

    def seen(self, around: bool) -> bool:
        """Whether its own text is visible, given whether that around it is: what is invisible may hold visible elements."""
        said = _VISIBILITY.findall(self.attrs.get("style") or "")
        return said[-1].lower() == "visible" if said else around


class Tree(HTMLParser):
    """Builds the tree of one page; ``root`` holds it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}  # where the open elements of a tag are

    def _pop(self, to: int) -> None:
        for node in self.open[to:]:
            self.at[node.tag].pop()
        del self.open[to:]

    def _end(self, tags: tuple[str, ...], barriers: frozenset[str] | tuple[str, ...]) -> None:
        """Ends the outermost open one of ``tags`` that no barrier shields."""
        at = self.at
        if not any(map(at.get, tags)):
            return
        shield = self._last([b for b in barriers if b not in tags])
        found = [places[k] for t in tags if (places := at.get(t)) and (k := bisect_right(places, shield)) < len(places)]
        if found:
            self._pop(min(found))

    def _last(self, tags: Iterable[str]) -> int:
        """Where the innermost open one of ``tags`` is; 0 if none is."""
        last, at = 0, self.at
        for t in tags:
            if (places := at.get(t)) and places[-1] > last:
                last = places[-1]
        return last

    def _push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _add(self, child: Node | str) -> None:
        """Puts ``child`` into the innermost open element."""
        self.open[-1].children.append(child)
        if isinstance(child, Node):
            child.parent = self.open[-1]

    def _foster(self, child: Node | str) -> None:
        """Puts before the innermost table what can't stand between its cells."""
        table = self.open[self._last(("table",))]
        around = table.parent
        around.children.insert(len(around.children) - (around.children[-1] is table), child)
        if isinstance(child, Node):
            child.parent = around

    def _fosters(self) -> bool:
        return self.open[-1].tag in _FOSTERING and self.open[self._last(("table", "template"))].tag == "table"

    def _within_table(self, tag: str) -> None:
        """Leaves what is open between the table and its part ``tag``, and opens the parts that authors may leave out."""
        if self.open[self._last(("table", "template"))].tag != "table":
            return
        self._pop(self._last(TABLE_PARTS[tag]) + 1)
        for parent, implied in (("table", "tbody"), ("tbody", "tr"), ("thead", "tr"), ("tfoot", "tr")):
            if self.open[-1].tag == parent and implied in TABLE_PARTS[tag]:
                node = Node(implied, {})
                self._add(node)
                self._push(node)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._end(("head",), ())
        if self.open[-1].tag == "colgroup" and tag not in ("col", "template"):
            self._pop(len(self.open) - 1)
        if tag in _CLOSES_P:
            self._end(("p",), _SCOPE)
        if tag in IMPLIED:
            self._end(*IMPLIED[tag])
        node = Node(tag, {k: v or "" for k, v in attrs})
        if tag in TABLE_PARTS:
            self._within_table(tag)
            self._add(node)
        elif self._fosters() and tag == "form":
            return  # stays empty there
        elif self._fosters() and tag not in ("script", "style", "template"):
            if tag == "table":  # ends the one whose cells it doesn't stand in
                self._pop(self._last(("table",)))
                self.handle_starttag(tag, attrs)
                return
            self._foster(node)
        else:
            self._add(node)
        if tag not in VOID:
            self._push(node)
        if tag in RAW:
            self.set_cdata_mode(tag)
            if tag == "plaintext":
                self.interesting = re.compile("(?!)")  # nothing ends it

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag(tag, [])
        elif at := self._last((tag,)):
            # A stray end tag doesn't reach out of its cell.
            if tag in _LEAVES_CELLS or self._last(("td", "th", "table")) <= at:
                self._pop(at)

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "textarea" and self.cdata_elem:
            data = unescape(data)
        if data.strip(" \t\n\r\f"):
            if self.open[-1].tag == "head":
                self._end(("head",), ())
            if self.open[-1].tag == "colgroup":
                self._pop(len(self.open) - 1)
            if self._fosters():
                self._foster(data)
                return
        self._add(data)


class Page:
    """Lines of text under way."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.indent, self.mark = "", ""
        self.gap = False

    def text(self, data: str) -> None:
        self.words.append(data)

    def flush(self) -> None:
        line = _SPACE.sub(" ", "".join(self.words)).strip(" ")
        self.words.clear()
        if line:
            self.put(line)

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append((self.indent + self.mark + line).rstrip(" "))
        if self.mark:
            self.indent, self.mark = (self.indent + " " * len(self.mark))[:MOST_INDENT], ""

    def block(self, spaced: bool) -> None:
        self.flush()
        self.gap = self.gap or spaced


Cell = tuple[Node, bool]  # whether its text is visible
Walk = Generator[Cell, list[str], list[str]]


def _rows(table: Node, seen: bool) -> tuple[list[Cell], list[list[list[Cell]]]]:
    """Captions and, for each part of a table, rows of cells, without what is hidden."""
    captions: list[Cell] = []
    parts: list[list[list[Cell]]] = []
    loose = False  # rows of the table itself follow each other in one part
    for node in table.children:
        if isinstance(node, str) or node.hidden():
            continue
        if node.tag == "caption":
            captions.append((node, node.seen(seen)))
            continue
        if node.tag not in ("tr", "thead", "tbody", "tfoot"):
            continue
        if node.tag != "tr" or not loose:
            parts.append([])
        loose, inner = node.tag == "tr", node.seen(seen)
        for row in [node] if loose else node.children:
            if isinstance(row, Node) and row.tag == "tr" and not row.hidden():
                around = row.seen(inner)
                parts[-1].append([(c, c.seen(around)) for c in row.children if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden()])
    return captions, parts


def _integer(value: str) -> int | None:
    digits = value.removeprefix("-")
    return int(value) if digits.isascii() and digits.isdigit() and len(digits) < 10 else None


def _number(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "")
    return min(most, int(value)) if value.isascii() and value.isdigit() and len(value) < 9 else 1


def _placed(rows: list[list[Cell]]) -> list[list[tuple[int, int, Cell]]]:
    """(first column, behind the last one, cell) of each row of a part; cells of rows above may reach down into a row."""
    out, taken = [], {}  # taken: column -> the row where it is free again
    for r, row in enumerate(rows):
        here, at = [], 0
        for cell in row:
            while taken.get(at, 0) > r:
                at += 1
            wide, high = max(1, _number(cell[0], "colspan", 1000)), _number(cell[0], "rowspan", 65534)
            here.append((at, at + wide, cell))
            if high != 1:
                taken.update(dict.fromkeys(range(at, at + wide), r + high if high else len(rows)))
            at += wide
        out.append(here)
    return out


def _table(page: Page, table: Node, seen: bool) -> Generator[Cell, list[str], None]:
    """Captions, then the rows with their cells in aligned columns; a cell that spans columns widens the last of them if it must."""
    captions, parts = _rows(table, seen)
    for c in captions:
        for line in (yield c):
            page.put(line)
    rows = []
    for part in parts:
        for row in _placed(part):
            shown = []
            for begin, end, cell in row:
                shown.append((begin, end, (yield cell) or [""]))
            rows.append(shown)
    # Columns lie between the places where some cell begins or ends.
    edges = {edge: i for i, edge in enumerate(sorted({e for row in rows for begin, end, _ in row for e in (begin, end)}))}
    widths = [0] * len(edges)
    cells = sorted(((edges[end] - edges[begin], edges[begin], edges[end], max(map(len, lines))) for row in rows for begin, end, lines in row))
    for _, begin, end, needed in cells:
        widths[end - 1] += max(0, needed - sum(widths[begin:end]) - len(COLUMN_GAP) * (end - begin - 1))
    starts = [0]
    for width in widths:
        starts.append(starts[-1] + width + len(COLUMN_GAP))
    visible = sum(4 + sum(len(line) - line.count(" ") for line in lines) for row in rows for _, _, lines in row)
    # What the lines of all rows would take: each its last cell, and as far as that begins.
    padded = sum(max(starts[edges[begin]] + len(lines[k]) for begin, _, lines in row if k < len(lines)) for row in rows for k in range(max((len(lines) for _, _, lines in row), default=0)))
    aligned = padded <= MOST_PADDING * visible
    for row in rows:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for begin, _, lines in row:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[edges[begin]]) + lines[k] if aligned else f"{line}{COLUMN_GAP if line else ''}{lines[k].strip(' ')}"
            if line.rstrip(" "):
                page.put(line.rstrip(" "))


def render_node(root: Node, seen: bool = True) -> list[str]:
    """The lines of everything visible below ``root``; cells of tables are walked one within the other, however deep."""
    walks, lines = [_walk(root, seen)], None
    while True:
        try:
            cell = walks[-1].send(lines)
            walks.append(_walk(*cell, len(walks)))
            lines = None
        except StopIteration as done:
            walks.pop()
            lines = done.value
            if not walks:
                return lines


def _walk(root: Node, seen: bool, depth: int = 0) -> Walk:
    """Asks for the lines of each cell of the tables below ``root``, and ends with the lines of ``root``; ``depth`` is in how many tables it lies."""
    page = Page()
    lists: list[list] = []  # kind and number of the open lists
    stack: list[tuple[Node | str, bool]] = [(c, True) for c in reversed(root.children)]
    kept: list[tuple[str, str, bool]] = []
    preformatted = 0
    while stack:
        node, enter = stack.pop()
        if isinstance(node, str):
            if not seen:
                continue
            if preformatted:
                *whole, last = node.split("\n")
                for line in whole:
                    page.put("".join(page.words) + line)
                    page.words.clear()
                if last:
                    page.text(last)
            else:
                page.text(node)
            continue
        tag = node.tag
        if enter:
            if node.hidden():
                continue
            if tag == "br":
                page.flush() if page.words else page.put("")
                continue
            visible = node.seen(seen)
            if tag == "img":
                page.text(node.attrs.get("alt", "") if visible else "")
                continue
            if tag in BLOCK:
                page.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "hr":
                if visible:
                    page.put("---")
                page.block(True)
                continue
            if tag == "table" and depth < MOST_NESTED:
                yield from _table(page, node, visible)
                page.block(True)
                continue
            kept.append((page.indent, page.mark, seen))
            seen = visible
            if tag in ("ul", "ol"):
                down = "reversed" in node.attrs
                start = _integer(node.attrs.get("start", ""))
                if start is None:
                    start = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if down else 1
                lists.append([tag, start, -1 if down else 1])
                page.indent = (page.indent + (INDENT if len(lists) > 1 else ""))[:MOST_INDENT]
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1, 1]
                value = _integer(node.attrs.get("value", ""))
                kind[1] = kind[1] if value is None else value
                page.mark = ("- " if kind[0] == "ul" else f"{kind[1]}. ") if seen else ""
                kind[1] += kind[2]
            elif tag in ("blockquote", "dd"):
                page.indent = (page.indent + INDENT)[:MOST_INDENT]
            elif tag == "pre" or tag in RAW:
                preformatted += 1
            stack.append((node, False))
            stack += [(c, True) for c in reversed(node.children)]
            continue
        if tag == "pre" or tag in RAW:
            preformatted -= 1
            if page.words:
                page.put("".join(page.words))
                page.words.clear()
        if tag in BLOCK:
            page.block(tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
        if tag in ("ul", "ol"):
            lists.pop()
        indent, mark, seen = kept.pop()
        if tag == "li" or page.mark == mark:
            page.indent, page.mark = indent, mark
        else:  # the mark stands before a line of this block: later ones are indented as far
            page.indent = (indent + " " * len(mark))[:MOST_INDENT]
    page.flush()
    return page.lines


def _comments(html: str) -> str:
    """The page with comments that ``--!>`` closes closed as usual."""
    at, out, done = html.find("<!--") if "--!>" in html else -1, [], 0
    while at >= 0:
        odd, end = html.find("--!>", at + 4), html.find("-->", at + 2)
        if odd < 0:
            break
        if end < 0 or odd < end:
            out += [html[done:odd], "-->"]
            done = odd + 4
        at = html.find("<!--", max(done, end if 0 <= end < odd else done))
    return "".join([*out, html[done:]])


def render(html: str | None) -> str:
    """The visible text of a page; null and empty pages give the empty text.

    It takes time in proportion to the page, and is a small multiple of it: indents end at MOST_INDENT and tables that would be mostly
    padding aren't aligned.
    """
    tree = Tree()
    tree.feed(_comments(html or ""))
    if tree.cdata_elem in RAW:  # never closed: the rest is its text
        rest, tree.rawdata = tree.rawdata, ""
        tree.handle_data(rest)
    tree.close()
    return "\n".join(render_node(tree.root)).strip("\n")


def extract(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html_col`` in its place; each row by itself, null pages give the empty text.

    An existing column ``out`` is replaced (names are compared without case).
    """
    keep = [c for c in pages.columns if c.lower() not in (html_col.lower(), out.lower())]
    schema = T.StructType([*(pages.schema[c] for c in keep), T.StructField(out, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                html = b.column(html_col)
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array([render(html[i].as_py()) for i in range(b.num_rows)], pa.string())], [*keep, out])

    return pages.select(*keep, F.col(html_col)).mapInArrow(run, schema)


def query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "html"))

"""The visible text of HTML pages, laid out.

A tree builder adds the end tags that HTML implies and forgives those that are missing or misplaced; a
renderer walks the tree without recursion, leaves out what a browser does not show, keeps the space
between blocks, marks list items and aligns the cells of tables. What it adds to the text is bounded: the
constants below say how far it indents and pads; beyond that it goes on without, and no text is dropped.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from contractflow.llm.text import append

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head title script style template noscript iframe object svg canvas audio video datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre article figure fieldset hr".split())
BLOCK = SPACED | frozenset("html body div section header footer main nav aside address form li dt dd tr td th thead tbody tfoot caption figcaption details summary legend option center dir menu".split())
CLOSES = {  # a start tag and the open elements that it ends, not looking beyond the barriers
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
SECTIONS = frozenset({"thead", "tbody", "tfoot"})
CELLS = frozenset({"td", "th"})
PARENTS = {"td": SECTIONS | {"tr", "table"}, "th": SECTIONS | {"tr", "table"}, "tr": SECTIONS | {"table"}, **dict.fromkeys(SECTIONS, frozenset({"table"}))}
SEALED = frozenset({"td", "th", "caption", "template", "svg", "noscript", "iframe"})  # what is in these belongs to no table around them
HEAD = frozenset("title meta link style script base noscript template".split())  # start tags that do not end an open head
CELL_BARRIERS = frozenset({"table", "td", "th", "caption"})
GONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!important\s*)?(?:;|$)", re.IGNORECASE)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(?:!important\s*)?(?=;|$)", re.IGNORECASE)
BLANKS = re.compile(r"[ \t\n\r\f]+")
DEEPEST = 16  # tables within tables that are aligned; deeper ones are rendered as plain blocks
INDENTED = 20  # levels of lists and quotes that are indented
WIDEST = 40  # characters to which a column is padded; longer cells stand as they are
PADDING = 8  # blanks for each other character of a table, at most; a table that takes more is not aligned


class Node:
    """``gone`` is not shown with all it holds; ``veil`` tells whether its own text is, None for as its parent's."""

    __slots__ = ("children", "gone", "rows", "span", "start", "tag", "veil")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        style = attrs.get("style") or ""
        self.tag, self.children = tag, []
        self.gone = tag in UNSEEN or "hidden" in attrs or bool(GONE.search(style)) or (tag == "dialog" and "open" not in attrs)
        said = VISIBILITY.findall(style)
        self.veil = said[-1].lower() != "visible" if said else None
        self.start = _number(attrs.get("start"), 1) if tag == "ol" else 1
        self.span = max(1, min(1000, _number(attrs.get("colspan"), 1)))
        self.rows = max(0, min(65534, _number(attrs.get("rowspan"), 1)))


def _number(text: str | None, default: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else default


class Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: dict[str, int] = {}

    def _pop(self) -> None:
        self.count[self.open.pop().tag] -= 1

    def _end_within(self, tags: set[str], barriers: set[str] | frozenset[str]) -> None:
        """End the outermost of these elements that is open inside the innermost barrier."""
        if not any(self.count.get(t) for t in tags):
            return
        found = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                found = i
            elif self.open[i].tag in barriers:
                break
        while found is not None and len(self.open) > found:
            self._pop()

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        if node.tag not in VOID:
            self.open.append(node)
            self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def _into_table(self, tag: str) -> None:
        """End what stands between a part of a table and the part that holds it; imply the row of a cell."""
        parents = PARENTS[tag]
        if not any(self.count.get(t) for t in parents):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in parents:
                while len(self.open) > i + 1:
                    self._pop()
                if tag in CELLS and self.open[-1].tag != "tr":
                    self._push(Node("tr", {}))
                return
            if self.open[i].tag in SEALED:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open[-1].tag == "head" and tag not in HEAD:
            self._pop()
        if tag in BLOCK and self.count.get("p"):
            self._end_within({"p"}, CELL_BARRIERS)
        if tag in CLOSES:
            self._end_within(*CLOSES[tag])
        if tag in PARENTS:
            self._into_table(tag)
        self._push(Node(tag, dict(attrs)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # HTML has no self-closing elements but the void ones

    def handle_endtag(self, tag: str) -> None:
        if tag == "br" or (tag == "p" and not self.count.get("p")):
            self.open[-1].children.append(Node(tag, {}))
        elif self.count.get(tag):
            barriers = CELL_BARRIERS - {tag} if tag not in ("table", "body", "html") else frozenset()
            if tag in ("tr", "thead", "tbody", "tfoot"):
                barriers = frozenset({"table"})
            self._end_within_innermost(tag, barriers)

    def _end_within_innermost(self, tag: str, barriers: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i].tag in barriers:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and BLANKS.sub("", data):
            self._pop()
        self.open[-1].children.append(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA["):
            self.handle_data(data[6:])


def unveil(top: Node) -> None:
    """Settle for every element whether its own text is hidden."""
    top.veil = bool(top.veil)
    todo = [top]
    while todo:
        node = todo.pop()
        for child in node.children:
            if isinstance(child, Node):
                if child.veil is None:
                    child.veil = node.veil
                todo.append(child)


class Page:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # a blank is due before the next word
        self.gap = 0  # line breaks due before the next text
        self.prefix = ""  # of the next line, such as a list marker
        self.indent = ""

    def word(self, text: str) -> None:
        if self.gap:
            if self.lines and self.gap > 1:
                self.lines.append("")
            self.gap = 0
        if not self.line:
            self.line.append(self.prefix or self.indent)
            self.prefix = ""
        elif self.blank:
            self.line.append(" ")
        self.blank = False
        self.line.append(text)

    def flow(self, text: str) -> None:
        pieces = BLANKS.split(text)
        for i, piece in enumerate(pieces):
            if i:
                self.blank = True
            if piece:
                self.word(piece)

    def flush(self) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        self.blank = False

    def block(self, space: int) -> None:
        self.flush()
        self.gap = max(self.gap, space)

    def newline(self) -> None:
        if self.line:
            self.flush()
        elif self.lines and not self.gap:
            self.lines.append("")

    def raw(self, text: str) -> None:
        for i, line in enumerate(text.split("\n")):
            if i:
                self.flush() if self.line else self.lines.append("")
            if line:
                self.word(line)


def table_parts(table: Node) -> tuple[list[list[Node] | None], list[list]]:
    """The cells of each row of a table, and by runs all else that stands in the table, its sections and its rows.

    None stands where a section begins, beyond which no cell of an earlier row reaches.
    """
    rows: list[list[Node] | None] = []
    loose: list[list] = [[]]
    todo: list[object] = [c for c in reversed(table.children) if isinstance(c, Node) or not table.veil]
    while todo:
        node = todo.pop()
        if node is None:  # the end of a section or row
            loose.append([])
        elif isinstance(node, Node) and (node.tag == "tr" or node.tag in SECTIONS or node.tag in CELLS):
            if node.gone:
                continue
            loose.append([])
            if node.tag in CELLS:
                rows[-1].append(node)
                continue
            rows.append([] if node.tag == "tr" else None)
            todo.append(None)
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node) or not node.veil)
        else:
            loose[-1].append(node)
    return rows, [run for run in loose if run]


def table_grid(rows: list[list[Node] | None], depth: int) -> list[list[tuple[list[str], int]]]:
    """For each row with text the lines and the columns of every cell; what a cell of an earlier row holds is a blank one."""
    grid: list[list[tuple[list[str], int]]] = []
    held: list[tuple[int, int, int]] = []  # first column, columns and further rows of cells over several rows
    for cells in rows:
        if cells is None:
            held = []
            continue
        texts: list[tuple[list[str], int]] = []
        at, rest, new = 0, sorted(held), []
        for c in cells:
            while rest and rest[0][0] <= at:
                texts.append(([], rest[0][1]))
                at += rest.pop(0)[1]
            texts.append(([line for line in render(c, depth + 1) if line.strip()], c.span))
            if c.rows != 1:
                new.append((at, c.span, c.rows - 1 if c.rows else 65534))
            at += c.span
        texts += [([], span) for _, span, _ in rest]
        held = [(first, span, left - 1) for first, span, left in held if left > 1] + new
        if any(lines for lines, _ in texts):
            grid.append(texts)
    return grid


def table_lines(rows: list[list[Node] | None], depth: int) -> list[str]:
    """Rows of cells in aligned columns; a cell of several lines takes as many lines of the page.

    A cell over several columns widens none of them; one over several rows keeps its columns in those below. Columns are
    padded to ``WIDEST`` characters at most, and a table that takes more than ``PADDING`` blanks for each other
    character is not aligned: its cells stand one after the other.
    """
    grid = table_grid(rows, depth)
    width: dict[int, int] = {}
    text = 0
    for texts in grid:
        at = 0
        for lines, span in texts:
            if span == 1:
                width[at] = max(width.get(at, 0), *(min(len(line), WIDEST) for line in lines), 0)
            text += sum(len(line) - line.count(" ") for line in lines)
            at += span
    spare = PADDING * (text + 4)
    out, blanks = [], 0
    for texts in grid:
        rooms, at = [], 0
        for _, span in texts:
            rooms.append(sum(width.get(i, 0) for i in range(at, at + min(span, len(width) + 1))) + 3 * (min(span, len(width) + 1) - 1))
            at += span
        tall = max(len(lines) for lines, _ in texts)
        whole = sum(rooms) + 3 * len(rooms)
        for n in range(tall):
            blanks += whole
            if blanks > spare + text:
                break
            cells = [(lines[n] if n < len(lines) else "").ljust(room) for (lines, _), room in zip(texts, rooms, strict=True)]
            out.append(" | ".join(cells).rstrip())
        else:
            continue
        return [" | ".join(lines[n] for lines, _ in texts if n < len(lines)) for texts in grid for n in range(max(len(lines) for lines, _ in texts))]
    return out


def render(top: Node, depth: int = 0) -> list[str]:
    """The lines of an element's visible text."""
    page = Page()
    lists: list[list] = []  # of each open list: kind and next number
    pre = level = 0
    todo: list[tuple[str, object]] = [("children", top)]
    while todo:
        what, node = todo.pop()
        if what == "end":
            tag = node.tag
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if tag == "pre":
                pre -= 1
            if tag in ("ul", "ol", "menu", "dir", "li", "blockquote", "dd"):
                page.block(0)
                if tag in ("li", "blockquote", "dd"):
                    level -= 1
                    page.indent = "  " * min(level, INDENTED)
                    page.prefix = ""
            if tag in BLOCK:
                page.block(_space(tag, lists))
            continue
        if what == "text":
            page.raw(node) if pre else page.flow(node)
            continue
        if what == "node":
            tag = node.tag
            if node.gone:
                continue
            if tag == "br":
                page.newline()
                continue
            if tag == "table" and depth < DEEPEST and (parts := table_parts(node))[0]:
                page.block(2)
                rows, loose = parts
                for line in [*_loose(loose, depth), *table_lines(rows, depth)]:
                    page.word(line)
                    page.flush()
                page.block(2)
                continue
            if tag in BLOCK:
                page.block(_space(tag, lists))
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag, node.start])
            if tag == "pre":
                pre += 1
            if tag in ("li", "blockquote", "dd"):
                mark = "  "
                if tag == "li":
                    mark = "- "
                    if lists and lists[-1][0] == "ol":
                        mark = f"{lists[-1][1]}. "
                        lists[-1][1] += 1
                page.prefix = page.indent + (mark if tag == "li" or level < INDENTED else "")
                level += 1
                page.indent = "  " * min(level, INDENTED)
            if tag not in VOID:
                todo.append(("end", node))
        for child in reversed(node.children):
            if isinstance(child, Node):
                todo.append(("node", child))
            elif not node.veil:
                todo.append(("text", child))
    page.flush()
    return page.lines


def _space(tag: str, lists: list) -> int:
    return 2 if tag in SPACED and not (lists and tag in ("ul", "ol", "menu", "dir", "p")) else 1


def _loose(runs: list[list], depth: int) -> list[str]:
    """Text of a table outside its cells, such as a caption; it stands before the rows, where browsers show it."""
    out = []
    for nodes in runs:
        holder = Node("div", {})
        holder.children = nodes
        out += [line for line in render(holder, depth + 1) if line]
    return out


def page_text(html: str | None) -> str:
    """The visible text of a page; empty for a null or empty page."""
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    unveil(tree.root)
    return "\n".join(render(tree.root))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """pages with ``page_text``, the laid-out visible text of each page.

    Never null: a null or empty page, or one that shows nothing, has an empty text. Malformed HTML is read as
    browsers do, as far as the rules above go; no text is cut, however long or deep a page is. Tables more than ``DEEPEST``
    deep are blocks, lists and quotes are indented ``INDENTED`` levels, columns padded to ``WIDEST`` characters, and a
    table that would take more than ``PADDING`` blanks a character is not aligned, so that a page's text is never many
    times its HTML. Repeated rows are read alike; a column of pages that is named page_text gives way; an empty table
    has no rows.
    """
    return append(pages, html, lambda column: [pa.array([page_text(p) for p in column.to_pylist()], pa.string())], "page_text string")

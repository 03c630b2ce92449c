"""Visible text of web pages by layout-aware rendering.

A tree builder reads the tags, adds implied ones (a list item ends the one before, a
block ends an open paragraph, and so on) and closes what was left open. A renderer then
walks the tree: invisible elements give nothing; blocks are set apart by line breaks or
blank lines; list items get a mark and an indent; the cells of a table are aligned in
columns; text in ``pre`` keeps its white space.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript title meta link iframe object audio video canvas "
    "datalist noembed noframes annotation annotation-xml".split()
)
#: Elements of a drawing that are not drawn by themselves.
UNDRAWN = frozenset("defs desc metadata symbol".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body div section article header footer nav main aside address form li dt dd tr caption "
    "thead tbody tfoot hr details summary figcaption legend center menu hgroup search dialog".split()
)
#: What an opening tag ends if it is open, and the elements that shield it.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
#: Below what open element a tag of a table belongs; other open elements end there.
SECTIONS = {"thead", "tbody", "tfoot"}
PLACES = {
    "td": {"tr", "table"} | SECTIONS, "th": {"tr", "table"} | SECTIONS, "tr": {"table"} | SECTIONS,
    **dict.fromkeys(SECTIONS | {"caption", "col", "colgroup"}, {"table"}),
}
SHIELDS = {"table", "td", "th", "body", "html", "button", "caption"}
SPACE = re.compile(r"[ \t\n\r\f]+")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?P<self>/?)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
INVISIBLE_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "children", "hidden", "span", "start")

    def __init__(self, tag: str, hidden: bool = False, span: int = 1, start: int = 1):
        self.tag, self.hidden, self.span, self.start = tag, hidden, span, start
        self.children: list[Node | str] = []


def _open(tag: str, text: str) -> Node:
    values = {}
    if text:
        for name, value in ATTRIBUTE.findall(text):
            values.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    hidden = (
        tag in HIDDEN
        or "hidden" in values
        or (tag == "dialog" and "open" not in values)
        or (tag == "input" and values.get("type", "").lower() == "hidden")
        or bool(INVISIBLE_STYLE.search(values.get("style", "")))
    )
    span = values.get("colspan", "1")
    start = values.get("start", "1")
    return Node(
        tag, hidden, min(max(int(span), 1), 1000) if span.isdecimal() and len(span) < 5 else 1,
        int(start) if start.isdecimal() and len(start) < 10 else 1,
    )


def parse(page: str) -> Node:
    """Tree of a page; every start tag gets an end, and text lies where it belongs."""
    root = Node("html")
    stack, place = [root], 0

    def close(wanted: set[str], shields: set[str]) -> None:
        depth = len(stack) - 1
        last = None
        while depth > 0 and stack[depth].tag not in shields:
            if stack[depth].tag in wanted:
                last = depth
            depth -= 1
        if last is not None:
            del stack[last:]

    def make_room(tag: str) -> None:
        """End what a tag of a table can not stand in, and open the row that a cell needs."""
        if tag == "table":
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ("td", "th", "caption"):
                    return
                if stack[depth].tag == "table":
                    del stack[depth:]
                    return
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in PLACES[tag]:
                del stack[depth + 1 :]
                if tag in ("td", "th") and stack[-1].tag != "tr":
                    row = Node("tr")
                    stack[-1].children.append(row)
                    stack.append(row)
                return
            if stack[depth].tag in ("td", "th", "caption"):
                return

    while place < len(page):
        found = TOKEN.search(page, place)
        if found is None:
            stack[-1].children.append(html.unescape(page[place:]))
            break
        if found.start() > place:
            stack[-1].children.append(html.unescape(page[place : found.start()]))
        place = found.end()
        if found["end"]:
            tag = found["end"].lower()
            if tag == "p" and not any(n.tag == "p" for n in stack):
                stack[-1].children.append(Node("p"))
            elif tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag == "table":
                inner = max((i for i, n in enumerate(stack) if n.tag == "table"), default=len(stack))
                del stack[inner:]
            else:
                close({tag}, SHIELDS - {tag} if tag not in BLOCKS else {"table"} - {tag})
        elif found["start"]:
            tag = found["start"].lower()
            if tag in ("html", "body") and any(n.tag == tag for n in stack[1:]):
                continue
            if tag in BLOCKS:
                close({"p"}, SHIELDS)
            if tag in BLOCKS | {"a"} and any(n.tag == "head" for n in stack):
                close({"head"}, set())
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in PLACES or tag == "table":
                make_room(tag)
            node = _open(tag, found["attributes"])
            if tag in UNDRAWN and any(n.tag == "svg" for n in stack):
                node.hidden = True
            stack[-1].children.append(node)
            if tag in VOID or found["self"]:
                continue
            if tag == "form" and stack[-1].tag in SECTIONS | {"table", "tr"}:
                continue  # its content belongs to the table
            if tag in RAW:
                end = re.compile(rf"</{tag}[\s/>]", re.I).search(page, place)
                stop = end.start() if end else len(page)
                raw = page[place:stop].removeprefix("\n")
                node.children.append(html.unescape(raw) if tag == "textarea" else raw)
                place = page.find(">", stop) + 1 if end else len(page)
                place = place or len(page)
                continue
            stack.append(node)
    return root


class _Lines:
    """Output lines: inline text is collected, breaks and blank lines are merged."""

    def __init__(self, item: bool = False):
        self.item = item
        self.lines: list[str] = []
        self.text: list[str] = []
        self.blank = False
        self.prefix = ""

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.text.append(first)
            for line in rest:
                self.end(True)
                self.text.append(line)
        elif text:
            self.text.append(SPACE.sub(" ", text))

    def end(self, always: bool = False) -> None:
        line = "".join(self.text)
        self.text = []
        if not always:
            line = re.sub(" {2,}", " ", line).strip(" ")
            if not line and not self.prefix.strip():
                return
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        self.lines.append((self.prefix + line).rstrip())
        self.prefix = " " * len(self.prefix)

    def gap(self) -> None:
        self.end()
        self.blank = True


def width(text: str) -> int:
    """Columns that a text takes; wide characters take two, combining marks none."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1
        for c in text
    )


def _parts(table: Node) -> tuple[list[Node], list[list[Node]], list]:
    """Captions, rows of cells, and all other visible children, which stand before the table."""
    captions, rows, loose = [], [], []
    stack: list = list(reversed(table.children))
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            loose.append(node if node.strip() else " ")
        elif node.hidden:
            continue
        elif node.tag == "caption":
            captions.append(node)
        elif node.tag == "tr":
            rows.append([c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th") and not c.hidden])
            loose += [c for c in node.children if isinstance(c, str) or c.tag not in ("td", "th")]
        elif node.tag in SECTIONS | {"colgroup"}:
            stack += reversed(node.children)
        else:
            loose.append(node)
    return captions, rows, loose


def _table(table: Node, depth: int) -> list[str]:
    """Lines of a table: cells side by side, padded to the width of their column."""
    captions, found, others = _parts(table)
    before = _Lines()
    _walk(others, before, depth + 1)
    before.end()
    lines = before.lines
    for caption in captions:
        lines += _render(caption, depth + 1)
    rows = []
    for row in found:
        cells = []
        for cell in row:
            cells.append(_render(cell, depth + 1) or [""])
            cells += [[""]] * (min(cell.span, 1000) - 1)
        rows.append(cells)
    columns = max(map(len, rows), default=0)
    widths = [0] * columns
    for row in rows:
        for i, cell in enumerate(row):
            widths[i] = max(widths[i], max(map(width, cell)))
    for row in rows:
        for n in range(max(map(len, row), default=0)):
            line = [cell[n] if n < len(cell) else "" for cell in row]
            padded = [t + " " * (w - width(t)) for t, w in zip(line, widths)]
            lines.append("  ".join(padded).rstrip())
    return [line for i, line in enumerate(lines) if line or (0 < i < len(lines) - 1)]


DEEPEST = 200


def _render(node: Node, depth: int, item: bool = False) -> list[str]:
    out = _Lines(item)
    _walk(node.children, out, depth)
    out.end()
    return out.lines


def _walk(children: list, out: _Lines, depth: int, keep: bool = False) -> None:
    """Render nodes in order; below DEEPEST levels the text is taken without layout."""
    if depth > DEEPEST:
        stack = list(reversed(children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.add(node)
            elif not node.hidden:
                stack += [" ", *reversed(node.children)]
        return
    number = None
    for node in children:
        if isinstance(node, str):
            out.add(node, keep)
            continue
        if node.hidden:
            continue
        tag = node.tag
        if tag == "br":
            out.end(always=bool("".join(out.text).strip()) or keep)
        elif tag == "hr":
            out.gap()
        elif tag == "table":
            out.gap()
            for line in _table(node, depth):
                out.add(line, keep=True)
                out.end(True)
            out.gap()
        elif tag in ("ul", "ol", "menu"):
            around = out.end if out.item else out.gap  # a list in a list item stays close
            around()
            number = node.start
            for item in node.children:
                if isinstance(item, Node) and item.tag == "li" and not item.hidden:
                    mark = f"{number}. " if tag == "ol" else "- "
                    number += 1
                    lines = _render(item, depth + 1, item=True)
                    for i, line in enumerate(lines):
                        out.add((mark if i == 0 else " " * len(mark)) + line, keep=True)
                        out.end(True)
                else:
                    _walk([item], out, depth + 1)
                    out.end()
            around()
        elif tag == "img":
            continue
        elif tag in PARAGRAPHS:
            out.gap()
            _walk(node.children, out, depth + 1, keep or tag == "pre")
            if tag == "pre" and out.text:
                out.end(True)
            out.gap()
        elif tag in BLOCKS:
            out.end()
            indent = "    " if tag == "dd" else ""
            if indent:
                for line in _render(node, depth + 1):
                    out.add(indent + line, keep=True)
                    out.end(True)
            else:
                _walk(node.children, out, depth + 1, keep)
            out.end()
        elif tag == "xmp":
            out.gap()
            _walk(node.children, out, depth + 1, True)
            if out.text:
                out.end(True)
            out.gap()
        elif tag == "textarea":
            _walk(node.children, out, depth + 1, True)
            out.add(" ")
        elif tag in ("option", "optgroup"):
            out.end()
            _walk(node.children, out, depth + 1, keep)
            out.end()
        elif tag in ("td", "th", "text"):
            _walk(node.children, out, depth + 1, keep)
            out.add(" ")
        elif tag == "q":
            out.add('"')
            _walk(node.children, out, depth + 1, keep)
            out.add('"')
        else:
            _walk(node.children, out, depth + 1, keep)


def page_text(page: str | None) -> str:
    """All visible text of a page; empty for none."""
    if not page:
        return ""
    return "\n".join(_render(parse(page.replace("\r\n", "\n")), 0)).strip("\n")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [page_text(page) for page in batch.column(1).to_pylist()]
        yield pa.record_batch(
            [batch.column(0), pa.array(texts, pa.string())], ["row", "text"]
        )


def extract(pages: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of each page and ``text``, its visible text.

    Null and empty pages have an empty text. Broken markup never fails: open elements
    end with the page, unknown tags are transparent, very deep nesting loses its
    layout but no text. Repeated rows and null ids are carried along; no rows give no
    rows.
    """
    row = F.struct(*[F.col(c) for c in keep]).alias("row")
    kind = pages.select(row).schema["row"].dataType.simpleString()
    return pages.select(row, F.col("html").cast("string").alias("html")).mapInArrow(
        _pages, f"row {kind}, text string"
    ).select("row.*", "text")

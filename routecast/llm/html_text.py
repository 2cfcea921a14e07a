"""Visible text of HTML pages, laid out.

A page is cut into tags and text, built into a tree with the tags that HTML
implies (a paragraph ends before a block, list items, table parts and options
end each other), and rendered: hidden content is left out, blocks stand on
lines of their own, paragraphs and the like apart by an empty line, list items
are indented behind their bullet or number, preformatted text keeps its
spaces, and the cells of a table's column begin at the same character.

Hidden are scripts, styles, the head, templates, closed dialogs, elements with
``hidden`` or an inline ``display: none``, and text under an inline
``visibility: hidden`` that no inner ``visible`` lifts. Elements nested deeper
than ``MAX_NESTING`` become siblings at that depth, as in browsers. A table
column is aligned up to ``MAX_ALIGNED`` characters; a wider cell is not cut,
what follows it in its row just begins later.

Defined results: null gives null, empty gives empty text; unclosed or stray
tags, comments and markup never fail; every input row gives one row, repeated
rows and null ids included; other columns are ignored; an empty table gives an
empty table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecast.llm.common import table

MAX_NESTING = 200
MAX_ALIGNED = 40
MAX_SPAN = 1000  # as in HTML

# Element names of HTML by role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("area base basefont datalist head link meta noembed noframes param rp script style template title".split())
APART = set("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre listing figure table hr fieldset".split())
BLOCK = APART | set(
    "address article aside body caption center dd details dialog div dt figcaption footer form header hgroup html "
    "legend li main nav option optgroup search section summary tbody td tfoot th thead tr".split()
)
ENDS_P = (BLOCK | {"hr"}) - set("body caption html legend option optgroup tbody td tfoot th thead tr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
# a start tag ends the open element of these names, unless one of the stops lies between
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"body"}),
}
# an end tag does not reach past these; those of table parts reach to the table
SCOPE = {"table", "td", "th", "caption", "button"}
TABLE_PARTS = {"td", "th", "tr", "caption", "thead", "tbody", "tfoot", "colgroup"}

_TAG = re.compile(r"<(?:!--|(/?)([A-Za-z][^\s/>]*)|[!?/])")
_ATTR = re.compile(r"""([^\s=>/"'][^\s=>/]*|["'][^\s=>/]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _tag_end(page: str, at: int) -> int:
    """Place after the ``>`` that ends a tag, quoted values passed over."""
    while True:
        end = page.find(">", at)
        if end < 0:
            return len(page)
        quote = min((q for q in (page.find('="', at, end), page.find("='", at, end)) if q >= 0), default=-1)
        if quote < 0:
            return end + 1
        closing = page.find(page[quote + 1], quote + 2)
        if closing < 0:
            return end + 1
        at = closing + 1


def events(page: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """("text", characters, None), ("start", tag, attributes), ("end", tag,
    None) and, for text that takes no references, ("raw", characters, None)."""
    at, n, lower = 0, len(page), None
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            yield "text", page[at:], None
            return
        if m.start() > at:
            yield "text", page[at : m.start()], None
        if m.group(2) is None:
            if page.startswith("<!--", m.start()):
                short = re.compile("-?>").match(page, m.end())  # <!--> and <!---> are whole
                end = short.end() if short else page.find("-->", m.end()) + 3
                at = end if end > 2 else n
            else:
                end = page.find(">", m.end())
                at = end + 1 if end >= 0 else n
            continue
        tag = m.group(2).lower()
        at = _tag_end(page, m.end())
        if m.group(1):
            yield "end", tag, None
            continue
        attrs: dict[str, str] = {}
        inner = page[m.end() : at - 1]
        if inner and not inner.isspace():
            for a in _ATTR.finditer(inner):
                value = a.group(2) if a.group(2) is not None else a.group(3) if a.group(3) is not None else a.group(4) or ""
                attrs.setdefault(a.group(1).lower(), html.unescape(value))
        yield "start", tag, attrs
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            if len(lower) != n:  # lower case may be longer
                lower = "".join(c.lower() if c.isascii() else c for c in page)
            end = lower.find(f"</{tag}", at)
            while end >= 0 and end + len(tag) + 2 < n and lower[end + len(tag) + 2] not in " \t\n\r\f/>":
                end = lower.find(f"</{tag}", end + 1)
            end = n if end < 0 else end
            if end > at:
                yield ("text" if tag in ("textarea", "title") else "raw"), page[at:end], None
            at = end


def tree(page: str) -> Node:
    root = Node("#root", {})
    stack = [root]

    def close(names: set[str], stops: set[str]) -> bool:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                del stack[i:]
                return True
            if stack[i].tag in stops:
                return False
        return False

    for kind, value, attrs in events(page):
        if kind == "start":
            if value in ENDS_P:
                close({"p"}, SCOPE)
            if value in IMPLIED_END:
                names, stops = IMPLIED_END[value]
                while close(names, stops) and value in ("tr", "thead", "tbody", "tfoot"):
                    pass
            if len(value) == 2 and value[0] == "h" and value[1] in "123456" and stack[-1].tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                stack.pop()
            node = Node(value, attrs)
            stack[-1].children.append(node)
            if value not in VOID and len(stack) <= MAX_NESTING:
                stack.append(node)
        elif kind == "end":
            if value == "br":
                stack[-1].children.append(Node("br", {}))
            elif value == "p" and not any(x.tag == "p" for x in stack):
                stack[-1].children.append(Node("p", {}))
            elif value not in VOID:
                close({value}, set() if value == "table" else {"table"} if value in TABLE_PARTS else SCOPE)
        else:
            stack[-1].children.append(value if kind == "raw" else html.unescape(value))
    return root


class Lines:
    """Text being laid out: lines, the blanks due, and the line at work."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False
        self.gap = 0  # empty lines due before the next text

    def word(self, text: str) -> None:
        if self.gap and self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        if self.space and self.now:
            self.now.append(" ")
        self.space = False
        self.now.append(text)

    def text(self, raw: str) -> None:
        inner = _SPACES.sub(" ", raw)
        core = inner.strip(" ")
        if not core:
            self.space |= bool(inner)
            return
        self.space |= inner[0] == " "
        self.word(core)
        self.space = inner[-1] == " "

    def verbatim(self, raw: str) -> None:
        first, *rest = raw.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        if first:
            self.word(first)
        for x in rest:
            self.newline()
            if x:
                self.word(x)

    def newline(self) -> None:
        self.flush(True)

    def flush(self, always: bool = False) -> None:
        if self.now or always:
            if self.gap and self.lines and not self.now:
                self.lines += [""] * self.gap
            if not self.now:
                self.gap = 0
            self.lines.append("".join(self.now).rstrip(" "))
            self.now = []
        self.space = False

    def apart(self, lines: int) -> None:
        self.flush()
        self.gap = max(self.gap, lines)

    def block(self, lines: list[str]) -> None:
        self.flush()
        if lines:
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.lines += lines

    def done(self) -> list[str]:
        self.flush()
        a, z = 0, len(self.lines)
        while a < z and not self.lines[a]:
            a += 1
        while z > a and not self.lines[z - 1]:
            z -= 1
        return self.lines[a:z]


_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)


def _gone(node: Node) -> bool:
    a = node.attrs
    return (
        node.tag in HIDDEN
        or "hidden" in a
        or (node.tag == "dialog" and "open" not in a)
        or ("style" in a and _DISPLAY.search(a["style"]) is not None)
    )


def _whole(value: str | None, default: int, low: int, high: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return min(max(int(m.group(1)), low), high) if m else default


def _flow(node: Node, out: Lines, pre: bool, seen: bool) -> None:
    for c in node.children:
        if isinstance(c, str):
            if seen:
                out.verbatim(c) if pre else out.text(c)
            continue
        if _gone(c):
            continue
        style = _VISIBILITY.search(c.attrs["style"]) if "style" in c.attrs else None
        own = seen if style is None else style.group(1).lower() == "visible"
        tag = c.tag
        if tag == "br":
            if seen:
                out.newline()
        elif tag == "hr":
            out.apart(1)
        elif tag == "table":
            out.apart(1)
            out.block(_table(c, own))
            out.apart(1)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.apart(1 if node.tag != "li" else 0)
            out.block(_list(c, pre, own))
            out.apart(1 if node.tag != "li" else 0)
        elif tag in BLOCK:
            out.apart(1 if tag in APART else 0)
            if tag in ("blockquote", "dd"):
                inner = Lines()
                _flow(c, inner, pre, own)
                out.block(["  " + x if x else x for x in inner.done()])
            elif tag in ("pre", "listing"):
                first = c.children[0] if c.children else None
                if isinstance(first, str) and first[:1] == "\n":  # not part of the text
                    c.children[0] = first[1:]
                _flow(c, out, True, own)
            else:
                _flow(c, out, pre, own)
            out.apart(1 if tag in APART else 0)
        else:
            _flow(c, out, pre or tag in ("textarea", "xmp"), own)


def _list(node: Node, pre: bool, seen: bool) -> list[str]:
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and not _gone(c)]
    backwards = node.tag == "ol" and "reversed" in node.attrs
    n = _whole(node.attrs.get("start"), len(items) if backwards else 1, -(10**9), 10**9)
    out, loose = [], Lines()
    for c in node.children:
        if not (isinstance(c, Node) and c.tag == "li"):
            holder = Node("div", {})
            holder.children = [c]
            _flow(holder, loose, pre, seen)
            continue
        out += ["  " + x for x in loose.done()]
        loose = Lines()
        if _gone(c):
            continue
        n = _whole(c.attrs.get("value"), n, -(10**9), 10**9) if node.tag == "ol" else n
        mark = f"{n}. " if node.tag == "ol" else "- "
        inner = Lines()
        style = _VISIBILITY.search(c.attrs.get("style", ""))
        _flow(c, inner, pre, seen if style is None else style.group(1).lower() == "visible")
        lines = inner.done()
        out += [(mark if i == 0 else " " * len(mark)) + x if x or i == 0 else x for i, x in enumerate(lines)]
        n += -1 if backwards else 1
    return out + ["  " + x for x in loose.done()]


def _rows(node: Node, loose: Lines, seen: bool) -> Iterator[tuple[str, Node, bool]]:
    """Caption, rows and loose content of a table, in order; footers last."""
    late = []
    for c in node.children:
        if isinstance(c, str):
            if seen:
                loose.text(c)
        elif _gone(c):
            continue
        elif c.tag == "tr" or c.tag == "caption":
            yield c.tag, c, seen
        elif c.tag in ("thead", "tbody", "tfoot"):
            style = _VISIBILITY.search(c.attrs.get("style", ""))
            own = seen if style is None else style.group(1).lower() == "visible"
            inner = list(_rows(c, loose, own))
            if c.tag == "tfoot":
                late += inner
            else:
                yield from inner
        elif c.tag in ("td", "th"):
            row = Node("tr", {})
            row.children = [c]
            yield "tr", row, seen
        else:
            holder = Node("div", {})
            holder.children = [c]
            _flow(holder, loose, False, seen)
    yield from late


def _table(node: Node, seen: bool) -> list[str]:
    loose, captions = Lines(), []
    grid: list[list[tuple[int, list[str]]]] = []  # (column, lines) of each row
    below: dict[int, int] = {}  # columns that cells from above still take
    for kind, c, vis in _rows(node, loose, seen):
        if kind == "caption":
            inner = Lines()
            _flow(c, inner, False, vis)
            captions += inner.done()
            continue
        style = _VISIBILITY.search(c.attrs.get("style", ""))
        vis = vis if style is None else style.group(1).lower() == "visible"
        row, col, taken = [], 0, {k: n - 1 for k, n in below.items() if n > 1}
        for d in c.children:
            if isinstance(d, str) or d.tag not in ("td", "th"):
                holder = Node("div", {})
                holder.children = [d]
                _flow(holder, loose, False, vis)
                continue
            if _gone(d):
                continue
            while below.get(col):
                col += 1
            inner = Lines()
            style = _VISIBILITY.search(d.attrs.get("style", ""))
            _flow(d, inner, False, vis if style is None else style.group(1).lower() == "visible")
            wide = _whole(d.attrs.get("colspan"), 1, 1, MAX_SPAN)
            tall = _whole(d.attrs.get("rowspan"), 1, 1, 65534)
            row.append((col, wide, inner.done()))
            if tall > 1:
                taken |= dict.fromkeys(range(col, col + wide), tall - 1)
            col += wide
        below = taken
        grid.append(row)
    width: dict[int, int] = {}
    for row in grid:
        for col, wide, lines in row:
            if wide == 1:
                width[col] = max(width.get(col, 0), min(MAX_ALIGNED, max(map(len, lines), default=0)))
    # a column's place follows from the widths before it; empty ones take none
    place, at = {}, 0
    last = max((col + 1 for row in grid for col, _, _ in row), default=0)
    for col in range(last):
        place[col] = at
        at += width[col] + 2 if width.get(col) else 0
    out = []
    for row in grid:
        for i in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for col, _, lines in row:
                if i < len(lines) and lines[i]:
                    line = line.ljust(place[col]) if len(line) < place[col] or not line else line + "  "
                    line += lines[i]
            out.append(line.rstrip(" "))
    return loose.done() + captions + [x for x in out if x]


def render(page: str) -> str:
    root = Lines()
    _flow(tree(page), root, False, True)
    return "\n".join(root.done())


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id_col`` and text of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sys

        sys.setrecursionlimit(max(sys.getrecursionlimit(), 20 * MAX_NESTING))
        for b in batches:
            pages = b.column("_html")
            for at in range(0, b.num_rows, 256):
                texts = [None if p is None else render(p) for p in pages.slice(at, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("_id").slice(at, 256), pa.array(texts, pa.large_string())], names=["_id", "text"]
                )

    own = df.select(F.col(id_col).alias("_id"), F.col(html_col).alias("_html"))
    out = own.mapInArrow(run, T.StructType([own.schema["_id"], T.StructField("text", T.StringType())]))
    return out.withColumnRenamed("_id", id_col)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op9_html_text": op9_html_text}
ORACLES: dict[str, str] = {}

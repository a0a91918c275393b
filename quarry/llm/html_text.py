"""HTML to text by layout-aware rendering.

A tree builder reads the tags (implied end tags, void and raw-text elements, a missing head
or body), visibility rules drop what a browser would not show, and a renderer lays out the
rest: blocks on lines of their own, an empty line around paragraphs, headings, lists and
tables, list markers with indentation, preformatted text as it stands, and table cells
aligned in columns.  All visible text is kept: navigation and footers too.

Not shown: the head, scripts, styles, templates, fallback content, ``hidden`` elements,
``display:none``, hidden inputs, closed dialogs and what a closed ``details`` holds beside
its summary.  ``visibility`` is inherited: text below ``visibility:hidden`` is left out, but
not that of a descendant with ``visibility:visible``.  A drop-down shows its chosen option
(the last ``selected`` one, else the first that is not disabled), a list box all of them with
their groups' labels; inputs show their ``value`` (not those for passwords, files, ticks and
the like).

Defined cases: NULL or empty pages give an empty text; an empty table stays empty; pages of
any length are read whole, equal pages give equal texts; a column named as the result is
replaced, others stay; a tag that never ends is text; tags that are closed without having
been opened are ignored; nesting may be of any depth (tables more than ``TABLE_DEPTH`` deep
are laid out as plain blocks).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE_DEPTH = 20
COLUMN = 40               # columns are aligned up to this width; longer cells run over

# Fixed sets of HTML element names
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes noscript xmp".split())
HEAD_ONLY = set("base link meta script style title noscript template".split())
UNSEEN = set("head script style template noscript iframe noembed noframes title datalist audio video canvas object".split())
PARAGRAPH = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset menu dir".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
BLOCK = PARAGRAPH | set("address article aside body center dd details dialog div dt figcaption footer form header hgroup "
                        "html legend li main nav optgroup option search section summary tr caption thead tbody tfoot".split())
CLOSES_P = BLOCK - set("body html tr thead tbody tfoot caption option optgroup legend".split()) | {"hr"}
# an opening tag closes these open elements, up to the nearest of its barriers
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table", "tbody", "thead", "tfoot"}),
    **{s: ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for s in ("thead", "tbody", "tfoot")},
}
SCOPE = {"table", "td", "th", "caption", "html", "body"}      # an end tag inside does not close what is outside

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)>""")
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SKIPPED = re.compile(r"""/\*.*?(?:\*/|$)|"[^"]*"|'[^']*'""", re.S)     # comments and strings of CSS
_VISIBILITY = {"visible": True, "initial": True, "hidden": False, "collapse": False}
_VALUE_UNSEEN = set("hidden password checkbox radio file range color image".split())
_TOLD = re.compile(r"hidden|style|type|start|value|open|span|select|multiple|size|label|disabled", re.I)
_BLANK = " \t\n\r\f"


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


def tokens(page: str) -> Iterator[tuple[str, str, dict]]:
    """``(kind, value, attributes)``: text, open or close; comments and declarations are skipped."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], {}
            return
        if lt > at:
            yield "text", page[at:lt], {}
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        gt = page.find(">", lt)
        if gt < 0:
            yield "text", page[lt:], {}
            return
        if page[lt + 1:lt + 2] in ("!", "?"):
            at = gt + 1
            continue
        m = _TAG.match(page, lt)
        if not m:
            yield "text", "<", {}
            at = lt + 1
            continue
        at = m.end()
        name = m[2].lower()
        if m[1]:
            yield "close", name, {}
            continue
        attrs = {}
        if _TOLD.search(m[3]):
            for a in _ATTR.finditer(m[3]):
                attrs.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
        yield "open", name, attrs
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            body = page[at:end.start() if end else n]
            if name in ("textarea", "xmp"):
                yield "text", body, {}
            at = end.start() if end else n


def build(page: str) -> Node:
    """The tree of elements and strings below a root."""
    root = Node("html", {})
    stack = [root]
    count = Counter()          # open elements by name: most searches of the stack need not start
    in_head = False

    def cut_to(i: int) -> None:
        for x in stack[i:]:
            count[x.tag] -= 1
        del stack[i:]

    def close_to(names: set, barriers: set) -> None:
        """Close the open elements up to the outermost of ``names`` this side of a barrier."""
        if not any(count[x] for x in names):
            return
        cut = None
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                cut = i
            elif stack[i].tag in barriers:
                break
        if cut is not None:
            cut_to(cut)

    for kind, value, attrs in tokens(page):
        if kind == "text":
            if in_head and value.strip(_BLANK) and stack[-1].tag == "head":
                cut_to(len(stack) - 1)
                in_head = False
            stack[-1].children.append(value)
        elif kind == "open":
            if value in ("html", "body"):
                if in_head:
                    close_to({"head"}, set())
                    in_head = False
                if _hidden(value, attrs):
                    attrs["hidden"] = ""
                style = f"{root.attrs.get('style', '')};{attrs.get('style', '')}"
                root.attrs = {**root.attrs, **attrs, "style": style}
                continue
            if value == "head":
                in_head = True
            elif in_head and stack[-1].tag == "head" and value not in HEAD_ONLY:
                cut_to(len(stack) - 1)
                in_head = False
            if value in IMPLIED:
                close_to(*IMPLIED[value])
            if value in CLOSES_P:
                close_to({"p"}, SCOPE)
            if value in HEADINGS and stack[-1].tag in HEADINGS:
                cut_to(len(stack) - 1)
            node = Node(value, attrs)
            stack[-1].children.append(node)
            if value not in VOID:
                stack.append(node)
                count[value] += 1
        elif value == "br":
            stack[-1].children.append(Node("br", {}))
        elif value == "p" and not count["p"]:
            stack[-1].children.append(Node("p", {}))
        elif count[value]:
            if value == "head":
                in_head = False
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == value:
                    cut_to(i)
                    break
                if stack[i].tag in SCOPE and value not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th"):
                    break
                if stack[i].tag == "table" and value != "table":
                    break
    return root


def declared(style: str, name: str) -> str:
    """The value that a style attribute gives a property: the last one, an ``!important`` one before others."""
    found, strong = "", False
    for part in _SKIPPED.sub(" ", style).lower().split(";"):
        key, _, value = part.partition(":")
        value, mark, _ = value.partition("!")
        value = value.strip()
        if key.strip() == name and value and (mark or not strong) and (name != "visibility" or value in _VISIBILITY):
            found, strong = value, bool(mark)
    return found


def _hidden(tag: str, attrs: dict) -> bool:
    return ("hidden" in attrs or tag in UNSEEN or (tag == "input" and attrs.get("type", "").lower() == "hidden")
            or (tag == "dialog" and "open" not in attrs)
            or ("style" in attrs and declared(attrs["style"], "display") == "none"))


def drop_invisible(root: Node) -> None:
    """Take away the strings whose inherited ``visibility`` hides them."""
    work = [(root, True)]
    while work:
        node, shown = work.pop()
        if "style" in node.attrs:
            shown = _VISIBILITY.get(declared(node.attrs["style"], "visibility"), shown)
        if not shown:
            node.children = [c for c in node.children if not isinstance(c, str)]
            node.attrs.pop("value", None)
            node.attrs.pop("label", None)
        work.extend((c, shown) for c in node.children if not isinstance(c, str))


def shown_options(select: Node) -> list:
    """What a browser shows of a ``select``: the chosen option in the line, or all in a list box."""
    def text(option):
        label = option.attrs.get("label")
        return [html.escape(label)] if label else option.children

    def block(children):
        node = Node("option", {})
        node.children = children
        return node
    options, rows, work = [], [], [(c, False) for c in reversed(select.children)]
    while work:
        c, off = work.pop()
        if isinstance(c, str):
            continue
        off = off or "disabled" in c.attrs
        if c.tag == "option":
            options.append((c, off))
            if not _hidden(c.tag, c.attrs):
                rows.append(block(text(c)))
        elif not _hidden(c.tag, c.attrs):
            if c.tag == "optgroup" and c.attrs.get("label"):
                rows.append(block([html.escape(c.attrs["label"])]))
            work.extend((x, off) for x in reversed(c.children))
    if "multiple" in select.attrs or _number(select.attrs, "size", 1) > 1:
        return rows
    chosen = ([c for c, _ in options if "selected" in c.attrs][-1:] or [c for c, off in options if not off][:1])
    return [" ", *text(chosen[0]), " "] if chosen else []


class Lines:
    """Collects lines: collapses white space, keeps the larger of the breaks asked for."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False          # white space waits for the next word
        self.gap = 0                # an empty line waits for the next text
        self.indent = ""
        self.marker = ""

    def text(self, s: str) -> None:
        words = s.split()
        if not words:
            self.space = self.space or bool(s)
            return
        lead = self.space or s[0].isspace()
        if lead and self.parts:
            self.parts.append(" ")
        self.parts.append(" ".join(words))
        self.space = s[-1].isspace()

    def line(self, s: str) -> None:
        """A line as it stands, after what waits."""
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        self.lines.append((self.indent + self.marker + s).rstrip())
        if self.marker:
            self.indent += " " * len(self.marker)
            self.marker = ""

    def end_line(self) -> None:
        if self.parts:
            self.line("".join(self.parts))
            self.parts = []
        self.space = False

    def paragraph(self) -> None:
        self.end_line()
        self.gap = 1


def _number(attrs: dict, name: str, default: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", attrs.get(name, ""))
    return int(m[1]) if m else default


def layout(root: Node, depth: int = 0) -> list[str]:
    """The lines of an element's visible content."""
    out = Lines()
    # (node, on leaving) in document order; a list element carries its next number
    work: list[tuple] = [("kids", root, None)]
    lists: list[list] = []
    pre = 0
    while work:
        what, node, kept = work.pop()
        if what == "kids":
            for c in reversed(node.children):
                work.append(("node", c, None))
            continue
        if what == "leave":
            tag = node.tag
            if tag == "pre":
                pre -= 1
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if tag in PARAGRAPH and not (tag in ("ul", "ol", "menu", "dir") and lists):
                out.paragraph()
            else:
                out.end_line()
            if kept is not None:
                out.indent, out.marker = kept, ""
            continue
        if isinstance(node, str):
            s = html.unescape(node)
            if pre:
                first, *rest = s.replace("\r\n", "\n").split("\n")
                if first:
                    out.parts.append(first)
                for r in rest:
                    out.line("".join(out.parts))
                    out.parts = [r] if r else []
            else:
                out.text(s)
            continue
        tag = node.tag
        if _hidden(tag, node.attrs):
            continue
        if tag == "br":
            if out.parts:
                out.end_line()
            elif out.lines:
                out.gap = 1
        elif tag == "hr":
            out.paragraph()
        elif tag == "select":
            for c in reversed(shown_options(node)):
                work.append(("node", c, None))
        elif tag == "input":
            if node.attrs.get("value") and node.attrs.get("type", "").lower() not in _VALUE_UNSEEN:
                out.text(f" {node.attrs['value']} ")
        elif tag == "table" and depth < TABLE_DEPTH:
            out.paragraph()
            for row in table_lines(node, depth + 1):
                out.line(row)
            out.gap = 1
        elif tag == "details" and "open" not in node.attrs:
            out.end_line()
            work.append(("leave", node, None))
            for c in reversed([c for c in node.children if isinstance(c, Node) and c.tag == "summary"]):
                work.append(("node", c, None))
        elif tag in BLOCK:
            kept = None
            if tag in PARAGRAPH and not (tag in ("ul", "ol", "menu", "dir") and lists):
                out.paragraph()
            else:
                out.end_line()
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag == "ol", _number(node.attrs, "start", 1)])
            elif tag == "li":
                kept = out.indent
                numbered = lists and lists[-1][0]
                if numbered:
                    n = _number(node.attrs, "value", lists[-1][1])
                    lists[-1][1] = n + 1
                out.marker = f"{n}. " if numbered else "- "
            elif tag in ("dd", "blockquote"):
                kept = out.indent
                out.indent += "  "
            elif tag == "pre":
                pre += 1
            work.append(("leave", node, kept))
            work.append(("kids", node, None))
        elif tag in ("td", "th"):                       # outside a table, or in one too deep
            out.space = True
            work.append(("kids", node, None))
        else:
            work.append(("kids", node, None))
    out.end_line()
    return out.lines


def table_lines(table: Node, depth: int) -> list[str]:
    """Rows of a table with their cells aligned; captions and stray text on lines of their own."""
    above: list[str] = []
    grid: list[list[list[str] | None]] = []
    held: dict[int, int] = {}                # column -> rows that a cell above still fills
    work = list(reversed(table.children))
    while work:
        c = work.pop()
        if isinstance(c, str):
            if c.strip():
                above.append(" ".join(html.unescape(c).split()))
        elif _hidden(c.tag, c.attrs):
            continue
        elif c.tag in ("thead", "tbody", "tfoot"):
            work.extend(reversed(c.children))
        elif c.tag == "tr":
            row: list[list[str] | None] = []

            def skip():
                while held.get(len(row), 0):
                    held[len(row)] -= 1
                    row.append(None)
            for cell in c.children:
                if isinstance(cell, str):
                    if not cell.strip():
                        continue
                    text, cell = cell, Node("td", {})
                    cell.children.append(text)
                if _hidden(cell.tag, cell.attrs):
                    continue
                skip()
                down = max(1, _number(cell.attrs, "rowspan", 1))
                for k in range(min(1000, max(1, _number(cell.attrs, "colspan", 1)))):   # 1000: HTML's own limit
                    if down > 1:
                        held[len(row)] = min(down, 65534) - 1
                    row.append(layout(cell, depth) if k == 0 else None)
            skip()
            grid.append(row)
        elif c.tag not in ("col", "colgroup"):
            above.extend(layout(_wrapped(c), depth))
    widths: list[int] = []
    for row in grid:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            widths[i] = max([widths[i], *(len(x) for x in cell or () if len(x) <= COLUMN)])
    used = [i for i, w in enumerate(widths) if any(i < len(r) and r[i] for r in grid)]
    lines = above
    for row in grid:
        for k in range(max([len(cell) for cell in row if cell], default=0)):
            cells = [(row[i][k] if i < len(row) and row[i] and k < len(row[i]) else "").ljust(widths[i]) for i in used]
            lines.append("  ".join(cells).rstrip())
    return lines


def _wrapped(node: Node) -> Node:
    out = Node("div", {})
    out.children = [node]
    return out


def page_text(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    root = build(page)
    if _hidden("body", root.attrs):
        return ""
    if "visibility" in page.lower():
        drop_invisible(root)
    return "\n".join(layout(root)).replace("\xa0", " ").strip("\n")


@F.pandas_udf(T.StringType())
def rendered(pages: pd.Series) -> pd.Series:
    return pd.Series([page_text(p) for p in pages], dtype=object)


def extract_text(pages: DataFrame, page: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text of each page in ``into``."""
    return pages.withColumn(into, rendered(F.col(page)))

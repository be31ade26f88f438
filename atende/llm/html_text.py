"""Layout-aware text of HTML pages.

A tokenizer and a tree builder with implied tags turn a page into balanced open, text and close events;
the renderer walks them with an explicit stack, applies visibility rules, and keeps block spacing, list
markers and aligned table cells. All visible text is emitted; nothing is chosen by content.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element classes of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
UNSEEN = {"head", "script", "style", "template", "noscript", "iframe", "noembed", "noframes", "datalist", "object", "audio", "video", "canvas", "svg", "math"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption",
    "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol",
    "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "ul", "xmp", "caption",
}
# Blocks with an empty line before and after.
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "ul", "ol", "dl", "table", "pre", "figure", "menu", "dir", "xmp"}
# Opening one of these closes an open p.
CLOSES_P = BLOCK - {"body", "html", "li", "dd", "dt", "option", "optgroup", "caption", "legend", "select"} | {"li", "dd", "dt"}
# Opening the key closes open elements of the value, looked for up to one of SCOPE.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}), "body": ({"head"}, {"html"}),
}
# Widest cell that others are lined up behind, and deepest indentation; what goes beyond is written all the same.
MOST_WIDTH = 120
MOST_INDENT = 40
# Content that ends the head of a page without a body tag.
HEAD_ONLY = {"base", "link", "meta", "noscript", "script", "style", "template", "title", "head", "html"}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
# Attributes up to the end of a tag, which is no ">" in quotes; possessive, so that nothing is tried twice.
_INSIDE = re.compile(r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*+", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kinds are text, raw (text without entities), open and close."""
    at, text_from, quotes = 0, 0, True
    while (at := page.find("<", at)) >= 0:
        start, name, attrs = at, "", ""
        closing = page.startswith("/", at + 1)
        if page.startswith("<!--", at):
            at = _after(page, "-->", at + 4)
        elif page.startswith("<![CDATA[", at):
            at = _after(page, "]]>", at + 9)
        elif page.startswith(("<!", "<?"), at):
            at = _after(page, ">", at + 2)
        elif m := _NAME.match(page, at + 1 + closing):
            end = _INSIDE.match(page, m.end()).end() if quotes else m.end()
            if not page.startswith(">", end):  # a quote is open to the end of the page: from here on quotes mean nothing
                quotes = False
                end = page.find(">", m.end())
            if end < 0:
                break
            name, attrs, at = m[0].lower(), page[m.end(): end], end + 1
        else:
            at += 1
            continue
        if start > text_from:
            yield "text", page[text_from:start], ""
        text_from = at
        if not name:
            continue
        yield ("close" if closing else "open"), name, attrs
        if name in RAW and not closing:
            m = _RAW_END[name].search(page, at)
            end = m.start() if m else len(page)
            yield ("text" if name in ("textarea", "title") else "raw"), page[at:end], ""
            at = text_from = end
    if text_from < len(page):
        yield "text", page[text_from:], ""


_RAW_END = {name: re.compile(f"</{name}", re.I | re.A) for name in RAW}


def _after(page: str, mark: str, at: int) -> int:
    end = page.find(mark, at)
    return len(page) if end < 0 else end + len(mark)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """Balanced open and close events with implied tags, and texts."""
    stack: list[str] = []
    count: dict[str, list[int]] = {}  # places of each name on the stack

    def push(name: str, attrs: str = "") -> tuple[str, str, str]:
        count.setdefault(name, []).append(len(stack))
        stack.append(name)
        return "open", name, attrs

    def pop() -> tuple[str, str, str]:
        name = stack.pop()
        count[name].pop()
        return "close", name, ""

    def up_to(names: set[str], scope: set[str]) -> int | None:
        """Place of the innermost of the names, unless one of the scope stands above it."""
        found = max((count[n][-1] for n in names if count.get(n)), default=None)
        if found is None or any(count[n][-1] > found for n in scope if count.get(n)):
            return None
        return found

    for kind, name, attrs in tokens(page):
        if kind in ("text", "raw"):
            if count.get("head") and stack[-1] == "head" and name.strip():
                yield pop()
            yield kind, name, ""
        elif kind == "open":
            if count.get("head") and name not in HEAD_ONLY and (i := up_to({"head"}, set())) is not None:
                while len(stack) > i:
                    yield pop()
            if name in CLOSES_P and (i := up_to({"p"}, {"table", "td", "th", "button", "caption"})) is not None:
                while len(stack) > i:
                    yield pop()
            if name in CLOSES:
                while (i := up_to(*CLOSES[name])) is not None:
                    while len(stack) > i:
                        yield pop()
            if name in ("td", "th") and count.get("table") and stack[-1] in ("table", "tbody", "thead", "tfoot"):
                if stack[-1] == "table":
                    yield push("tbody")
                yield push("tr")
            elif name == "tr" and stack and stack[-1] == "table":
                yield push("tbody")
            if name in VOID or attrs.endswith("/") and name in ("svg", "path"):
                yield "open", name, attrs
                yield "close", name, ""
            else:
                yield push(name, attrs)
        elif name == "br":
            yield "open", "br", ""
            yield "close", "br", ""
        elif count.get(name):
            # A cell's content does not close what is open outside the cell.
            i = up_to({name}, set() if name in ("table", "body", "html", "tr", "tbody", "thead", "tfoot", "td", "th") else {"td", "th", "caption"})
            if i is not None:
                while len(stack) > i:
                    yield pop()
        elif name == "p":
            yield "open", "p", ""
            yield "close", "p", ""
    while stack:
        yield pop()


class _Flow:
    """Text in the making: inline runs join with collapsed spaces, blocks go on lines of their own."""

    def __init__(self):
        self.parts: list[str] = []
        self.gap, self.space, self.indent, self.marker = 0, False, 0, ""

    def block(self, lines: int) -> None:
        self.space = False
        if self.parts:
            self.gap = max(self.gap, lines)

    def _start(self) -> None:
        if self.gap or not self.parts:
            if self.parts:
                self.parts.append("\n" * self.gap)
            self.parts.append(" " * (min(self.indent, MOST_INDENT) - len(self.marker)) + self.marker)
            self.gap, self.space, self.marker = 0, False, ""

    def text(self, text: str) -> None:
        words = _SPACE.sub(" ", text)
        body = words.strip(" ")
        if not body:
            self.space |= bool(words) and not self.gap and bool(self.parts)
            return
        lead = self.space or words[0] == " "
        if self.gap or not self.parts:
            self._start()
        elif lead:
            self.parts.append(" ")
        self.parts.append(body)
        self.space = words[-1] == " "

    def line(self, text: str) -> None:
        self._start()
        self.parts.append(text)

    def brk(self) -> None:
        self.space = False
        if self.parts:
            self.gap = min(self.gap + 1, 2)

    def done(self) -> str:
        return "".join(self.parts)


def _columns(rows: list[list[str]]) -> list[str]:
    """Lines of a table whose cells start at the same place; cells of several lines keep their lines."""
    cells = [[c.split("\n") for c in row] for row in rows]
    width = [0] * max(map(len, cells), default=0)
    for row in cells:
        for k, lines in enumerate(row):
            width[k] = max(width[k], min(max(map(len, lines)), MOST_WIDTH))
    out = []
    for row in cells:
        for i in range(max(map(len, row), default=0)):
            line = "  ".join((c[i] if i < len(c) else "").ljust(width[k]) for k, c in enumerate(row)).rstrip()
            out.append(line)
    return [x for x in out if x]


def page_text(page: str | None) -> str:
    """Visible text of a page. Broken markup is read as far as it goes and never raises."""
    flow, flows, tables, lists, hidden, pre = _Flow(), [], [], [], 0, 0
    for kind, name, attrs in events(page or ""):
        if kind in ("text", "raw"):
            if hidden:
                continue
            text = html.unescape(name) if kind == "text" else name
            if pre:
                for i, line in enumerate(text.replace("\r\n", "\n").split("\n")):
                    if i:
                        flow.brk()
                    if line:
                        flow.line(line)
            else:
                flow.text(text)
            continue
        if kind == "open":
            if hidden:
                hidden += name not in VOID
                continue
            if name in UNSEEN or attrs and ("hidden" in attrs or "style" in attrs or "HIDDEN" in attrs or "STYLE" in attrs) and _unseen(name, attrs):
                hidden = int(name not in VOID)
                if name in BLOCK:
                    flow.block(1)
                continue
            if name == "br":
                flow.brk()
            elif name == "hr":
                flow.block(1)
                flow.line("---")
                flow.block(1)
            elif name == "table":
                flow.block(2)
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(flow)
                flow = _Flow()
            elif name in BLOCK:
                flow.block(2 if name in SPACED and not (lists and name in ("ul", "ol")) else 1)
                if name in ("ul", "ol", "menu", "dir"):
                    lists.append(0 if name == "ol" else None)
                    flow.indent += 3 if name == "ol" else 2
                elif name == "li":
                    if lists and lists[-1] is not None:
                        lists[-1] += 1
                        flow.marker = f"{lists[-1]}. "
                    else:
                        flow.marker = "- "
                elif name in ("dd", "blockquote"):
                    flow.indent += 2
                pre += name in ("pre", "xmp")
        else:
            if hidden:
                hidden -= name not in VOID
                continue
            if name == "table" and tables:
                for line in _columns(tables.pop()):
                    flow.line(line)
                    flow.block(1)
                flow.block(2)
            elif name in ("td", "th") and tables and flows:
                cell, flow = flow.done(), flows.pop()
                tables[-1][-1].append(cell)
            elif name in BLOCK and name != "hr":
                flow.block(2 if name in SPACED and not (len(lists) > 1 and name in ("ul", "ol")) else 1)
                if name in ("ul", "ol", "menu", "dir") and lists:
                    flow.indent -= 3 if lists.pop() is not None else 2
                elif name == "li":
                    flow.marker = ""
                elif name in ("dd", "blockquote"):
                    flow.indent -= 2
                pre -= name in ("pre", "xmp")
    return flow.done()


def _unseen(name: str, attrs: str) -> bool:
    found = attributes(attrs)
    return "hidden" in found or bool(_HIDDEN.search(found.get("style", "").lower())) or name == "input" and found.get("type") == "hidden"


def html_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(row, visible_text): every row without its markup, and the text of its page.

    A null page has an empty text. Other columns are carried as a struct and may have any name; repeated rows are
    rendered alike; an empty table gives an empty result.
    """
    rest = [F.col(f"`{c}`") for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*rest).alias("row"), F.col(html_col).alias("page"))

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(p.as_py()) for p in batch.column("page")], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], names=["row", "visible_text"])

    return rows.mapInArrow(render, T.StructType([rows.schema["row"], T.StructField("visible_text", T.StringType())]))

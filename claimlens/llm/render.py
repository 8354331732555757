"""Layout-aware HTML rendering (operator 5).

``tree`` builds the element tree of a page (implied end tags, void elements,
raw-text elements); ``render`` walks it and emits all visible text: blocks on
lines of their own with blank lines where browsers leave a margin, list items
with bullets or numbers and indentation, table rows with their cells aligned in
columns, preformatted text as it is.  Text and elements in a table outside its
cells and captions come before the table, as in browsers.  Not visible are: script, style, template,
head and the like, elements with ``hidden`` or an inline ``display:none`` /
``visibility:hidden``, closed ``details`` beside their summary, and comments.

Both walks keep their own stack, so depth is no limit, and work and output stay
near the page's length: a tag that never ends is text, found by one pass over the
page's quotes; open elements are looked up by their depths; a cell longer than
``WIDE`` stands on a line of its own and widens no column; a table whose padding
would take more than ``PADDING`` times its text (beyond ``ALWAYS`` characters) has
its cells two spaces apart instead; indentation ends at ``INDENT``.  Malformed
pages never raise.

Defined results: null and empty html yield an empty text; repeated rows and null
ids yield a row each.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from claimlens.llm.words import chunks, texts

COMMENT = re.compile(r"<(?:!--.*?(?:-->|\Z)|[!?][^>]*>)", re.S)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
#: The rest of a tag; quotes hide its end.
REST = re.compile(r"([^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"']+))?")
INVISIBLE_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist audio video canvas object svg select".split())
MARGIN = frozenset("address article aside blockquote dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hgroup main nav ol p pre section table ul".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
BLOCK = MARGIN | frozenset("body caption center dd details dialog div dt figcaption html legend li summary tbody tfoot thead tr".split())
CLOSES_P = MARGIN | frozenset("center details dialog div dd dt figcaption hr li summary xmp".split())
TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
TABLE_LEVELS = 16
WIDE, PADDING, ALWAYS, INDENT = 80, 4, 10_000, 64
#: A start tag of the key ends the nearest of these, unless a fence is met first.
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option", "optgroup"),
           "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tfoot", "tr", "td", "th"),
           "thead": ("tbody", "thead", "tfoot", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tfoot", "tr", "td", "th")}
FENCES = {"li": ("ul", "ol", "table"), "dt": ("dl", "table"), "dd": ("dl", "table"), "option": ("select",), "optgroup": ("select",)}
P_FENCES = ("table", "td", "th", "button", "caption")


class Element:
    __slots__ = ("tag", "hidden", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]) -> None:
        self.tag, self.attributes, self.children = tag, attributes, []
        self.hidden = tag in UNSEEN or "hidden" in attributes or bool(INVISIBLE_STYLE.search(attributes.get("style", "")))


class Ends:
    """Which tags of a page end: from every quote or ``>`` outside quotes on, is
    there a ``>`` outside quotes?  Made by one pass from the page's last one."""

    def __init__(self, html: str) -> None:
        self.at = [m.start() for m in re.finditer(r"[>\"']", html)]
        self.ends = [False] * (len(self.at) + 1)
        closing = {"\"": len(self.at), "'": len(self.at)}       # the next quote of its kind
        for k in range(len(self.at) - 1, -1, -1):
            sign = html[self.at[k]]
            if sign == ">":
                self.ends[k] = True
                continue
            self.ends[k] = closing[sign] < len(self.at) and self.ends[closing[sign] + 1]
            closing[sign] = k

    def after(self, at: int) -> bool:
        return self.ends[bisect_left(self.at, at)]


def tags(html: str) -> Iterator[tuple[int, str, str, str]]:
    """(start, slash, name, rest) of tags, and (start, '', '', '') of comments and
    declarations; takes back by ``send`` where to go on."""
    at, last, ends = 0, html.rfind(">"), None
    while (at := html.find("<", at)) >= 0:
        found = None
        if html.startswith("<!--", at) or (at < last and html[at + 1] in "!?"):
            found, name = COMMENT.match(html, at), None
        elif at < last and (name := NAME.match(html, at)) and (ends is None or ends.after(name.end())):
            found = REST.match(html, name.end())
            if found is None and ends is None:
                ends = Ends(html)
        if found is None:
            at += 1
            continue
        go_on = yield (at, found.end(), *((name[1], name[2].lower(), found[1]) if name else ("", "", "")))
        at = found.end() if go_on is None else go_on
        if go_on is not None:
            yield ()                        # what ``send`` returns


def tree(html: str) -> Element:
    """The page's element tree; text nodes are strings."""
    root = Element("", {})
    stack, at = [root], 0
    opened: dict[str, list[int]] = defaultdict(list)            # depths of open elements

    def close(names: tuple, fences: tuple, all_: bool = False) -> None:
        """End the nearest (or with all_ every) open element of ``names`` above
        the nearest fence."""
        if not any(opened[t] for t in names):
            return
        fence = max((opened[t][-1] for t in fences if opened[t]), default=0)
        above = [opened[t][bisect_right(opened[t], fence) if all_ else -1] for t in names if opened[t] and opened[t][-1] > fence]
        if above:
            depth = min(above) if all_ else max(above)
            for e in stack[depth:]:
                opened[e.tag].pop()
            del stack[depth:]

    found = tags(html)
    for start, end, slash, tag, rest in found:
        if start > at:
            stack[-1].children.append(unescape(html[at:start]))
        at = end
        if not tag:
            continue
        if slash:
            if opened[tag]:
                close((tag,), ("table",) if tag in ("p", "li", "dd", "dt", "div", "span", "b", "i", "a") else ())
            continue
        if opened["head"] and tag not in IN_HEAD:
            close(("head",), ())
        if tag in CLOSES_P:
            close(("p",), P_FENCES)
        if tag in IMPLIED:
            close(IMPLIED[tag], FENCES.get(tag, ("table",)), all_=True)
        attributes = {k.lower(): unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(rest)} if rest.strip(" /\n\t\r") else {}
        element = Element(tag, attributes)
        stack[-1].children.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            raw = html[at:end.start() if end else len(html)]
            element.children.append(raw if tag == "xmp" else unescape(raw))
            at = end.end() if end else len(html)
            found.send(at)
        elif tag not in VOID:
            opened[tag].append(len(stack))
            stack.append(element)
    if at < len(html):
        stack[-1].children.append(unescape(html[at:]))
    return root


class Lines:
    """Text laid out in lines; ``gap`` asks for blank lines before the next."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.now: list[str] = []
        self.indent, self.lead, self.blank = 0, "", 0

    def words(self, text: str) -> None:
        shown = " ".join(text.split())
        if shown:
            space = self.now and (text[0].isspace() or self.now[-1][-1:].isspace())
            self.now.append((" " if space and not self.now[-1].endswith(" ") else "") + shown + (" " if text[-1].isspace() else ""))
        elif text and self.now and not self.now[-1].endswith(" "):
            self.now.append(" ")

    def end(self, margin: int = 0) -> None:
        line = "".join(self.now).strip()
        if line:
            self.put(line)
        self.now, self.blank = [], max(self.blank, margin if self.done else 0)

    def put(self, line: str) -> None:
        self.done += [""] * self.blank
        self.blank = 0
        self.done.append((" " * (min(self.indent, INDENT) - len(self.lead)) + self.lead + line).rstrip())
        self.lead = ""

    def text(self) -> str:
        self.end()
        return "\n".join(self.done)


def _cell(e: Element, level: int) -> tuple[str, int]:
    span = e.attributes.get("colspan", "")
    return " ".join(render(e, level).split()), min(int(span), 1000) if span.isdecimal() and int(span) else 1


def _foster(top: Element, parts: list) -> Element:
    """A copy of an element without the table parts in it; those go to ``parts``."""
    kept = Element(top.tag, top.attributes)
    todo = [(c, kept) for c in reversed(top.children)]
    while todo:
        node, at = todo.pop()
        if isinstance(node, Element) and node.tag in TABLE_PARTS:
            parts.append(node)
        elif isinstance(node, str) or node.hidden or node.tag == "table":
            at.children.append(node)
        else:
            copy = Element(node.tag, node.attributes)
            at.children.append(copy)
            todo += [(c, copy) for c in reversed(node.children)]
    return kept


def _table(e: Element, level: int) -> tuple[list, list[str]]:
    """What stands in a table outside its cells and captions, which belongs
    before it; captions and rows with their cells padded to their column's width."""
    before, captions, stack = [], [], [(e, None)]
    rows: list[list[tuple[int, str, int]]] = []                 # (column, text, span) of their cells
    while stack:
        node, row = stack.pop()             # row: that of the cells, if one is open
        if isinstance(node, str):
            before += [node] if node.strip() else []
        elif node.hidden:
            continue
        elif node.tag in ("td", "th"):
            row.append((row[-1][0] + row[-1][2] if row else 0, *_cell(node, level)))
        elif node.tag == "caption":
            captions.append(render(node, level))
        elif node.tag in TABLE_PARTS or node.tag == "table":
            row = []                        # of a tr, or of cells without one
            rows.append(row)
            stack += [(c, row) for c in reversed(node.children)]
        else:
            parts: list[Element] = []
            before.append(_foster(node, parts))
            stack += [(c, row) for c in reversed(parts)]
    return before, captions + _aligned(rows)


def _aligned(rows: list[list[tuple[int, str, int]]]) -> list[str]:
    """Lines of a table's rows, cells padded to their column's width."""
    widths: dict[int, int] = {}
    for row in rows:
        for column, text, _ in row:
            if text:
                widths[column] = max(widths.get(column, 0), len(text) if len(text) <= WIDE else 0)
    places, at = {}, 0
    for column in sorted(widths):
        places[column] = at
        at += widths[column] + 2
    shown = [[(places[column], text) for column, text, _ in row if text] for row in rows]
    padded = sum(row[-1][0] for row in shown if row)
    if padded > ALWAYS + PADDING * sum(len(text) + 2 for row in shown for _, text in row):
        shown = [[(0, text) for _, text in row] for row in shown]
    out = []
    for row in shown:
        line = ""
        for place, text in row:
            if len(text) > WIDE:
                out += [line, text] if line else [text]
                line = ""
            else:
                line = (line + "  " if line and place < len(line) + 2 else line.ljust(place)) + text
        out += [line] if line else []
    return out


def render(top: Element, level: int = 0) -> str:
    """All visible text below ``top``.  Tables in tables are aligned down to
    ``TABLE_LEVELS``; deeper ones keep their text, laid out as blocks."""
    out, todo = Lines(), [(top, "open")]
    numbers: list[int | None] = []
    while todo:
        node, step = todo.pop()
        if step == "rows":
            out.end(1)
            for line in node:
                for part in line.split("\n"):
                    out.put(part)
            out.end(1)
            continue
        if isinstance(node, str):
            out.words(node)
            continue
        tag = node.tag
        if step == "close":
            if tag in ("ul", "ol", "dl"):
                numbers.pop() if tag != "dl" else None
                out.end(0 if numbers else 1)
                out.indent -= 2
            elif tag in BLOCK:
                out.end(1 if tag in MARGIN else 0)
                if tag in ("blockquote", "dd"):
                    out.indent -= 2
            continue
        if node.hidden and node is not top:
            continue
        if tag == "br":
            out.end()
        elif tag == "hr":
            out.end(1)
        elif tag in ("pre", "xmp"):
            out.end(1)
            for line in "".join(_strings(node)).strip("\n").split("\n"):
                out.put(line)
            out.end(1)
        elif tag == "table" and node is not top and level < TABLE_LEVELS:
            before, lines = _table(node, level + 1)
            todo.append((lines, "rows"))
            todo += [(c, "open") for c in reversed(before)]
        else:
            if tag in BLOCK:
                out.end(1 if tag in MARGIN and not (numbers and tag in ("ul", "ol")) else 0)
            if tag in ("ul", "ol", "dl", "blockquote", "dd"):
                out.indent += 2
            if tag in ("ul", "ol"):
                numbers.append(0 if tag == "ol" else None)
            if tag == "li":
                number = numbers[-1] if numbers else None
                if number is not None:
                    numbers[-1] = number + 1
                out.lead = "- " if number is None else f"{number + 1}. "
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Element) and c.tag == "summary"]
            if tag == "textarea" or tag not in RAW:
                todo.append((node, "close"))
                todo += [(c, "open") for c in reversed(children)]
    return out.text()


def _strings(top: Element) -> Iterator[str]:
    todo = list(reversed(top.children))
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            yield node
        elif node.tag == "br":
            yield "\n"
        elif not node.hidden:
            todo += reversed(node.children)


def visible_text(html: str) -> str:
    return render(tree(html)) if html else ""


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "html"):
        made = [visible_text(html.decode("utf-8", "replace")) for html in texts(batch.column("html"))]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(made, pa.string())], names=["page_id", "url", "text"])


def rendered(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars."""
    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return pages.mapInArrow(_run, "page_id long, url string, text string").withColumn("n_chars", F.char_length("text").cast("long"))

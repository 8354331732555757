"""Per-row HTML helper for the X01/G06 Spark jobs (runs inside tasks).

A tolerant tree builder on the stdlib ``html.parser`` (implied end tags for
``p``/``li``/``dt``/``dd``/table cells, void elements, unclosed inline tags
closed by their parent) and a matcher for simple selectors: ``tag``, ``#id``,
``.class``, ``[attr]``, ``[attr=value]``, compounds of those, the descendant
combinator and comma groups.  It is total: malformed input never raises.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP_TEXT = frozenset(("script", "style", "template", "noscript"))
CLOSES_P = frozenset(("address article aside blockquote details dialog div dl fieldset figcaption figure footer "
                      "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
SCOPE_STOP = frozenset(("html", "body", "table", "td", "th", "button", "template"))
LIST_STOP = frozenset(("ul", "ol", "menu")) | SCOPE_STOP
IMPLIED = {"li": ({"li"}, LIST_STOP), "dt": ({"dt", "dd"}, SCOPE_STOP | {"dl"}),
           "dd": ({"dt", "dd"}, SCOPE_STOP | {"dl"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead"}),
           "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select", "datalist"})}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def get(self, name, default=""):
        return self.attrs.get(name, default)

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def texts(self):
        todo = self.children[::-1]          # own stack: depth is no limit
        while todo:
            ch = todo.pop()
            if isinstance(ch, str):
                yield ch
            elif ch.tag not in SKIP_TEXT:
                todo += ch.children[::-1]

    def text(self, strip=True):
        """``get_text(strip=True)``: stripped pieces joined with no separator."""
        parts = (t.strip() for t in self.texts()) if strip else self.texts()
        return "".join(p for p in parts if p)

    def iter(self):
        todo = self.children[::-1]
        while todo:
            ch = todo.pop()
            if not isinstance(ch, str):
                yield ch
                todo += ch.children[::-1]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.stack = [self.root]

    def _close_until(self, names, stop):
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in names:
                del self.stack[i:]
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_until({"p"}, SCOPE_STOP)
        if tag in IMPLIED:
            names, stop = IMPLIED[tag]
            self._close_until(names, stop)
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    try:
        b.feed(html or "")
        b.close()
    except Exception:  # noqa: BLE001 - keep whatever was built
        pass
    return b.root


_TOKEN = re.compile(r"([#.]?[\w-]+|\[[^\]]+\])")


def _compound(text):
    tag, conds = None, []
    for tok in _TOKEN.findall(text):
        if tok.startswith("#"):
            conds.append(("id", tok[1:]))
        elif tok.startswith("."):
            conds.append(("class", tok[1:]))
        elif tok.startswith("["):
            inner = tok[1:-1]
            if "=" in inner:
                k, v = inner.split("=", 1)
                conds.append(("attr=", (k.strip(), v.strip().strip("\"'"))))
            else:
                conds.append(("attr", inner.strip()))
        else:
            tag = tok.lower()
    return tag, conds


def _matches(node, comp):
    tag, conds = comp
    if tag and node.tag != tag:
        return False
    for kind, val in conds:
        if kind == "id" and node.attrs.get("id") != val:
            return False
        if kind == "class" and val not in node.classes():
            return False
        if kind == "attr" and val not in node.attrs:
            return False
        if kind == "attr=" and node.attrs.get(val[0]) != val[1]:
            return False
    return True


def compile_selector(selector: str):
    return [[_compound(part) for part in group.split()] for group in selector.split(",") if group.strip()]


def _match_chain(node, chain):
    if not _matches(node, chain[-1]):
        return False
    i, anc = len(chain) - 2, node.parent
    while i >= 0 and anc is not None:
        if _matches(anc, chain[i]):
            i -= 1
        anc = anc.parent
    return i < 0


def select(root: Node, compiled) -> list:
    """Elements matching any group, in document order, without duplicates."""
    return [n for n in root.iter() if any(_match_chain(n, chain) for chain in compiled)]


def sections(html, section_rules):
    """X01 + X02 for one page: ``[(sec_ord, section, text)]``.  ``first`` rules
    take the first match (kept even when empty), ``all`` rules keep every
    non-empty match; text is cut to the rule's limit (code points)."""
    root = parse(html)
    out = []
    for name, compiled, mode, limit in section_rules:
        hits = select(root, compiled)
        if mode == "first":
            hits = hits[:1]
        for el in hits:
            text = el.text()
            if limit is not None:
                text = text[:limit]
            if mode == "first" or text:
                out.append((len(out), name, text))
    return out


def image_candidates(html, base_url, selector_rules, attributes, max_fallback=5):
    """G06/G07/G10/G13 for one page: ``[(tier, pos, url, raw_src, alt)]``.

    tier 1: every selector (in order) x matching element (document order) x
    attribute (in order) with a non-empty value; a JSON attribute contributes
    its first key (parse error -> skipped; an empty object keeps the raw text).
    tier 2: the first ``max_fallback`` <img> elements with their raw src."""
    root = parse(html)
    out, pos = [], 0
    for compiled in selector_rules:
        for el in select(root, compiled):
            for attr in attributes:
                src = el.get(attr, "")
                if not src:
                    continue
                if attr == "data-a-dynamic-image":
                    try:
                        keys = list(json.loads(src).keys())
                    except Exception:  # noqa: BLE001 - same as a parse failure
                        continue
                    if keys:
                        src = keys[0]
                out.append((1, pos, _join(base_url, src), src, el.get("alt", "")))
                pos += 1
    imgs = [n for n in root.iter() if n.tag == "img"][:max_fallback]
    for i, el in enumerate(imgs):
        src = el.get("src", "")
        out.append((2, i, _join(base_url, src) if src else None, src, el.get("alt", "")))
    return out


def _join(base, src):
    try:
        return urljoin(base or "", src)
    except Exception:  # noqa: BLE001
        return src

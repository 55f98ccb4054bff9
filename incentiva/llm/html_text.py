"""Layout-aware text of HTML pages.

Each page is parsed into a tree with implied tags (open paragraphs, items, cells and rows end
where HTML says so), invisible parts are left out, and the tree is rendered as text: blocks
on lines of their own, a blank line around paragraphs and headings, list markers with indents,
preformatted text as it is, and table cells aligned in columns. Pages are independent rows;
Spark deals them out, a task holds one page's tree at a time. Parsing and rendering are linear in
the page's length and do not recurse, so deep nesting and long pages are safe.

Invisible: script, style, template, the head and comments; elements with ``display: none``; text under
``visibility: hidden`` (a descendant may be visible again); closed ``details`` but for their summary.
Both properties follow the cascade: rules of style elements for a simple tag, class or id (rules inside
at-rules count only in ``@layer`` and in ``@media`` for screen or all without conditions) in order of importance,
specificity and source, then the inline style; ``hidden`` and a closed ``dialog`` are ``display: none``
unless a declaration says otherwise. ``noscript`` is visible, as no script is run.

White space is that of HTML (space, tab, line feed, form feed, carriage return); no-break and other spaces stay.
A cell that spans rows or columns leaves the places it covers empty (colspan up to 1000, as in HTML; rowspan up
to the table's end).

Defined cases: null stays null; an empty page gives the empty text; broken markup never fails, a
``<`` that begins no tag is text, and in a tag a quote opens a value only right after ``=`` and if it
is closed; indents stop at MOST_INDENT columns, tables in more than MOST_TABLES others are laid out as
blocks, and tables of hardly any but covered places (SPARSE) are not aligned, so that the text stays linear in the page. Other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table ul".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure menu dir hr".split())
ENDS_P = BLOCK - frozenset("body html caption legend option optgroup".split())
RAW = frozenset("script style iframe noembed noframes xmp".split())
RAW_TEXT = frozenset(("textarea", "title"))
HIDDEN = frozenset("script style template head title iframe noembed noframes datalist audio video canvas object".split())
#: A start tag ends the open elements of the first set, up to the nearest of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}), "rp": ({"rt", "rp"}, {"ruby"}),
    "body": ({"head"}, {"html"}),
}
#: An end tag does not reach out of these.
FENCE = frozenset("table td th caption button object template".split())
LISTS = frozenset(("ul", "ol", "menu", "dir"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[\s/]+|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*+|))?)*+)>?"
    r"|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"'][^\s>]*+)|))?")
_CSS = re.compile(r"(?P<comment>/\*.*?(?:\*/|\Z))|\\.|\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|\burl\([^)\"']*\)|[{};]|[^{};/\\\"'u]+|.", re.S)
_MEDIA = re.compile(r"((only\s+)?(screen|all))?")
_DECLARED = re.compile(r"\s*(display|visibility)\s*:\s*([a-z-]+(?:\s+[a-z-]+)*)\s*(!\s*important)?\s*", re.I)
_SELECTOR = re.compile(r"([a-z][a-z0-9-]*|\*)?([.#][\w-]+)?")
_SPACES = " \t\n\f\r"
_WORDS = re.compile(r"[^ \t\n\f\r]+")
#: White space of Unicode that is none in HTML: texts with it are split by _WORDS.
_OTHER = re.compile(r"[\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
MOST_INDENT = 80
MOST_TABLES = 16
#: A table with more places than this for each of its cells (and 1000) is not aligned, or its row spans are not followed.
SPARSE = 20

#: What style elements declare: selector -> property -> (important, specificity, position, value) of the strongest.
Rules = dict[str, dict[str, tuple]]


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(s: str) -> dict[str, str]:
    if not s or s.isspace():
        return {}
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(s):
        out.setdefault(name.lower(), a or b or c)
    return out


class _Open:
    """The open elements. Where each tag was last opened is kept, so that no search walks over them."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.at: dict[str, list[int]] = {}  # positions of the open elements of a tag
        self.fences: list[int] = []
        self.walls: list[int] = []  # of blocks and fences

    def push(self, node: Node) -> None:
        k = len(self.nodes)
        self.nodes.append(node)
        self.at.setdefault(node.tag, []).append(k)
        if node.tag in FENCE:
            self.fences.append(k)
        if node.tag in FENCE or node.tag in BLOCK:
            self.walls.append(k)

    def cut(self, k: int) -> None:
        """Close the elements from position k on."""
        for node in self.nodes[k:]:
            self.at[node.tag].pop()
        del self.nodes[k:]
        for marks in (self.fences, self.walls):
            while marks and marks[-1] >= k:
                marks.pop()

    def last(self, tags) -> int:
        """Position of the innermost open element of these tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)


def parse(html: str) -> tuple[Node, Rules]:
    """The tree, and what style elements declare for simple selectors."""
    root = Node("#root", {})
    open_, rules, order, at, low = _Open(root), {}, [0], 0, None
    stack = open_.nodes
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            text = m["text"]
            if text:
                stack[-1].children.append(unescape(text) if "&" in text else text)
            elif m["cdata"]:
                stack[-1].children.append(m["cdata"])
            continue
        tag = tag.lower()
        if m["end"]:
            _end(open_, tag)
            continue
        _imply(open_, tag)
        node = Node(tag, _attributes(m["attrs"]))
        stack[-1].children.append(node)
        if tag in RAW or tag in RAW_TEXT:
            low = html.lower() if low is None else low
            stop = low.find("</" + tag, at) if len(low) == len(html) else _find(html, tag, at)
            stop = len(html) if stop < 0 else stop
            if tag == "style":
                if _on_screen(node.attrs.get("media", "")):
                    _declare(html[at:stop], rules, order)
            elif tag in RAW_TEXT:
                node.children.append(unescape(html[at:stop]))
            at = html.find(">", stop) + 1 or len(html)
        elif tag not in VOID and not (m["attrs"].endswith("/") and tag not in BLOCK and tag in ("svg", "path", "rect", "circle", "use")):
            open_.push(node)
    return root, rules


def _find(html: str, tag: str, at: int) -> int:
    m = re.compile("</" + re.escape(tag), re.I).search(html, at)
    return m.start() if m else -1


def _on_screen(media: str) -> bool:
    """Whether a list of media queries holds on any screen."""
    return any(_MEDIA.fullmatch(q.strip()) for q in media.lower().split(","))


def _declare(css: str, rules: Rules, order: list[int]) -> None:
    # open blocks: selectors (None: no rule that counts), whether rules inside count, own declarations
    blocks: list[tuple[str | None, bool, list[str]]] = []
    part: list[str] = []
    for m in _CSS.finditer(css):
        t = m[0]
        if t == "{":
            head, part = "".join(part).strip(), []
            counts = not blocks or blocks[-1][1]
            name = re.match(r"@[\w-]*", head)
            inside = counts and name is not None and (
                name[0].lower() == "@layer" or name[0].lower() == "@media" and _on_screen(head[name.end():]))
            blocks.append((head if counts and not name else None, inside, []))
        elif t == "}" or t == ";":
            if blocks:
                blocks[-1][2].append("".join(part))
            part = []
            if t == "}" and blocks:
                selectors, _, body = blocks.pop()
                declared = [d for d in map(_DECLARED.fullmatch, body) if d] if selectors else []
                for s in (x.strip().lower() for x in selectors.split(",")) if declared else ():
                    m2 = _SELECTOR.fullmatch(s)
                    if s and m2:
                        weight = (10000 if "#" in s else 100 if "." in s else 0) + (m2[1] not in (None, "*"))
                        s = s[1:] if s[0] == "*" and len(s) > 1 else s
                        own = rules.setdefault(s, {})
                        for d in declared:
                            order[0] += 1
                            new, p = (d[3] is not None, weight, order[0], d[2].lower()), d[1].lower()
                            own[p] = max(own.get(p, new), new)
        elif m["comment"] is None:
            part.append(t)


def _end(open_: _Open, tag: str) -> None:
    if tag == "br":
        open_.nodes[-1].children.append(Node("br", {}))
        return
    k = open_.last((tag,))
    fence = open_.fences[-1] if open_.fences else 0
    if k and (k >= fence or tag in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "body", "html")):
        open_.cut(k)
    elif tag == "p":
        open_.nodes[-1].children.append(Node("p", {}))


def _imply(open_: _Open, tag: str) -> None:
    if tag in ENDS:
        ended, fence = ENDS[tag]
        k = open_.last(ended)
        if k > open_.last(fence):
            while k > 1 and open_.nodes[k - 1].tag in ended:
                k -= 1
            open_.cut(k)
    if tag in ENDS_P and open_.walls and open_.nodes[open_.walls[-1]].tag == "p":
        open_.cut(open_.walls[-1])


class Writer:
    """Lines of a block of text: white space collapsed, gaps between blocks, indents and list markers."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.gap = 0  # line ends due before the next text: 1 new line, 2 blank line
        self.space = False
        self.indent = 0
        self.marker = ""

    def block(self, gap: int) -> None:
        self.gap = max(self.gap, gap)
        self.space = False

    def _flush(self) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip(_SPACES))
            self.now = []

    def _open(self) -> None:
        if self.gap:
            self._flush()
            if self.gap > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap = 0
        if not self.now:
            self.now.append(" " * min(self.indent, MOST_INDENT) + self.marker)
            if self.marker:
                self.indent += len(self.marker)
                self.marker = ""
            self.space = False

    def text(self, s: str) -> None:
        words = _WORDS.findall(s) if _OTHER.search(s) else s.split()
        if not words:
            self.space = True
            return
        lead = self.space or s[0] in _SPACES
        fresh = not self.now or self.gap
        self._open()
        if lead and not fresh:
            self.now.append(" ")
        self.now.append(" ".join(words))
        self.space = s[-1] in _SPACES

    def literal(self, s: str) -> None:
        """Preformatted text or finished lines."""
        for k, line in enumerate(s.split("\n")):
            if k:
                self.line_end()
            if line:
                self._open()
                self.now.append(line)

    def line_end(self) -> None:
        if self.gap or not self.now:
            if self.lines or self.now:
                self._flush()
                self.gap = 0
                self.lines.append("")
            return
        self._flush()
        self.space = False

    def done(self) -> str:
        self._flush()
        return "\n".join(self.lines).strip("\n")


#: Columns are aligned up to this width; longer cells run over.
WIDEST = 60


def align(rows: list[list[str]]) -> str:
    """Rows of cell texts (None: covered by a cell to its left) as lines with aligned columns."""
    widths: list[int] = []
    split = [[c.split("\n") for c in row] for row in rows]
    for row in split:
        for k, cell in enumerate(row):
            if k == len(widths):
                widths.append(0)
            widths[k] = max(widths[k], min(WIDEST, max(map(len, cell))))
    lines = []
    for row in split:
        for k in range(max(map(len, row), default=0)):
            lines.append("  ".join((cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(row, widths)).rstrip(" "))
    return "\n".join(lines)


def _span(node: Node, name: str, most: int) -> int:
    """A span attribute as HTML reads it: leading digits, 1 if there are none."""
    m = re.match(r"[ \t\n\f\r]*\+?(\d{1,9})", node.attrs.get(name, ""))
    return min(int(m[1]), most) if m else 1


def grid(rows: list[list[tuple[str, int, int]]]) -> list[list[str]]:
    """Rows of (text, columns, rows) cells as rows of texts by column; the places that a cell covers beyond its first are empty.

    Only columns in which a cell begins are kept, so wide spans cost nothing.
    """
    lines: list[dict[int, str]] = []
    covered: list[tuple[int, int, int]] = []  # columns [from, to) that cells from above hold, until a row
    for r, row in enumerate(rows):
        covered = [c for c in covered if c[2] > r]
        line, held, at, k = {}, [], 0, 0
        for text, wide, high in row:
            while k < len(covered) and covered[k][0] <= at:
                at = max(at, covered[k][1])
                k += 1
            line[at] = text
            if high > 1 and held and held[-1][1:] == (at, r + high):
                held[-1] = (held[-1][0], at + wide, r + high)
            elif high > 1:
                held.append((at, at + wide, r + high))
            at += wide
        covered = sorted(covered + held) if held else covered
        lines.append(line)
    places = {c: k for k, c in enumerate(sorted({c for line in lines for c in line}))}
    out = []
    for line in lines:
        out.append([""] * (1 + max((places[c] for c in line), default=-1)))
        for c, text in line.items():
            out[-1][places[c]] = text
    return out


class _Table:
    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []

    def text(self) -> str:
        n = len(self.rows)
        rows = [[(t, w, n - r if h == 0 else min(h, n - r)) for t, w, h in row] for r, row in enumerate(self.rows)]
        most = SPARSE * sum(map(len, rows)) + 1000
        if sum(h for row in rows for _, _, h in row if h > 1) > most:
            rows = [[(t, w, 1) for t, w, _ in row] for row in rows]
        lines = [r for r in grid(rows) if any(r)]
        if sum(map(len, lines)) > most:
            lines = [["  ".join(filter(None, r))] for r in lines]
        return align(lines)


def _declared(node: Node, rules: Rules) -> dict[str, str]:
    """The element's own display and visibility by the cascade: importance, specificity, order, the inline style over sheets."""
    found: dict[str, tuple] = {}
    if rules:
        names = ["*", node.tag]
        for c in node.attrs.get("class", "").lower().split():
            names += ["." + c, node.tag + "." + c]
        if "id" in node.attrs:
            names += ["#" + node.attrs["id"].lower(), node.tag + "#" + node.attrs["id"].lower()]
        for name in names:
            for p, d in rules.get(name, {}).items():
                if p not in found or found[p] <= d:
                    found[p] = d
    style = node.attrs.get("style")
    if style:
        for k, part in enumerate(style.split(";")):
            m = _DECLARED.fullmatch(part)
            if m:
                d = (m[3] is not None, 1_000_000, k, m[2].lower())
                if m[1].lower() not in found or found[m[1].lower()] <= d:
                    found[m[1].lower()] = d
    return {p: d[3] for p, d in found.items()}


def _visible(node: Node, declared: dict[str, str]) -> bool:
    if node.tag in HIDDEN:
        return False
    if "display" in declared:
        return declared["display"] != "none"
    return "hidden" not in node.attrs and not (node.tag == "dialog" and "open" not in node.attrs)


def render(root: Node, rules: Rules) -> str:
    out = Writer()
    tables: list[_Table] = []
    lists: list[int | None] = []  # the next number of each open list, None for bullets
    seen, pre, deep = [True], 0, 0  # deep: open tables that are laid out as blocks
    # (node, position of the next child, what to restore at the end)
    stack: list[list] = [[root, 0, None]]
    while stack:
        frame = stack[-1]
        node, k, saved = frame
        if k < len(node.children):
            frame[1] += 1
            child = node.children[k]
            if isinstance(child, str):
                if seen[-1] and not (node.tag == "details" and "open" not in node.attrs):
                    out.literal(child) if pre else out.text(child)
                continue
            tag = child.tag
            if tag == "br":
                out.line_end()
                continue
            declared = _declared(child, rules) if rules or "style" in child.attrs else {}
            if not _visible(child, declared) or (node.tag == "details" and tag != "summary" and "open" not in node.attrs):
                continue
            how = declared.get("visibility")
            seen.append(how == "visible" if how in ("visible", "hidden", "collapse") else seen[-1])
            keep: tuple = (out.indent, out.marker)
            if tag in ("td", "th") and deep:
                out.block(1)
            elif tag in ("td", "th"):
                keep = (out, lists)
                out, lists = Writer(), []
            elif tag == "table" and len(tables) > MOST_TABLES:
                deep += 1
                out.block(2)
            elif tag == "table":
                out.block(2)
                tables.append(_Table())
            elif tag == "tr" and tables and not deep:
                tables[-1].rows.append([])
            elif tag in BLOCK:
                out.block(2 if tag in SPACED and not (tag in LISTS and lists) else 1)
            if tag in LISTS:
                start = child.attrs.get("start", "1")
                lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else 1 if tag == "ol" else None)
            elif tag == "li":
                if lists and lists[-1] is not None:
                    out.marker = f"{lists[-1]}. "
                    lists[-1] += 1
                else:
                    out.marker = "- "
            elif tag in ("dd", "blockquote"):
                out.indent += 2
            elif tag == "pre":
                pre += 1
            stack.append([child, 0, keep])
            continue
        stack.pop()
        if saved is None:
            break
        seen.pop()
        tag = node.tag
        if tag in ("td", "th") and deep:
            out.block(1)
            continue
        if tag in ("td", "th"):
            text = out.done()
            out, lists = saved
            if tables:
                if not tables[-1].rows:
                    tables[-1].rows.append([])
                tables[-1].rows[-1].append((text, max(1, _span(node, "colspan", 1000)), _span(node, "rowspan", 65534)))
            else:
                out.text(" " + text + " ")
            continue
        if tag == "table" and deep:
            deep -= 1
            out.block(2)
        elif tag == "table":
            text = tables.pop().text()
            if text:
                out.block(1)
                out.literal(text)
            out.block(2)
        elif tag in BLOCK:
            out.block(2 if tag in SPACED and not (tag in LISTS and len(lists) > 1) else 1)
        if tag in LISTS:
            lists.pop()
        elif tag == "pre":
            pre -= 1
        if tag == "li" or tag in ("dd", "blockquote"):
            out.indent, out.marker = saved
    return out.done()


def page_text(html: str | None) -> str | None:
    """The visible text of one page."""
    return None if html is None else render(*parse(html))


def _extract(batches: Iterator[pa.RecordBatch], html_at: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in text_slices(whole, html_at):
            text = pa.array([page_text(x) for x in b.column(html_at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != html_at), text],
                                             [*(n for i, n in enumerate(b.schema.names) if i != html_at), "text"])


def extract_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` with ``html_col`` replaced by the visible text, as the last column, ``text_col``."""
    names = pages.columns
    at = names.index(html_col)
    df = pages.select(*[F.col(f"`{c}`").cast("string").alias(f"c{i}") if i == at else F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = T.StructType([f for i, f in enumerate(df.schema) if i != at] + [T.StructField("text", T.StringType())])
    return df.mapInArrow(partial(_extract, html_at=at), schema).toDF(*[c for i, c in enumerate(names) if i != at], text_col)

"""Layout-aware rendering of raw web pages to all their visible text.

A page is parsed to a tree (with implied ends and beginnings of elements), and the tree is rendered: blocks on lines of
their own, paragraphs and headings apart by a blank line, lists with markers and indents, table cells in aligned
columns, preformatted text as it is, and nothing that is hidden. Formulas, text in drawings, the contents of text fields
and the chosen option of a selection (all options of a list that shows several) are shown, tokens of formulas and pieces
of drawings apart by a space. Choice: noscript, and what object, audio, video and canvas hold in case they cannot be
shown, are not.

Every character is read a constant number of times, also on broken pages: a tag whose end or closing quote is missing
takes the rest of the page with it, as in browsers, and open elements are looked up by name, not by walking up the tree.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript title iframe noembed noframes object audio video canvas datalist".split())
#: Elements of drawings and formulas that are not shown themselves, and those whose text stands apart.
FOREIGN = {
    "svg": frozenset("desc defs symbol metadata clippath mask pattern marker".split()),
    "math": frozenset(("annotation", "annotation-xml")),
}
SPACED = frozenset("svg math text mi mn mo ms mtext textarea".split())
HEAD_ONLY = frozenset("base link meta title script style template noscript head".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
BLOCK = APART | frozenset(
    "address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main menu nav "
    "optgroup search section summary tr caption tbody thead tfoot td th".split()
)
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(("td", "th"))
CHOICE = frozenset(("select", "option"))
ROW_GROUPS = frozenset(("tbody", "thead", "tfoot"))
ENDS_P = BLOCK - frozenset("body html option optgroup tr caption tbody thead tfoot td th".split())
#: (elements that a start tag ends, elements that stop the search)
IMPLIED_END = {
    "li": (frozenset(("li",)), LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (CELLS, frozenset(("table", "tr"))),
    "th": (CELLS, frozenset(("table", "tr"))),
    "tr": (CELLS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tbody": (CELLS | ROW_GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "thead": (CELLS | ROW_GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "tfoot": (CELLS | ROW_GROUPS | {"tr", "caption", "colgroup"}, frozenset(("table",))),
    "caption": (CELLS | {"tr", "caption"}, frozenset(("table",))),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/><\"'=]*)>")
_GAP = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"=?[^\s=/>]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")

#: Largest colspan and rowspan, as in HTML.
COLSPAN, ROWSPAN = 1000, 65534
#: Blanks that align a table may be so many times its text (and some thousand); beyond that its longest cells stay whole
#: but do not widen the rows around them.
PADDING = 16
#: Depth of lists and quotations up to which lines are indented, and of tables up to which cells are aligned; below that
#: lines and cells follow one another. A page of nothing but nested lists would else be rendered to its square.
INDENTED, NESTED = 64, 16


class Node:
    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []


def _tag(html: str, at: int) -> tuple[bool, str, dict[str, str], bool, int] | None:
    """(whether it ends an element, name, attributes, whether it ends in a slash, place after it) of the tag at a place.

    None if the page ends in it.
    """
    plain = _PLAIN.match(html, at)
    if plain:
        return bool(plain[1]), plain[2].lower(), {}, False, plain.end()
    ends = html[at + 1] == "/"
    name = _NAME.match(html, at + 1 + ends)
    at, n, found = name.end(), len(html), {}
    while True:
        at = _GAP.match(html, at).end()
        if at >= n:
            return None
        if html[at] == ">":
            return ends, name[0].lower(), found, html[at - 1] == "/", at + 1
        key = _ATTRIBUTE.match(html, at)
        at, value = key.end(), ""
        equals = _EQUALS.match(html, at)
        if equals:
            at = equals.end()
            quote = html[at : at + 1]
            if quote in ("'", '"') and quote:
                stop = html.find(quote, at + 1)
                if stop < 0:
                    return None
                value, at = html[at + 1 : stop], stop + 1
            else:
                bare = _UNQUOTED.match(html, at)
                value, at = bare[0], bare.end()
        found.setdefault(key[0].lower(), unescape(value) if "&" in value else value)


class _Open:
    """The open elements, outermost first, and where those of each name stand."""

    def __init__(self, root: Node):
        self.stack: list[Node | None] = [root]
        self.places: dict[str, list[int]] = {"html": [0]}
        self.blocks: list[int] = []

    @property
    def top(self) -> Node:
        return self.stack[-1]

    def push(self, node: Node) -> None:
        k = len(self.stack)
        self.stack.append(node)
        self.places.setdefault(node.tag, []).append(k)
        if node.tag in BLOCK:
            self.blocks.append(k)

    def close(self, upto: int) -> None:
        """Ends the elements from a place on, and those below it that ended before their contents."""
        while len(self.stack) > upto or self.stack[-1] is None:
            node = self.stack.pop()
            if node is not None:
                self.places[node.tag].pop()
                if node.tag in BLOCK:
                    self.blocks.pop()

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of one of these names, or -1."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def first_after(self, tags: frozenset[str], place: int) -> int:
        """Place of the outermost open element of one of these names behind a place, or -1."""
        found = []
        for t in tags:
            own = self.places.get(t)
            if own and own[-1] > place:
                found.append(own[bisect_right(own, place)])
        return min(found, default=-1)

    def end_inside(self, place: int) -> None:
        """Ends the innermost element of its name while blocks within it stay open."""
        self.places[self.stack[place].tag].pop()
        self.stack[place] = None


def parse(html: str) -> Node:
    """The tree of a page. Whatever the page lacks or misplaces, every piece of text ends up in it."""
    root = Node("html", {})
    open_, at, n, begun = _Open(root), 0, len(html), False

    def put(tag: str, attrs: dict[str, str]) -> Node:
        nonlocal begun
        node, begun = Node(tag, attrs), True
        open_.top.kids.append(node)
        if tag not in VOID:
            open_.push(node)
        return node

    def text(value: str) -> None:
        nonlocal begun
        begun = begun or not value.isspace()
        if len(open_.stack) > 1 and open_.top.tag == "head" and not value.isspace():
            open_.close(len(open_.stack) - 1)
        open_.top.kids.append(unescape(value) if "&" in value else value)

    while at < n:
        start = html.find("<", at)
        if start != at:
            text(html[at:start] if start >= 0 else html[at:])
            if start < 0:
                break
            at = start
        follows = html[at + 1 : at + 2]
        if follows in ("!", "?") and follows:
            comment = html.startswith("<!--", at)
            stop = html.find("-->", at + 4) if comment else html.find(">", at)
            if stop < 0:
                break
            at = stop + (3 if comment else 1)
            continue
        if not (follows.isascii() and follows.isalpha()) and not (follows == "/" and html[at + 2 : at + 3].isascii() and html[at + 2 : at + 3].isalpha()):
            text("<")
            at += 1
            continue
        read = _tag(html, at)
        if read is None:  # an unfinished tag at the end, as browsers drop it
            break
        ends, tag, attrs, empty, at = read
        if ends:
            if tag == "br":
                put("br", {})
            elif tag == "p" and open_.last("p") < 0:
                put("p", {})
                open_.close(len(open_.stack) - 1)
            elif tag not in ("body", "html"):
                k = open_.last(tag)
                if k > 0 and (k > open_.last(*CELLS) or tag in ("table", "tr", *CELLS, *ROW_GROUPS)):
                    if tag in FORMATTING and open_.blocks and open_.blocks[-1] > k:
                        open_.end_inside(k)  # only it ends, the blocks in it stay open
                    else:
                        open_.close(k)
            continue
        if tag in ("html", "body"):
            (root.attrs if tag == "html" else attrs).update(attrs)
            if open_.last("head") > 0:
                open_.close(open_.places["head"][0])
            if tag == "body" and open_.last("body") < 0:
                put(tag, attrs)
            continue
        if tag == "head" and begun:
            continue  # too late for a head
        if open_.top.tag == "head" and tag not in HEAD_ONLY:
            open_.close(len(open_.stack) - 1)
        if tag in ENDS_P:
            k = open_.last("p")
            if k > 0 and k > open_.last("td", "th", "table", "button", "caption"):
                open_.close(k)
        if tag in IMPLIED_END:
            ended, stop = IMPLIED_END[tag]
            k = open_.first_after(ended, max(0, open_.last(*stop)))
            if k > 0:
                open_.close(k)
        if tag in CELLS and open_.top.tag in ("table", *ROW_GROUPS):
            put("tr", {})
        put(tag, attrs)
        if empty and tag not in VOID and open_.last(*FOREIGN) > 0:
            open_.close(len(open_.stack) - 1)  # drawings and formulas have empty elements
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else n
            open_.top.kids.append(unescape(html[at:stop]) if tag in ("textarea", "title") else html[at:stop])
            at = stop
    return root


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    if node.tag == "dialog" and "open" not in node.attrs:
        return False
    style = node.attrs.get("style")
    return not (style and _STYLE.search(style))


class _Lines:
    """Lines of one flow of text; white space collapses, blank lines come between blocks that keep apart."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.apart = False
        self.marker, self.indents = "", []

    def text(self, value: str) -> None:
        lead, trail = value[:1] in " \t\n\r\f", value[-1:] in " \t\n\r\f"
        value = _SPACE.sub(" ", value).strip(" ")
        if not value:
            self.space = self.space or lead
            return
        if self.parts and (self.space or lead):
            self.parts.append(" ")
        self.parts.append(value)
        self.space = trail

    def end_line(self, always: bool = False) -> None:
        if self.parts or always:
            self.line("".join(self.parts))
        self.parts, self.space = [], False

    def line(self, value: str) -> None:
        if self.apart and self.lines and self.lines[-1]:
            self.lines.append("")
        self.apart = False
        indent = "".join(self.indents[:INDENTED])
        if self.marker:
            within = len(self.indents) <= INDENTED
            indent = (indent[: len(indent) - len(self.marker)] if within else indent) + self.marker
            self.marker = ""
        self.lines.append((indent + value).rstrip())


def _placed(rows: list[list[tuple[list[str], int, int]]]) -> list[dict[int, tuple[list[str], int]]]:
    """For each row the cells by their column. A cell is (lines, colspan, rowspan); cells from above take their columns."""
    grid: list[dict[int, tuple[list[str], int]]] = []
    covered: list[tuple[int, int, int]] = []  # (column, column after, rows) that cells above still cover, in order
    for row in rows:
        placed, column, k, new = {}, 0, 0, []
        for lines, across, down in row:
            while k < len(covered) and covered[k][0] <= column:
                column = max(column, covered[k][1])
                k += 1
            placed[column] = (lines, across)
            if down > 1:
                new.append((column, column + across, down - 1))
            column += across
        merged: list[tuple[int, int, int]] = []
        for a, b, left in sorted([(a, b, left - 1) for a, b, left in covered if left > 1] + new):
            if merged and merged[-1][1] == a and merged[-1][2] == left:
                merged[-1] = (merged[-1][0], b, left)
            else:
                merged.append((a, b, left))
        covered = merged
        grid.append(placed)
    return grid


def _columns(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Lines of a table, each column as wide as its widest cell of one column."""
    grid = _placed(rows)
    sizes: dict[int, list[int]] = {}
    shown = 0
    for placed in grid:
        for column, (lines, across) in placed.items():
            sizes.setdefault(column, []).append(max(map(len, lines), default=0) if across == 1 else 0)
            shown += sum(map(len, lines))
    limit = max((max(s) for s in sizes.values()), default=0)
    while True:
        widths = {c: max((x for x in s if x <= limit), default=0) for c, s in sizes.items()}
        starts, at = {}, 0
        for c in sorted(widths):
            starts[c] = at
            at += widths[c] + 2 if widths[c] else 0
        if limit < 2 or sum(starts[max(placed)] * max(len(x) for x, _ in placed.values()) for placed in grid if placed) <= PADDING * shown + 10_000:
            break
        limit //= 2
    out = []
    for placed in grid:
        for k in range(max((len(lines) for lines, _ in placed.values()), default=0)):
            parts, size = [], 0
            for c, (lines, _) in placed.items():
                if k < len(lines) and lines[k]:
                    gap = max(starts[c] - size, 2 if size else 0)
                    parts += [" " * gap, lines[k]]
                    size += gap + len(lines[k])
            out.append("".join(parts))
    return out


def _span(node: Node, name: str, most: int) -> int:
    value = node.attrs.get(name, "1").strip()
    if not (value.isascii() and value.isdigit()) or len(value) > 9:
        return 1
    value = int(value)
    if name == "rowspan":
        return most if value == 0 else min(most, value)  # 0: down to the end of the table
    return value if 0 < value <= most else 1


def _options(select: Node) -> list[Node]:
    """The options that a selection shows: all of a list, else the one chosen last, else the first that can be chosen."""
    found, todo = [], list(reversed(select.kids))
    while todo:
        node = todo.pop()
        if isinstance(node, Node) and visible(node):
            if node.tag == "option":
                found.append(node)
            else:
                todo += reversed(node.kids)
    size = select.attrs.get("size", "1").strip()
    if "multiple" in select.attrs or (size.isascii() and size.isdigit() and int(size[:9]) > 1):
        return found
    chosen = [o for o in found if "selected" in o.attrs]
    return chosen[-1:] or [o for o in found if "disabled" not in o.attrs][:1] or found[:1]


def render(root: Node) -> str:
    """All visible text of a tree. Walks with a stack of its own, so nesting may be of any depth."""
    out = _Lines()
    flows, tables, counters, pre = [out], [], [], 0
    foreign: list[str] = []
    todo: list[tuple] = [("enter", root)]
    while todo:
        step, node = todo.pop()
        flow = flows[-1]
        if step == "text":
            if pre:
                first, *rest = node.split("\n")
                flow.parts.append(first)
                for line in rest:
                    flow.end_line(always=True)
                    flow.parts.append(line)
            else:
                flow.text(node)
            continue
        tag = node.tag
        if step == "enter":
            if not visible(node) or (foreign and tag in FOREIGN[foreign[-1]]):
                continue
            if tag in SPACED and (foreign or tag in FOREIGN or tag == "textarea"):
                flow.space = True
            if tag in CHOICE:
                flow.space = True
            if tag == "br":
                flow.end_line(always=True)
                continue
            if tag == "img" or tag == "input":
                shown = node.attrs.get("alt" if tag == "img" else "value", "")
                if shown and node.attrs.get("type", "").lower() not in ("hidden", "password", "checkbox", "radio"):
                    flow.text(f" {shown} " if tag == "input" else shown)
                continue
            if tag in BLOCK or tag == "hr":
                if not (flow.marker and not flow.parts):
                    flow.end_line()
                if tag in APART and not (tag in LISTS and counters):
                    flow.apart = flow.apart or bool(flow.lines)
            if tag in VOID:
                continue
            if tag in LISTS:
                start = node.attrs.get("start", "1")
                counters.append(int(start) if tag == "ol" and start.lstrip("-").isdecimal() and len(start) < 10 else (1 if tag == "ol" else None))
            elif tag == "li":
                number = counters[-1] if counters else None
                if number is not None:
                    counters[-1] = number + 1
                flow.marker = "- " if number is None else f"{number}. "
                flow.indents.append(" " * len(flow.marker))
            elif tag in ("dd", "blockquote"):
                flow.indents.append("  ")
            elif tag == "pre":
                pre += 1
            elif tag in FOREIGN:
                foreign.append(tag)
            elif tag == "textarea":
                value = "".join(node.kids).removeprefix("\n").rstrip("\n")
                first, *rest = value.split("\n")
                if value and flow.parts and not pre:
                    flow.parts.append(" ")
                flow.parts += [first] if first else []
                for line in rest:
                    flow.end_line(always=True)
                    flow.parts += [line] if line else []
                flow.space = True
                continue
            elif tag == "select":
                todo.append(("leave", node))
                todo += [("enter", option) for option in reversed(_options(node))]
                continue
            elif tag == "table":
                tables.append([] if len(tables) < NESTED else None)
            elif tag == "tr" and tables and tables[-1] is not None:
                tables[-1].append([])
            elif tag in CELLS and tables and tables[-1] is not None:
                if not tables[-1]:
                    tables[-1].append([])
                flows.append(_Lines())
            todo.append(("leave", node))
            for kid in reversed(node.kids):
                todo.append(("text", kid) if isinstance(kid, str) else ("enter", kid))
            continue
        if tag in FOREIGN:
            foreign.pop()
        if tag in SPACED and (foreign or tag in FOREIGN):
            flow.space = True
        if tag in CHOICE:
            flow.space = True
        if tag in CELLS and tables and tables[-1] is not None:
            flow.end_line()
            flows.pop()
            tables[-1][-1].append((flow.lines, _span(node, "colspan", COLSPAN), _span(node, "rowspan", ROWSPAN)))
            continue
        if tag in BLOCK:
            if tag == "pre":
                pre -= 1
                while flow.parts and not "".join(flow.parts).strip():
                    flow.parts = []
            flow.end_line()
            if tag == "table":
                for line in _columns(tables.pop() or []):
                    flow.line(line)
            elif tag == "li":
                if flow.marker:
                    flow.line("")
                flow.indents.pop()
            elif tag in ("dd", "blockquote"):
                flow.indents.pop()
            elif tag in LISTS:
                counters.pop()
            if tag in APART and not (tag in LISTS and counters):
                flow.apart = flow.apart or bool(flow.lines)
    out.end_line()
    lines = out.lines
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


def extract(html: str | None) -> str | None:
    return None if html is None else render(parse(html))


def extract_text(df: DataFrame, html: str = "html", key: str = "page_id") -> DataFrame:
    """key, text (null for a null page), n_chars and n_lines of every page.

    Empty pages and pages without visible text give the empty text, 0 characters and 0 lines; a null page the counts 0.
    A null key stays null; repeated rows give repeated results. Only key and html are read.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page.as_py()) for page in batch.column(1)]
            columns = [
                batch.column(0),
                pa.array(texts, pa.string()),
                pa.array([len(t or "") for t in texts], pa.int64()),
                pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "text", "n_chars", "n_lines"])

    return df.select(key, html).mapInArrow(run, f"key {kind}, text string, n_chars long, n_lines long").withColumnRenamed("key", key)

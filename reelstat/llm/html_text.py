"""Visible text of HTML pages, laid out as a text browser would.

A tree builder adds the tags that authors leave out, visibility rules (elements, attributes and the
page's own style sheets) take out what is not shown, and a renderer keeps blocks apart, marks list
items and aligns the cells of tables. Style sheets count as on a screen of ``SCREEN`` pixels, by
importance, layer, specificity and order; of their rules those with simple selectors (a tag, classes
and ids) are read, and at-rules whose condition is not known are not applied.

Defined results: a null or empty page gives an empty text; broken markup is read as a browser would,
unknown tags are inline; deep nesting needs no recursion; a null id is kept; equal rows give equal
rows; an empty table gives an empty one; only id, html and the columns asked for are read. A cell wider
than ``WIDEST`` does not widen its column, so a table's text stays in proportion to its cells.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import map_arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_STYLE_MARK = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[{};]", re.S)
_LENGTH = re.compile(r"\(\s*(min|max)-width\s*:\s*([\d.]+)(px|em|rem)\s*\)$")
_SELECTOR = re.compile(r"([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)$")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noframes", "iframe", "xmp"}
NEVER = set(
    "script style template head title meta link noscript noframes iframe object audio video canvas "
    "annotation annotation-xml datalist param source track area base".split()
)
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup p pre search section summary table ul xmp".split()
)
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr menu dir xmp".split())
LISTS = {"ul", "ol", "menu", "dir"}
SECTIONS = {"thead", "tbody", "tfoot"}
_CLOSES_P = BLOCKS - {"body", "html", "legend", "optgroup"}
#: An implied end tag does not reach beyond these.
_SCOPE = {"table", "td", "th", "caption", "button", "object", "template", "html"}
#: What a start tag ends, and where the search for it stops.
_IMPLIED = {
    "li": ({"li"}, LISTS), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "caption", "colgroup"}, {"table", *SECTIONS}),
    "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"}),
    **{x: (SECTIONS | {"caption", "colgroup"}, {"table"}) for x in SECTIONS},
}

#: Width of the screen for which style sheets are read.
SCREEN = 1280
#: What can hold or be text in a drawing.
_DRAWN = {"svg", "g", "a", "switch", "text", "foreignobject"}
#: Columns of a table are padded up to this width.
WIDEST = 80


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def attributes_of(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), html.unescape(a or b or c))
    return out


def parse(page: str) -> tuple[Node, list[str]]:
    """The tree of a page and its style sheets."""
    root = Node("html", {})
    open_ = [root]
    counts: Counter[str] = Counter()  # of open elements, so that deep pages are not searched in vain
    sheets: list[str] = []
    at = 0

    def push(node: Node) -> None:
        open_.append(node)
        counts[node.tag] += 1

    def cut(k: int) -> None:
        counts.subtract(x.tag for x in open_[k:])
        del open_[k:]

    def text(part: str) -> None:
        if part:
            open_[-1].children.append(html.unescape(part))

    def close_through(tags: set[str], stop: set[str]) -> None:
        if not any(counts[x] for x in tags):
            return
        for k in range(len(open_) - 1, 0, -1):
            if open_[k].tag in tags:
                cut(k)
                return
            if open_[k].tag in stop or open_[k].tag == "table":
                return

    while found := _TOKEN.search(page, at):
        text(page[at : found.start()])
        at = found.end()
        if found[0].startswith("<![CDATA["):
            open_[-1].children.append(found[0][9:].removesuffix("]]>"))
            continue
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                open_[-1].children.append(Node("br", {}))
            elif tag == "p" and not counts["p"]:
                open_[-1].children.append(Node("p", {}))
            elif counts[tag]:
                # A cell or a table keeps its content from ending what lies around it.
                stop = {"td", "th", "table"} - {tag}
                if tag in SECTIONS or tag in {"tr", "table"}:
                    stop = {"table"} - {tag}
                for k in range(len(open_) - 1, 0, -1):
                    if open_[k].tag == tag:
                        cut(k)
                        break
                    if open_[k].tag in stop:
                        break
            continue
        attributes = attributes_of(found[3])
        if tag in ("html", "body"):
            for name, value in attributes.items():
                open_[0].attributes.setdefault(name, value)
            close_through({"head"}, set())
            continue
        if tag in BLOCKS:
            close_through({"head"}, set())
        if tag in _CLOSES_P:
            close_through({"p"}, _SCOPE)
        if tag in _IMPLIED:
            close_through(*_IMPLIED[tag])
        node = Node(tag, attributes)
        # Cells and rows that stand without their parent get one.
        if tag in ("td", "th") and open_[-1].tag in {"table", *SECTIONS}:
            row = Node("tr", {})
            open_[-1].children.append(row)
            push(row)
        open_[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*/?>|\Z", re.I).search(page, at)
            inner = page[at : end.start()]
            at = end.end()
            if tag == "style":
                media = node.attributes.get("media", "")
                sheets.append(f"@media {media} {{{inner}}}" if media else inner)
            elif tag in ("textarea", "title"):
                node.children.append(html.unescape(inner))
            else:
                node.children.append(inner)
        elif tag not in VOID and not found[3].rstrip().endswith("/") or tag in BLOCKS - {"hr"}:
            push(node)
    text(page[at:])
    return root, sheets


class Rules:
    """What the style sheets hide or show: simple selectors of a tag, classes and an id."""

    def __init__(self, sheets: list[str]):
        self.rules: list[tuple[str, set[str], set[str], tuple, dict[str, tuple[bool, str]]]] = []
        for sheet in sheets:
            for selectors, body, layered in style_rules(sheet):
                declared = declarations(body)
                if not declared:
                    continue
                for selector in selectors.split(","):
                    match = _SELECTOR.match(selector.strip())
                    if match and selector.strip():
                        marks = re.findall(r"[.#][\w-]+", match[2])
                        classes = {x[1:] for x in marks if x[0] == "."}
                        names = {x[1:] for x in marks if x[0] == "#"}
                        tag = match[1] or "*"
                        n = sum(x[0] == "#" for x in marks)
                        weight = (layered, (n, len(marks) - n, tag != "*"))
                        self.rules.append((tag, classes, names, weight, declared))

    def of(self, node: Node) -> dict[str, str]:
        found: dict[str, tuple[tuple, str]] = {}

        def declare(declared: dict[str, tuple[bool, str]], inline: bool, layered: bool, specific: tuple) -> None:
            for name, (important, value) in declared.items():
                # Layers give way to what is outside them, except where they are important.
                key = (important, inline, layered == important, specific)
                if name not in found or key >= found[name][0]:
                    found[name] = (key, value)

        if "hidden" in node.attributes and node.attributes["hidden"] != "until-found":
            declare({"display": (False, "none")}, False, True, (-1, 0, 0))
        if self.rules:
            classes = set(node.attributes.get("class", "").split())
            own = {node.attributes["id"]} if "id" in node.attributes else set()
            for tag, wanted, names, (layered, specific), declared in self.rules:
                if tag in ("*", node.tag.removeprefix("svg:")) and wanted <= classes and names <= own:
                    declare(declared, False, layered, specific)
        if "style" in node.attributes:
            declare(declarations(node.attributes["style"]), True, False, (0, 0, 0))
        return {name: value for name, (_, value) in found.items()}


def style_rules(sheet: str) -> list[tuple[str, str, bool]]:
    """Selectors, body and whether in a layer, of the rules that apply on a screen."""
    sheet = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", sheet, flags=re.S)
    out: list[tuple[str, str, bool]] = []
    # Open blocks: selectors (None for an at-rule), what of the body is read, applied, in a layer.
    open_: list[tuple[str | None, list[str], bool, bool]] = []
    at = 0
    for mark in _STYLE_MARK.finditer(sheet):
        if mark[0][0] in "\"'":
            continue
        part, at = sheet[at : mark.start()], mark.end()
        if mark[0] == "{":
            prelude = part.strip()
            applied, layered = (open_[-1][2], open_[-1][3]) if open_ else (True, False)
            if prelude.startswith("@"):
                name, _, condition = prelude[1:].partition(" ")
                name, bracket, rest = name.lower().partition("(")
                known = name in ("layer", "supports") and not condition.lower().startswith("not")
                applied = applied and (known or name == "media" and applies(bracket + rest + " " + condition))
                open_.append((None, [], applied, layered or name == "layer"))
            else:
                # Selectors inside a rule are relative to it and not read.
                inside = any(x[0] is not None for x in open_)
                open_.append((prelude, [], applied and not inside, layered))
        elif mark[0] == ";":
            if open_:
                open_[-1][1].append(part)
        elif open_:
            selectors, body, applied, layered = open_.pop()
            if selectors is not None and applied:
                out.append((selectors, ";".join([*body, part]), layered))
    return out


def applies(media: str) -> bool:
    """Whether a list of media queries holds for a screen; unknown conditions do not."""
    for query in media.lower().split(","):
        words = re.match(r"\s*(not\s+|only\s+)?(.*?)\s*$", query, re.S)
        terms = [_holds(x.strip()) for x in re.split(r"\s+and\s+", words[2])]
        if None not in terms and all(terms) != (words[1] or "").startswith("not"):
            return True
    return False


def _holds(term: str) -> bool | None:
    if term in ("", "all", "screen"):
        return True
    if length := _LENGTH.match(term):
        width = float(length[2].strip(".") or 0) * (1 if length[3] == "px" else 16)
        return SCREEN >= width if length[1] == "min" else SCREEN <= width
    return None if "(" in term else False


def declarations(body: str) -> dict[str, tuple[bool, str]]:
    """Of a style only what decides whether something is shown, with its importance."""
    found: dict[str, tuple[bool, str]] = {}
    for name, value in re.findall(r"([\w-]+)\s*:\s*([^;]+)", body.lower()):
        if name in ("display", "visibility"):
            value, mark, _ = value.partition("!")
            if mark or not found.get(name, (False,))[0]:
                found[name] = (bool(mark), value.strip())
    return found


def _drawn(node: Node) -> list[Node | str]:
    """What of a drawing is text: its text elements, with the groups that hold them."""
    out: list[Node | str] = []
    for x in node.children:
        if not isinstance(x, Node) or x.tag not in _DRAWN or x.attributes.get("display") == "none":
            continue
        if x.tag in ("text", "foreignobject"):
            if x.attributes.get("visibility") in ("hidden", "collapse"):
                continue
        elif x.tag != "svg":
            group = Node(f"svg:{x.tag}", x.attributes)
            group.children = x.children
            x = group
        out += [x, " "]
    return out


def width_of(text: str) -> int:
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text
    )


class Lines:
    """Text under construction: finished lines, the current one, and the space wanted before more."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.indent = 0
        self.mark = ""
        self.blank = False

    def flow(self, text: str) -> None:
        """Text whose runs of space count as one."""
        parts = text.split()
        if not parts:
            if text and self.now and not self.now[-1].endswith(" "):
                self.now.append(" ")
            return
        lead = " " if text[0].isspace() and self.now and not self.now[-1].endswith(" ") else ""
        self._start()
        self.now.append(lead + " ".join(parts) + (" " if text[-1].isspace() else ""))

    def keep(self, text: str) -> None:
        """Text whose lines and spaces stay."""
        for k, line in enumerate(text.split("\n")):
            if k:
                self.end(force=True)
            if line:
                self._start()
                self.now.append(line)

    def _start(self) -> None:
        if not self.now and self.blank:
            if self.lines:
                self.lines.append("")
            self.blank = False

    def end(self, force: bool = False) -> None:
        """Ends the current line; an empty one is kept only if forced."""
        line = "".join(self.now).rstrip()
        self.now = []
        if line or force:
            pad = " " * self.indent
            if self.mark and line:
                pad = pad[: max(0, self.indent - len(self.mark))] + self.mark
                self.mark = ""
            self.lines.append((pad + line).rstrip() if line else "")

    def space(self) -> None:
        """A blank line before what follows."""
        self.end()
        self.blank = True

    def block(self, lines: list[str]) -> None:
        """Whole lines, kept as they are."""
        self.end()
        if lines:
            self._start()
            for line in lines:
                self.now = [line] if line else []
                self.end(force=True)

    def done(self) -> list[str]:
        self.end()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[list[str], int]]] = []
        self.spans: dict[int, int] = {}
        self.captions: list[str] = []

    def row(self) -> None:
        self.spans = {k: v - 1 for k, v in self.spans.items() if v > 1}
        self.rows.append([])
        self.skip()

    def skip(self) -> None:
        """Columns that a cell above still takes."""
        while self.rows and len(self.rows[-1]) in self.spans:
            self.rows[-1].append(([], 1))

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        for k in range(across):
            if down > 1:
                self.spans[len(self.rows[-1])] = down
            self.rows[-1].append((lines if not k else [], across if not k else 1))
        self.skip()

    def lines(self) -> list[str]:
        """Cells of a column begin at the same place, two spaces after the widest before them."""
        widths: dict[int, int] = {}
        for row in self.rows:
            for k, (lines, across) in enumerate(row):
                if across == 1 and lines:
                    widest = max(map(width_of, lines))
                    widths[k] = max(widths.get(k, 0), widest if widest <= WIDEST else 0)
        out = list(self.captions)
        for row in self.rows:
            for line in range(max((len(x[0]) for x in row), default=0)):
                text, place, goal = [], 0, 0
                for k, (lines, _) in enumerate(row):
                    part = lines[line] if line < len(lines) else ""
                    if part:
                        gap = max(goal - place, 2 if text else 0)
                        text.append(" " * gap + part)
                        place += gap + width_of(part)
                    if widths.get(k):
                        goal += widths[k] + 2
                out.append("".join(text))
        return out


def _number(text: str, highest: int) -> int:
    return min(max(int(text), 1), highest) if text.isdecimal() else 1


def render(root: Node, rules: Rules) -> str:
    """The visible text of a tree."""
    out: list[Lines] = [Lines()]
    tables: list[Table] = []
    counters: list[list] = []
    # Entries: a node or text, whether it is left, and what it inherits.
    work: list[tuple] = [(root, False, True, False)]
    while work:
        node, leaving, shown, pre = work.pop()
        now = out[-1]
        if isinstance(node, str):
            if shown:
                now.keep(node) if pre else now.flow(node)
            continue
        tag = node.tag
        if not leaving:
            if tag in NEVER:
                continue
            style = rules.of(node)
            if style.get("display") == "none":
                continue
            if "visibility" in style:
                shown = style["visibility"] not in ("hidden", "collapse")
            if tag == "br":
                now.end(force=True)
                continue
            if tag == "input":
                if node.attributes.get("type", "").lower() in ("submit", "button", "reset") and shown:
                    now.flow(node.attributes.get("value", ""))
                continue
            block = tag in BLOCKS or style.get("display") in ("block", "list-item", "flex", "grid")
            if block and tag not in ("html", "body"):
                now.space() if tag in SPACED else now.end()
            if tag in LISTS:
                if counters:
                    now.blank = False
                start = node.attributes.get("start", "")
                counters.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
                now.indent += 2
            elif tag == "li":
                kind, n = counters[-1] if counters else ("ul", 1)
                if kind == "ol":
                    value = node.attributes.get("value", "")
                    n = int(value) if re.fullmatch(r"-?\d{1,9}", value) else n
                    counters[-1][1] = n + 1
                now.mark = f"{n}. " if kind == "ol" else "- "
                now.indent += len(now.mark) - (2 if counters else 0)
            elif tag in ("dd", "blockquote"):
                now.indent += 2
            elif tag == "table":
                tables.append(Table())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in ("td", "th", "caption") and tables:
                out.append(Lines())
            elif tag == "td" or tag == "th":
                now.flow(" ")
            if tag in ("pre", "textarea", "xmp"):
                pre = True
            children = node.children
            if tag == "details" and "open" not in node.attributes:
                children = [x for x in children if isinstance(x, Node) and x.tag == "summary"][:1]
            elif tag == "select":
                children = _selected(node)
            elif tag == "svg" or tag.startswith("svg:"):
                children = _drawn(node)
            work.append((node, True, shown, block))
            work.extend((child, False, shown, pre) for child in reversed(children))
            continue
        # Leaving a node; ``pre`` says here whether it was a block.
        if tag in LISTS:
            now.end()
            counters.pop()
            now.indent = max(0, now.indent - 2)
        elif tag == "li":
            now.end()
            kind, n = counters[-1] if counters else ("ul", 1)
            mark = len(f"{n - 1}. ") if kind == "ol" else 2
            now.mark = ""
            now.indent = max(0, now.indent - mark + (2 if counters else 0))
        elif tag in ("dd", "blockquote"):
            now.end()
            now.indent = max(0, now.indent - 2)
        elif tag in ("td", "th") and tables:
            lines = out.pop().done()
            tables[-1].cell(
                lines, _number(node.attributes.get("colspan", ""), 1000),
                _number(node.attributes.get("rowspan", ""), 65534),
            )
            now = out[-1]
        elif tag == "caption" and tables:
            tables[-1].captions += out.pop().done()
            now = out[-1]
        elif tag == "table" and tables:
            now.block(tables.pop().lines())
        if pre and tag not in ("html", "body"):
            if tag in SPACED and not (tag in LISTS and counters):
                now.space()
            else:
                now.end()
    return "\n".join(out[0].done())


def _selected(node: Node) -> list[Node]:
    """The option that a closed list shows."""
    options, work = [], list(reversed(node.children))
    while work:
        x = work.pop()
        if isinstance(x, Node):
            if x.tag == "option":
                options.append(x)
            else:
                work.extend(reversed(x.children))
    chosen = [x for x in options if "selected" in x.attributes] or options[:1]
    return chosen if "multiple" not in node.attributes else options


def visible_text(page: str) -> str:
    root, sheets = parse(page)
    return render(root, Rules(sheets))


def extract(
    pages: DataFrame, id_column: str = "page_id", html_column: str = "html",
) -> DataFrame:
    """One row for each page: its id, its visible text, and the text's lines and words."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = [visible_text(x.as_py() or "") for x in batch.column(1)]
        return {
            "id": batch.column(0), "text": pa.array(texts, pa.string()),
            "n_lines": pa.array([sum(bool(y) for y in x.split("\n")) for x in texts], pa.int64()),
            "n_words": pa.array([len(x.split()) for x in texts], pa.int64()),
        }

    kind = pages.schema[id_column].dataType.simpleString()
    slim = pages.select(F.col(id_column).alias("id"), F.col(html_column).alias("html"))
    return map_arrow(slim, rows, f"id {kind}, text string, n_lines long, n_words long").withColumnRenamed(
        "id", id_column
    )

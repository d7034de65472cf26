"""Layout-aware text of HTML pages.

A tree builder in one pass keeps the stack of open elements, closes and opens what the markup leaves out (paragraphs, list
items, table rows and cells, the head), and hands text to the flow of the innermost cell. Elements that are never shown
(scripts, styles, the head), ``hidden``, closed dialogs, ``display: none`` and ``visibility: hidden`` emit nothing. The last two count in a
style attribute and in the rules of ``<style>`` whose selector is one tag, classes and ids together, by specificity and order; selectors
that look at other elements or at states do not count. Blocks begin new
lines, paragraphs and their like keep a blank line around them, list items are indented behind a bullet or number, ``pre`` keeps its
white space, and the cells of a table are padded to common column widths, spans included. Nothing recurses, so nesting depth is
bounded by memory only. Formulas (MathML) and the labels of inline SVG are running text, a blank between their parts. All visible text is emitted, in document order; a table's stray text comes before the table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TAG = re.compile(r"""<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[!?/][^>]*+(?:>|\Z))""", re.S)
LOOSE = re.compile(r"<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>[^>]*)>")
ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TELLING = re.compile(r"hidden|style|span|start|value|open|reversed|display|visibility", re.I)
SPACES = re.compile(r"[ \t\n\f\r]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
ESCAPABLE = frozenset("title textarea".split())
NEVER = frozenset("head script style template iframe noembed noframes noscript title object audio video canvas datalist".split())
#: Never shown inside svg or math, besides these.
NEVER_FOREIGN = frozenset("annotation annotation-xml defs metadata desc mphantom".split())
#: Parts of svg and math that stand apart in a browser; a blank keeps their texts apart.
APART = frozenset("svg math text mi mn mo ms mtext".split())
FOREIGN = frozenset("svg math foreignobject".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACED = HEADINGS | frozenset("p ul ol dl blockquote pre table figure hr fieldset xmp plaintext menu dir".split())
BLOCKS = SPACED | frozenset(
    "address article aside body center dd details dialog div dt fieldset figcaption footer form header hgroup html legend li main nav optgroup option search section summary textarea caption".split()
)
CLOSES_P = (SPACED | frozenset("address article aside center details dialog div fieldset figcaption footer form header hgroup main nav search section summary li dd dt".split())) - {"html", "body"}
LISTS = frozenset("ul ol menu dir".split())
SECTIONS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
SCOPE = frozenset("table td th caption html template".split())
STYLE = re.compile(r"<style\b([^>]*)>(.*?)(?:</style\b|\Z)", re.I | re.S)
#: What stands in braces of its own conditions, and statements without braces.
AT_RULES = re.compile(r"/\*.*?(?:\*/|\Z)|@[^{};]*(?:;|\{(?:[^{}]*\{[^{}]*\})*[^{}]*\})", re.S)
RULE = re.compile(r"([^{}]+)\{([^{}]*)\}")
SELECTOR = re.compile(r"(\*|[A-Za-z][\w-]*)?((?:[.#][\w-]+)*)")
DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
#: Columns are padded up to this width; wider cells are written whole and not padded for.
WIDEST = 80
#: Limits of the HTML standard.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


def hiding_rules(source: str) -> list[tuple]:
    """(weight, tag, ids, classes, property, value) of the style sheets of a page, the weaker first; none when nothing is hidden."""
    out = []
    for attrs, sheet in STYLE.findall(source):
        media = re.search(r"media\s*=\s*[\"']?([^\"'>]*)", attrs, re.I)
        if media and not re.search(r"all|screen", media[1], re.I):
            continue
        for selectors, body in RULE.findall(AT_RULES.sub(" ", sheet)):
            declared = DECLARED.findall(body)
            for selector in selectors.split(",") if declared else ():
                found = SELECTOR.fullmatch(selector.strip())
                if not found or not found[0]:
                    continue
                parts = re.findall(r"[.#][\w-]+", found[2])
                ids, classes = ({x[1:] for x in parts if x[0] == sign} for sign in "#.")
                tag = (found[1] or "*").lower()
                for name, value, important in declared:
                    weight = (bool(important), len(ids), len(classes), tag != "*", len(out))
                    out.append((weight, tag, ids, classes, name.lower(), value.lower()))
    hides = any(value in ("none", "hidden", "collapse") for *_, value in out)
    return sorted(out, key=lambda r: r[0]) if hides else []


class Flow:
    """Lines of running text."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.margin = False
        self.indents: list[str] = []
        self.marker: str | None = None

    def text(self, data: str, pre: bool) -> None:
        if pre:
            first, *rest = data.split("\n")
            self._add(first)
            for line in rest:
                self.end_line(keep=True)
                self._add(line)
            return
        bits = SPACES.split(data)
        if not bits[0] and len(bits) > 1:
            self.space = True
        said = " ".join(filter(None, bits))
        if said:
            if self.space and self.parts:
                self.parts.append(" ")
            self.parts.append(said)
            self.space = not bits[-1] and len(bits) > 1

    def _add(self, text: str) -> None:
        if text:
            if self.space and self.parts:
                self.parts.append(" ")
            self.space = False
            self.parts.append(text)

    def end_line(self, keep: bool = False) -> None:
        """``keep``: an empty line counts, as with br and in pre."""
        self.space = False
        if self.parts or (keep and self.lines and self.lines[-1] != ""):
            self._put("".join(self.parts))
        self.parts = []

    def _put(self, line: str) -> None:
        if self.margin and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.margin = False
        lead = "".join(self.indents)
        if self.marker is not None and line:
            lead, self.marker = lead[: len(lead) - len(self.marker)] + self.marker, None
        self.lines.append((lead + line).rstrip() if not line else lead + line)

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.margin |= spaced

    def rows(self, lines: list[str]) -> None:
        self.block(True)
        for line in lines:
            self._put(line)
        self.margin = True

    def done(self) -> list[str]:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    """Cells on a grid; a cell is (column, span, lines)."""

    def __init__(self) -> None:
        self.grid: list[list[tuple[int, int, list[str]]]] = []
        self.busy: dict[int, int] = {}
        self.column = 0

    def row(self) -> None:
        self.grid.append([])
        self.column = 0
        self.busy = {c: left - 1 for c, left in self.busy.items() if left > 1}

    def place(self, span: int, rows: int) -> int:
        while self.column in self.busy:
            self.column += 1
        at = self.column
        if rows > 1:
            for c in range(at, at + span):
                self.busy[c] = rows
        self.column += span
        return at

    def rendered(self) -> list[str]:
        width: dict[int, int] = {}
        cells = [c for row in self.grid for c in row]
        for at, span, lines in sorted(cells, key=lambda c: c[1]):
            need = max((len(line) for line in lines), default=0)
            have = sum(width.get(c, 0) for c in range(at, at + span)) + 3 * (span - 1)
            if min(need, WIDEST) > have:
                last = at + span - 1
                width[last] = width.get(last, 0) + min(need, WIDEST) - have
        out: list[str] = []
        for row in self.grid:
            if not any(lines for _, _, lines in row):
                continue
            for k in range(max(len(lines) for _, _, lines in row)):
                line, reached = "", 0
                for at, span, lines in row:
                    for c in range(reached, at):
                        line += " " * width.get(c, 0) + " | "
                    wide = sum(width.get(c, 0) for c in range(at, at + span)) + 3 * (span - 1)
                    line += (lines[k] if k < len(lines) else "").ljust(wide) + " | "
                    reached = at + span
                out.append(line.rstrip(" |") if not line.strip(" |") else line[:-3].rstrip())
        return out


class Element:
    __slots__ = ("data", "name", "off", "pre", "seen")

    def __init__(self, name: str, off: bool, seen: bool, pre: bool, data=None) -> None:
        self.name, self.off, self.seen, self.pre, self.data = name, off, seen, pre, data


def _number(value: str | None, default: int) -> int:
    found = re.match(r"\s*(-?\d{1,9})", value or "")
    return int(found[1]) if found else default


class Page:
    def __init__(self, rules: list[tuple]) -> None:
        self.rules = rules
        self.flows = [Flow()]
        self.open = [Element("html", False, True, False)]
        self.count: dict[str, int] = {}

    # --- stack

    def push(self, element: Element) -> None:
        self.open.append(element)
        self.count[element.name] = self.count.get(element.name, 0) + 1

    def find(self, names: frozenset[str] | set[str], stop: frozenset[str]) -> int:
        """Index of the innermost open element of ``names``, -1 if there is none before one of ``stop``."""
        if not any(self.count.get(name) for name in names):
            return -1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].name in names:
                return i
            if self.open[i].name in stop:
                break
        return -1

    def close(self, index: int) -> None:
        """Close the element at ``index`` and all inside it."""
        while len(self.open) > max(index, 1):
            e = self.open.pop()
            self.count[e.name] -= 1
            flow = self.flows[-1]
            if e.name in CELLS and e.data is not None:
                at, span, table = e.data
                lines = self.flows.pop().done()
                table.grid[-1].append((at, span, lines))
            elif e.off:
                continue
            elif e.data == "apart":
                flow.space = True
            elif e.name == "table":
                flow.rows(e.data.rendered())
            elif e.name in BLOCKS:
                flow.block(e.name in SPACED and not self.nested_list(e.name))
                if e.name == "li" or e.name in LISTS or e.name in ("blockquote", "dd"):
                    if flow.indents and e.data is not None and e.data is not False:
                        flow.indents.pop()
                        flow.marker = None

    def nested_list(self, name: str) -> bool:
        return name in LISTS and self.find({"li"}, SCOPE) >= 0

    def foreign(self) -> bool:
        """Inside svg or math, and not in HTML that stands there."""
        return bool(self.count.get("svg") or self.count.get("math")) and self.open[self.find(FOREIGN, frozenset())].name != "foreignobject"

    def close_if(self, names: set[str], stop: frozenset[str]) -> None:
        if (i := self.find(names, stop)) > 0:
            self.close(i)

    def ruled(self, name: str, attrs: dict[str, str]) -> dict[str, str]:
        """What the style sheets say about an element."""
        out: dict[str, str] = {}
        classes, own = set(attrs.get("class", "").split()), {attrs.get("id", "")}
        for _, tag, ids, wanted, what, value in self.rules:
            if tag in ("*", name) and ids <= own and wanted <= classes:
                out[what] = value
        return out

    # --- tokens

    def start(self, name: str, raw: str, ended: bool) -> None:
        if name in ("html", "body") and name != "body":
            return
        attrs: dict[str, str] = {}
        if raw and (self.rules or TELLING.search(raw)):
            for k, v in ATTR.findall(raw):
                attrs.setdefault(k.lower(), html.unescape(v.strip("\"'")))
        if name not in IN_HEAD and name != "head":
            self.close_if({"head"}, SCOPE)
        if name in CLOSES_P:
            self.close_if({"p"}, SCOPE | {"button"})
        table_at = self.find({"table"}, frozenset(("html",)))
        if name == "li":
            self.close_if({"li"}, SCOPE | LISTS)
        elif name in ("dt", "dd"):
            self.close_if({"dt", "dd"}, SCOPE | {"dl"})
        elif name in ("option", "optgroup"):
            self.close_if({"option"} if name == "option" else {"option", "optgroup"}, SCOPE | {"select", "datalist"})
        elif name in HEADINGS and self.open[-1].name in HEADINGS:
            self.close(len(self.open) - 1)
        elif name in SECTIONS or name in ("caption", "colgroup"):
            if table_at < 0:
                return
            self.close(table_at + 1)
        elif name == "tr":
            if table_at < 0:
                return
            keep = table_at + 1
            if keep < len(self.open) and self.open[keep].name in SECTIONS:
                keep += 1
            self.close(keep)
        elif name in CELLS:
            if table_at < 0:
                return
            row_at = self.find({"tr"}, frozenset(("table",)))
            if row_at < 0:
                self.start("tr", "", False)
                row_at = len(self.open) - 1
            self.close(row_at + 1)
        parent = self.open[-1]
        style = attrs.get("style", "").lower().replace(" ", "")
        foreign = self.foreign()
        if foreign:  # there they are attributes as well
            style += "".join(f";{k}:{attrs[k].strip().lower()}" for k in ("display", "visibility") if k in attrs and k + ":" not in style)
        for k, v in self.ruled(name, attrs).items():
            if k + ":" not in style:
                style += f";{k}:{v}"
        off = parent.off or name in NEVER or (name == "dialog" and "open" not in attrs) or (foreign and name in NEVER_FOREIGN) or "hidden" in attrs or "display:none" in style
        if parent.name == "details" and name != "summary" and parent.data is False:
            off = True
        seen = parent.seen
        if "visibility:" in style:
            seen = "visibility:visible" in style or ("visibility:inherit" in style and seen)
        flow = self.flows[-1]
        if off and name not in CELLS and name != "tr" and name != "table":
            if name not in VOID and not ended:
                self.push(Element(name, True, seen, parent.pre, False))
            return
        if name == "br":
            flow.end_line(keep=True)
            return
        if name in VOID:
            if name == "hr":
                flow.block(True)
            return
        if foreign and ended:
            return
        pre = parent.pre or name in ("pre", "textarea", "xmp", "plaintext") or "white-space:pre" in style
        data = None
        if name in APART and (foreign or name in FOREIGN):
            flow.space, data = True, "apart"
        if name in BLOCKS and name != "table":
            flow.block(name in SPACED and not self.nested_list(name))
        if name in LISTS:
            flow.indents.append("  " if self.find({"li"}, SCOPE) >= 0 else "")
            data = [name, _number(attrs.get("start"), 1)]
        elif name == "li":
            where = self.find(LISTS, SCOPE)
            marker = "- "
            if where >= 0 and self.open[where].data and self.open[where].data[0] == "ol":
                n = _number(attrs.get("value"), self.open[where].data[1])
                self.open[where].data[1] = n + 1
                marker = f"{n}. "
            flow.indents.append(" " * len(marker))
            flow.marker = marker
            data = marker
        elif name in ("blockquote", "dd"):
            flow.indents.append("  ")
            data = name
        elif name == "details":
            data = "open" in attrs
        elif name == "table":
            data = Table()
        elif name == "tr" and table_at >= 0:
            if not off:
                self.open[table_at].data.row()
        elif name in CELLS and table_at >= 0:
            table = self.open[table_at].data
            if off or not table.grid:
                data = None
            else:
                span = min(max(_number(attrs.get("colspan"), 1), 1), MOST_COLUMNS)
                rows = _number(attrs.get("rowspan"), 1)
                data = (table.place(span, min(rows if rows > 0 else MOST_ROWS, MOST_ROWS)), span, table)
                self.flows.append(Flow())
        self.push(Element(name, off, seen, pre, data))

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", "", False)
        elif name == "p" and self.find({"p"}, SCOPE | {"button"}) < 0:
            if not self.open[-1].off:
                self.flows[-1].block(True)
        elif name in HEADINGS:
            self.close_if(set(HEADINGS), SCOPE)
        elif name == "table":
            self.close_if({"table"}, frozenset(("html",)))
        elif name in CELLS or name == "tr" or name in SECTIONS or name == "caption":
            self.close_if({name}, frozenset(("table",)))
        elif name not in ("html", "body"):
            self.close_if({name}, SCOPE if name != "template" else frozenset(("html",)))

    def said(self, data: str) -> None:
        e = self.open[-1]
        if e.name == "head" and data.strip():
            self.close_if({"head"}, SCOPE)
            e = self.open[-1]
        if not e.off and e.seen and not (e.name == "details" and e.data is False):
            self.flows[-1].text(html.unescape(data) if "&" in data else data, e.pre)

    def done(self) -> str:
        self.close(1)
        return "\n".join(self.flows[0].done())


def rendered(source: str) -> str:
    """Visible text of a page."""
    page, at, n = Page(hiding_rules(source)), 0, len(source)
    while at < n:
        begin = source.find("<", at)
        if begin < 0:
            page.said(source[at:])
            break
        tag = TAG.match(source, begin) or LOOSE.match(source, begin)
        if tag is None:
            # no tag begins here: the sign is text
            nxt = source.find("<", begin + 1)
            nxt = n if nxt < 0 else nxt
            page.said(source[at:nxt])
            at = nxt
            continue
        if begin > at:
            page.said(source[at:begin])
        at = tag.end()
        name = tag["name"]
        if not name:
            if source.startswith("<![CDATA[", begin) and page.foreign():
                close = source.find("]]>", begin)
                page.said(html.escape(source[begin + 9 : close if close >= 0 else n]))
                at = close + 3 if close >= 0 else n
            continue
        name = name.lower()
        if tag["end"]:
            page.end(name)
            continue
        ended = tag["attrs"].endswith("/")
        page.start(name, tag["attrs"], ended)
        if ended and page.foreign():
            continue
        if name in RAW or name in ESCAPABLE:
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
            body = source[at : close.start() if close else n]
            if name not in NEVER and body:
                page.flows[-1].text(html.unescape(body) if name in ESCAPABLE else body, True) if not page.open[-1].off and page.open[-1].seen else None
            page.end(name)
            at = close.end() if close else n
        elif name == "plaintext":
            page.flows[-1].text(source[at:], True)
            at = n
        elif name == "pre" and source.startswith("\n", at):
            at += 1
    return page.done()


def extract(pages: DataFrame, source: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with ``text``, the visible text of ``source``; a null page has null text, an empty one an empty text.

    Any text is accepted as HTML; broken markup is repaired, never an error. An existing column ``text`` is replaced, all other
    columns are passed through.
    """
    plain = pages if text == source else pages.drop(text)
    names = [c for c in plain.columns if c != text]
    schema = ", ".join(f"`{c}` {plain.schema[c].dataType.simpleString()}" for c in names) + f", `{text}` string"
    position = plain.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([None if x.as_py() is None else rendered(x.as_py()) for x in batch.column(position)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), out], names=[*names, text])

    return plain.mapInArrow(run, schema)

"""Visible text of HTML pages, laid out.

A tree builder turns tag soup into well-nested elements (implied end tags, void and raw-text elements), rules of visibility
drop what a browser does not show, and a renderer emits the rest: blocks apart by blank lines, one line a
list item with its marker and depth, table cells padded to their columns. The tree is handed on as enter, text and leave
events, so depth and length of a page cost no recursion; every scan moves forward only.

Style sheets are taken as a screen of 1280 x 720 shows them: rules at top level and in media, layer or support blocks that hold there, the
declaration of highest rank (importance, specificity, place) winning; selectors of one element without combinators count.
In svg, text elements and foreign content show; in MathML everything but annotations and phantoms. A head ends at its end tag or at whatever cannot
stand in it. List items carry their list's numbers (start, value, type, reversed) unless list-style or display leaves no marker; closed selects
show the chosen option, buttons their value.

Edge cases: null and empty pages give empty text; a tag that never ends swallows the rest, as in browsers; unknown tags are inline;
unmatched end tags do nothing; repeated rows give the same text; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tallyworks.llm.common import table

# Element classes of HTML (fixed values).
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = set("head script style template noscript iframe noembed noframes title datalist object audio video canvas".split())
#: Inside svg and math: what is not shown there, and HTML elements, which end svg.
UNDRAWN = {
    "svg": set("defs desc metadata symbol clippath mask marker pattern lineargradient radialgradient filter".split()),
    "math": set("annotation annotation-xml mphantom".split()),
}
BREAKOUT = set("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby "
               "s small span strong strike sub sup table tt u ul var".split())
PARTED = set("mfrac msup msub msubsup munder mover munderover mmultiscripts mroot mtr mtable".split())  # their children stand apart
APART = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset form".split())
LINES = set(
    "address article aside body caption center dd details dialog dir div dt figcaption footer header hgroup html legend li main menu nav "
    "option optgroup search section select summary tbody tfoot thead tr".split()
)
ENDS_P = APART | set("address article aside center details dialog dir div dl dd dt fieldset figcaption figure footer header hgroup li main menu "
                     "nav search section summary".split())
HEAD_CONTENT = set("base basefont bgsound link meta noframes noscript script style template title".split())  # all else ends the head
BUTTONS = {"submit", "button", "reset"}  # inputs that show their value
STYLED = {"decimal": "1", "lower-alpha": "a", "lower-latin": "a", "upper-alpha": "A", "upper-latin": "A", "lower-roman": "i", "upper-roman": "I"}
ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]
SECTIONS = {"thead", "tbody", "tfoot"}
CELLS = {"td", "th"}
#: start tag: (open elements it ends, elements beyond which it does not look)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"table"}),
    "th": (CELLS, {"table"}),
    "tr": (CELLS | {"tr"}, {"table"}),
    **{s: (CELLS | {"tr", "caption"} | SECTIONS, {"table"}) for s in SECTIONS},
}
TAG = re.compile(
    r"<(?:!--(?P<comment>)|(?P<decl>[!?])|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?P<endclose>>)?|(?P<start>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?|[\"'])*+)(?P<close>>)?)"
)
ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPACE = re.compile(r"[ \t\n\r\f]+")
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S)
STOP = re.compile(r"[{};]|\"[^\"]*+\"?|'[^']*+'?")
BRACE = re.compile(r"[{}]|\"[^\"]*+\"?|'[^']*+'?")
SHOWS = re.compile(r"(?:^|;)\s*(display|visibility|list-style(?:-type)?)\s*:\s*([a-z-]+)[^;!]*(!\s*important)?", re.I)
NESTED = re.compile(r"[^;{}]*+\{[^{}]*+\}")  # a rule inside a rule
SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#]-?[a-zA-Z_][\w-]*)*)")
PART = re.compile(r"[.#][^.#]+")
GROUPS = {"media", "supports", "layer", "container", "scope"}
SCREEN = {"width": 1280.0, "height": 720.0}
UNITS = {"": 1.0, "px": 1.0, "em": 16.0, "rem": 16.0, "in": 96.0, "cm": 96 / 2.54, "mm": 9.6 / 2.54, "pt": 4 / 3, "pc": 16.0}
LENGTH = r"([0-9]*\.?[0-9]+)([a-z]*)"
BOUND = re.compile(rf"(min-|max-)?(width|height)\s*:\s*{LENGTH}")
RANGE = re.compile(rf"(?:{LENGTH}\s*(<=?|>=?|=)\s*)?(width|height)(?:\s*(<=?|>=?|=)\s*{LENGTH})?")
HOLDING = {"orientation: landscape", "color", "hover: hover", "any-hover: hover", "pointer: fine", "any-pointer: fine", "hover", "pointer", "grid: 0",
           "prefers-color-scheme: light", "prefers-reduced-motion: no-preference", "width", "height", "scripting: enabled"}
TESTS = {"<": float.__lt__, "<=": float.__le__, ">": float.__gt__, ">=": float.__ge__, "=": float.__eq__}
Rank = tuple[bool, int, int]  # important, specificity, place


def holds(feature: str) -> bool:
    """Whether a media feature (without its parentheses) holds on the screen; unknown ones do not."""
    feature = re.sub(r"\s*:\s*", ": ", feature.strip())
    m = BOUND.fullmatch(feature)
    if m and m[4] in UNITS:
        size, bound = SCREEN[m[2]], float(m[3]) * UNITS[m[4]]
        return size >= bound if m[1] == "min-" else size <= bound if m[1] else size == bound
    m = RANGE.fullmatch(feature)
    if m and (m[3] or m[5]) and (m[2] or "") in UNITS and (m[7] or "") in UNITS:
        size = SCREEN[m[4]]
        return (not m[3] or TESTS[m[3]](float(m[1]) * UNITS[m[2]], size)) and (not m[5] or TESTS[m[5]](size, float(m[6]) * UNITS[m[7]]))
    return feature in HOLDING


def fits(media: str) -> bool:
    """Whether any query of a media list holds on the screen; an empty list does."""
    if not media.strip():
        return True
    for query in media.lower().split(","):
        m = re.fullmatch(r"\s*(?:(not|only)\s+)?(?:(?!not\b|only\b)([a-z-]+))?(.*)", query, re.S)
        kind, rest = m[2] or "all", m[3]
        features = re.findall(r"(not\s+)?\(([^()]*)\)", rest)
        known = kind in ("all", "screen") and not re.sub(r"not\s+\([^()]*\)|\([^()]*\)|\band\b|\bor\b|\s", "", rest)
        each = [holds(f) != bool(no) for no, f in features]
        fit = known and (any(each) if re.search(r"\)\s*or\b", rest) else all(each))
        if fit != (m[1] == "not"):
            return True
    return False


def blocks(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules of a style sheet that hold on the screen, in order."""
    at = start = 0
    ends: list[int] = []  # of the open groups
    while at < len(css):
        m = STOP.search(css, at)
        if not m:
            return
        at = m.end()
        if m[0] == ";":
            start = at
        elif m[0] == "}":
            start = at
        elif m[0] == "{":
            head = css[start : m.start()].strip()
            name = re.match(r"@([a-zA-Z-]+)", head)
            group = name and name[1].lower()
            if group in GROUPS and (group in ("layer", "scope") or group == "media" and fits(head[len(name[0]) :]) or group == "supports" and not re.match(
                    r"@supports\s+not\b", head, re.I)):
                start = at
                continue
            body, depth = at, 1
            while depth:
                m = BRACE.search(css, at)
                if not m:
                    at = len(css)
                    break
                at = m.end()
                depth += (m[0] == "{") - (m[0] == "}")
            if not name:
                yield head, css[body : at - 1 if not depth else at]
            start = at


def declared(text: str) -> dict[str, tuple[str, bool]]:
    """display, visibility and list-style of a list of declarations, with whether they are important."""
    found: dict[str, tuple[str, bool]] = {}
    for name, value, important in SHOWS.findall(NESTED.sub("", text)):
        name = name.lower().removesuffix("-type")
        if not found.get(name, ("", False))[1] or important:
            found[name] = value.lower(), bool(important)
    return found


class Sheet:
    """display and visibility rules by a name that the element must have: its tag, a class, an id, or ``*``."""

    def __init__(self):
        self.rules: dict[str, list[tuple[set[str], Rank, str, str]]] = {}
        self.place = 0

    def add(self, css: str) -> None:
        for heads, body in blocks(COMMENT.sub(" ", css)):
            found = declared(body)
            for head in heads.split(",") if found else ():
                m = SIMPLE.fullmatch(head.strip())
                if not m or not m[0]:
                    continue
                names = {x.lower() for x in PART.findall(m[2])} | ({m[1].lower()} if m[1] else set())
                special = 100 * m[2].count("#") + 10 * m[2].count(".") + (m[1] not in (None, "*"))
                self.place += 1
                for name, (value, important) in found.items():
                    self.rules.setdefault(max(names), []).append((names, (important, special, self.place), name, value))

    def style(self, names: set[str], inline: str, base: dict[str, str]) -> dict[str, str]:
        """What holds for an element with these names; ``base`` is what holds without any rule."""
        best: dict[str, tuple[Rank, str]] = {k: ((False, -1, 0), v) for k, v in base.items()}
        found = [r for name in names if name in self.rules for r in self.rules[name] if r[0] <= names]
        if inline:
            found += [(names, (important, 1 << 30, 0), name, value) for name, (value, important) in declared(inline).items()]
        for _, rank, name, value in found:
            if name not in best or rank > best[name][0]:
                best[name] = rank, value
        return {k: v for k, (_, v) in best.items()}


def style_of(found: list[tuple[str, str, dict[str, str] | None]]) -> Sheet:
    """The style elements of a page's events, outside of templates, whose type and media hold."""
    sheet, inert, open_style = Sheet(), 0, False
    for kind, value, attrs in found:
        if value == "template" and kind != "text":
            inert += 1 if kind == "enter" else -1
        elif value == "style" and kind != "text":
            open_style = kind == "enter" and not inert and fits(attrs.get("media", "")) and attrs.get("type", "").strip().lower() in ("", "text/css")
        elif kind == "text" and open_style:
            sheet.add(value)
    return sheet


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(text):
        found.setdefault(name.lower(), unescape(a or b or c))
    return found


def raw_end(page: str, name: str, start: int) -> tuple[int, int]:
    """Where the text of a raw element ends, and where its end tag does."""
    m = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, start)
    return (m.start(), m.end()) if m else (len(page), len(page))


def events(page: str) -> Iterator[tuple[str, str, dict[str, str] | None]]:
    """Well-nested ("enter", tag, attributes), ("text", data, None) and ("leave", tag, None)."""
    stack: list[str] = []
    open_tags: Counter[str] = Counter()

    def leave(count: int) -> Iterator[tuple[str, str, None]]:
        for _ in range(count):
            open_tags[stack[-1]] -= 1
            yield "leave", stack.pop(), None

    def depth(tags: set[str], stops: set[str]) -> int:
        """How many elements to leave so that the outermost of ``tags`` inside ``stops`` is left."""
        if not any(open_tags[t] for t in tags):
            return 0
        found = 0
        for k, tag in enumerate(reversed(stack)):
            if tag in tags:
                found = k + 1
            elif tag in stops:
                break
        return found

    def text(data: str) -> Iterator[tuple[str, str, None]]:
        nonlocal began
        if SPACE.sub("", data):
            began = True
            if stack and stack[-1] == "head":
                yield from leave(1)
        yield "text", unescape(data), None

    at, began = 0, False  # whether there was anything, so that a head would come too late
    while at < len(page):
        mark = page.find("<", at)
        if mark < 0:
            yield from text(page[at:])
            break
        m = TAG.match(page, mark)
        if not m:
            nxt = page.find("<", mark + 1)
            nxt = len(page) if nxt < 0 else nxt
            yield from text(page[at:nxt])
            at = nxt
            continue
        if mark > at:
            yield from text(page[at:mark])
        if m["comment"] is not None:
            end = page.find("-->", mark + 2)
            at = len(page) if end < 0 else end + 3
        elif m["decl"]:
            end = page.find(">", mark)
            at = len(page) if end < 0 else end + 1
        elif m["end"]:
            at = m.end() if m["endclose"] else len(page)
            tag = m["end"].lower()
            if tag == "br":
                yield "enter", "br", {}
                yield "leave", "br", None
            elif open_tags[tag]:
                stops = {"table"} if tag not in ("table", "body", "html") else set()
                count = depth_to(stack, tag, stops)
                yield from leave(count)
        else:
            at = m.end() if m["close"] else len(page)
            if not m["close"]:
                break
            tag, attrs = m["start"].lower(), m["attrs"]
            closed = attrs.endswith("/")
            if tag == "head" and began:
                continue
            began = began or tag != "html"
            if open_tags["head"] and tag not in HEAD_CONTENT and not open_tags["template"]:
                yield from leave(depth({"head"}, set()))
            if tag in ENDS_P and open_tags["p"]:
                yield from leave(depth({"p"}, {"table", "td", "th", "button", "caption", "object"}))
            if tag in IMPLIED:
                yield from leave(depth(*IMPLIED[tag]))
            if tag in CELLS and (not stack or stack[-1] != "tr") and open_tags["table"]:
                open_tags["tr"] += 1
                stack.append("tr")
                yield "enter", "tr", {}
            yield "enter", tag, attributes(attrs) if attrs.strip(" /") else {}
            if tag in VOID or closed and (tag in ("svg", "math", "path") or open_tags["svg"] or open_tags["math"]) and tag not in BREAKOUT:
                yield "leave", tag, None
            elif tag in RAW:
                end, at = raw_end(page, tag, at)
                data = page[m.end() : end]
                yield "text", unescape(data) if tag in ("textarea", "title") else data, None
                yield "leave", tag, None
            else:
                stack.append(tag)
                open_tags[tag] += 1
    yield from leave(len(stack))


def depth_to(stack: list[str], tag: str, stops: set[str]) -> int:
    for k, name in enumerate(reversed(stack)):
        if name == tag:
            return k + 1
        if name in stops:
            return 0
    return 0


class Flow:
    """Lines of text: white space collapses, breaks ask for at least so many line ends before the next text."""

    def __init__(self):
        self.out: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.blank = True  # the open line has nothing or ends in a space
        self.markers: list[str] = []
        self.indent = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            for k, row in enumerate(data.replace("\r\n", "\n").split("\n")):
                if k:
                    self.end(1, keep=True)
                if row:
                    self.line.append(row)
                    self.blank = False
            return
        data = SPACE.sub(" ", data)
        if self.blank and data[:1] == " ":
            data = data[1:]
        if data:
            self.line.append(data)
            self.blank = data[-1] == " "

    def end(self, gap: int, keep: bool = False) -> None:
        row = "".join(self.line)
        row = row if keep else row.strip(" ")
        self.line, self.blank = [], True
        if row.strip(" ") or (keep and self.out):
            if self.out:
                self.out.append("\n" * max(1, self.gap))
            lead = self.indent
            if self.markers:
                mark = "".join(self.markers)
                lead = self.indent[: max(0, len(self.indent) - len(mark))] + mark
                self.markers = []
            self.out.append((lead + row).rstrip(" "))
            self.gap = 0
        self.gap = max(self.gap, gap)

    def filled(self) -> bool:
        return any(part.strip(" ") for part in self.line)

    def done(self) -> str:
        self.end(0)
        return "".join(self.out).strip("\n")


def laid_out(rows: list[list[tuple[str, int, int]]]) -> str:
    """Rows of (text, colspan, rowspan) as lines whose cells start at the same place in every row."""
    grid: list[dict[int, str]] = []
    taken: list[tuple[int, int, int]] = []  # columns from, to, and for how many rows
    for row in rows:
        cells, column, later, place = {}, 0, [], 0
        taken.sort()
        for text, across, down in row:
            while place < len(taken) and taken[place][0] <= column:
                column = max(column, taken[place][1])
                place += 1
            cells[column] = text
            if down > 1:
                later.append((column, column + across, down))
            column += across
        taken = [(a, b, n - 1) for a, b, n in taken + later if n > 1]
        grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for c, text in cells.items():
            if text:
                width[c] = max(width.get(c, 0), *map(len, text.split("\n")))
    filled = sorted(width)
    lines = []
    for cells in grid:
        last = max((c for c, text in cells.items() if text), default=-1)
        parts = {c: cells.get(c, "").split("\n") for c in filled[: bisect_right(filled, last)]}
        for k in range(max((len(p) for p in parts.values()), default=0)):
            lines.append("  ".join((p[k] if k < len(p) else "").ljust(width[c]) for c, p in parts.items()).rstrip())
    return "\n".join(x for x in lines if x)


def numbered(value: int, kind: str) -> str:
    """A list number as digits, letters (``a``, ``A``) or Roman numerals (``i``, ``I``)."""
    text = ""
    if kind in ("a", "A") and value > 0:
        while value:
            value, digit = divmod(value - 1, 26)
            text = chr(97 + digit) + text
    elif kind in ("i", "I") and 0 < value < 4000:
        for size, mark in ROMAN:
            text += mark * (value // size)
            value %= size
    else:
        return str(value)
    return text.upper() if kind.isupper() else text


def whole(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"\s*[-+]?[0-9]{1,9}", value) else None


def looked_ahead(found: list[tuple[str, str, dict[str, str] | None]]) -> tuple[dict[int, int], set[int]]:
    """What the start of an element does not tell: numbers of items of reversed lists, and options that closed selects do not show,
    by the elements' places in ``found``."""
    counts: dict[int, int] = {}
    unshown: set[int] = set()
    lists: list[int] = []
    selects: list[tuple[bool, list[int], list[int]]] = []  # whether open, options, selected ones
    for place, (kind, value, attrs) in enumerate(found):
        if kind == "enter":
            if value in ("ul", "ol", "menu"):
                lists.append(place)
            elif value == "li" and lists:
                counts[lists[-1]] = counts.get(lists[-1], 0) + 1
            elif value == "select":
                selects.append(("multiple" in attrs or (whole(attrs.get("size")) or 0) > 1, [], []))
            elif value == "option" and selects:
                selects[-1][1].append(place)
                if "selected" in attrs:
                    selects[-1][2].append(place)
        elif kind == "leave":
            if value in ("ul", "ol", "menu") and lists:
                lists.pop()
            elif value == "select" and selects:
                listed, options, chosen = selects.pop()
                if not listed:
                    unshown |= set(options) - {(chosen[-1:] or options[:1] or [-1])[0]}
    return counts, unshown


def span(value: str | None) -> int:
    return min(int(value), 1000) if value and value.isascii() and value.isdigit() and int(value[:6]) else 1


class Grid:
    """A table that is being read."""

    def __init__(self):
        self.rows: list[list[tuple[str, int, int]]] = []
        self.cell = (1, 1)


def render(page: str | None) -> str:
    """The visible text of a page."""
    page = page or ""
    found: Iterator | list = events(page)
    sheet, low = Sheet(), page.lower()
    counts: dict[int, int] = {}
    unshown: set[int] = set()
    if "<style" in low or "<select" in low or "reversed" in low:
        found = list(found)
        sheet = style_of(found)
        counts, unshown = looked_ahead(found)

    flows, grids = [Flow()], []
    lists: list[tuple[int, int, str] | None] = []  # next number, step and kind of an ordered list; none of others
    plain: list[bool] = []  # open lists without markers
    marker, item = "", True  # list-style of the element at hand, and whether its display leaves a marker
    fresh = False  # a pre has just begun
    folded: list[str] = []  # open elements inside details that are closed
    opened: list[tuple[str, bool, str]] = []  # open elements: tag, whether visible, "svg" or "math" inside one of these
    hidden = pre = 0

    def shown(tag: str, attrs: dict[str, str]) -> tuple[str, bool, str] | None:
        """The entry of ``opened`` for an element, or none if it is not displayed."""
        nonlocal marker, item
        marker, item = "", True
        above, visible, inside = opened[-1] if opened else ("", True, "")
        if tag in HIDDEN or tag == "input" and attrs.get("type", "").strip().lower() not in BUTTONS or tag in UNDRAWN.get(inside.removesuffix(" text"), ()):
            return None
        base = {"display": "none"} if "hidden" in attrs or tag == "dialog" and "open" not in attrs else {}
        if inside or tag == "svg":
            base |= {k: attrs[k].strip().lower() for k in ("display", "visibility") if k in attrs}
        inline = attrs.get("style", "")
        if sheet.rules or base or inline:
            names = {"*", tag, *("." + c.lower() for c in attrs.get("class", "").split()), "#" + attrs.get("id", "").lower()}
            style = sheet.style(names, inline, base)
            if style.get("display") == "none":
                return None
            marker, item = style.get("list-style", ""), style.get("display", "list-item") == "list-item"
            own = style.get("visibility")
            visible = own == "visible" if own in ("visible", "hidden", "collapse", "initial") else visible
            visible = visible or own == "initial"
        if tag in ("svg", "math"):
            inside = tag
        elif inside == "svg" and tag == "text":
            inside = "svg text"
        elif inside.startswith("svg") and (tag == "foreignobject" or tag in BREAKOUT):
            inside = ""
        return tag, visible, inside

    for place, (kind, value, attrs) in enumerate(found):
        flow = flows[-1]
        if hidden:
            hidden += (kind == "enter") - (kind == "leave")
            continue
        if kind == "text":
            if (not folded or folded[-1] != "details") and (not opened or opened[-1][1] and opened[-1][2] != "svg"):
                # a line end right after the start of a pre is none of its text
                flow.text(re.sub(r"^\r?\n", "", value) if fresh else value, pre > 0)
            fresh = False
            continue
        fresh = False
        gap = 2 if value in APART else 1 if value in LINES else 0
        if value in ("ul", "ol") and lists[1:]:
            gap = 1  # a list in a list
        if kind == "enter":
            entry = None if folded and folded[-1] == "details" and value != "summary" or place in unshown else shown(value, attrs)
            if not entry:
                hidden = 1
                continue
            if opened and opened[-1][0] in PARTED and entry[1]:
                flow.text(" ", False)
            opened.append(entry)
            if value == "text" and entry[2] == "svg text":
                gap = 1  # a label
            if folded:
                folded.append(value)
            elif value == "details" and "open" not in attrs:
                folded.append(value)
            if value == "br":
                flow.end(1, keep=pre > 0)
                continue
            if value == "input":
                if entry[1]:
                    flow.text(attrs.get("value", ""), False)
                continue
            if gap:
                flow.end(1 if value in ("ul", "ol") and lists else gap, keep=pre > 0 and flow.filled())
            if value == "pre":
                pre += 1
                fresh = True
            elif value in ("ul", "ol", "menu"):
                start, back = whole(attrs.get("start")), "reversed" in attrs
                first = start if start is not None else counts.get(place, 0) if back else 1
                kind_of = STYLED.get(marker, attrs.get("type", "1").strip())
                lists.append((first, -1 if back else 1, kind_of) if value == "ol" else None)
                plain.append(marker == "none")
                flow.indent += "  "
            elif value == "li":
                mark = "- "
                if lists and lists[-1] is not None:
                    number, step, kind_of = lists[-1]
                    own = whole(attrs.get("value"))
                    number = number if own is None else own
                    lists[-1] = number + step, step, kind_of
                    mark = numbered(number, STYLED.get(marker, attrs.get("type", kind_of).strip())) + ". "
                bare = not item or marker == "none" or marker == "" and bool(plain) and plain[-1]
                flow.markers = [mark] if entry[1] and not bare else []
            elif value in ("dd", "blockquote"):
                flow.indent += "  "
            elif value == "table":
                grids.append(Grid())
            elif value == "tr" and grids:
                grids[-1].rows.append([])
            elif value in CELLS and grids:
                grids[-1].cell = span(attrs.get("colspan")), span(attrs.get("rowspan"))
                cell = Flow()
                cell.span = grids[-1].cell
                flows.append(cell)
        else:
            if opened.pop()[2] == "svg text" and value == "text":
                gap = 1
            if folded:
                folded.pop()
            if value in CELLS and grids and len(flows) > 1:
                flows.pop()
                if not grids[-1].rows:
                    grids[-1].rows.append([])
                grids[-1].rows[-1].append((flow.done(), *flow.span))
                continue
            if gap:
                flow.end(1 if value in ("ul", "ol") and len(lists) > 1 else gap, keep=pre > 0 and flow.filled())
            if value == "pre":
                pre -= 1
            elif value in ("ul", "ol", "menu") and lists:
                lists.pop()
                plain.pop()
                flow.indent = flow.indent[:-2]
            elif value == "li":
                flow.markers = []
            elif value in ("dd", "blockquote"):
                flow.indent = flow.indent[:-2]
            elif value == "table" and grids:
                text = laid_out(grids.pop().rows)
                if text:
                    for row in text.split("\n"):
                        flow.line.append(row)
                        flow.end(1, keep=True)
                    flow.gap = 2
    return flows[0].done()


def visible_text(pages: DataFrame) -> DataFrame:
    """page_id and text of every row of ``pages`` (page_id, html)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("page_id", pages.schema["page_id"].dataType), StructField("text", StringType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(p) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, out.field(1).type)], schema=out)

    return pages.select("page_id", "html").mapInArrow(run, schema)


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of all pages."""
    return visible_text(table(spark, sf_dir, "pages"))

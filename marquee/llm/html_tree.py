"""HTML text to a flat tree of block nodes, tolerant of unclosed and stray tags."""

from __future__ import annotations

import html
import re
from collections import Counter

# Element names by how they act on text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe".split())
# No article text stands in these, if they are closed; annotations repeat a formula in another notation.
SKIPPED = frozenset("svg object video audio canvas select template annotation annotation-xml".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr img".split())
# Their text belongs to the block around them.
_FORMULA = frozenset("math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose "
                     "msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mlabeledtr mtr mtd "
                     "maction semantics".split())
_DRAWING = frozenset("g path circle rect line polyline polygon ellipse use defs symbol stop lineargradient radialgradient "
                     "clippath mask".split())
# Start tags that end an open drawing, and elements of a drawing that hold such tags.
_LEAVES_SVG = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li menu "
                        "meta ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_HTML_IN_SVG = frozenset(("foreignobject", "desc", "title"))
# An opening tag of the first kind ends an open element of the second.
_ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
         "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
         "tbody": ("thead", "tbody", "tr", "td", "th"), "thead": ("thead",), "tfoot": ("tbody", "tr", "td", "th")}
_LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",),
           "th": ("table",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
_CLOSES_P = frozenset("address article aside blockquote center details dialog div dl fieldset figcaption figure "
                      "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section "
                      "table ul li dt dd".split())

# A quote opens a quoted value only after "="; one that is never closed ends with its tag.
_VALUE = r"""\"[^"]*+"|'[^']*+'|["'][^>]*+|[^\s>"'][^\s>]*+"""
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:%s)?+)*+)(?:>|\Z)""" % _VALUE, re.S)
_ATTRIBUTE = re.compile(r"""([^\s>/=]+)\s*+=\s*+(%s)|([^\s>/=]+)""" % _VALUE)
_SKIPPED = re.compile(r"<(?:%s)\b" % "|".join(sorted(SKIPPED)), re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


def _elements(source: str) -> tuple[dict[int, int], set[int]]:
    """Where each closed element of ``SKIPPED`` starts and ends, and where ``RAW`` names stand as parts of a drawing.

    An element that ends with an element around it, or with the page, is not closed.
    """
    ends: dict[int, int] = {}
    parts: set[int] = set()
    if not _SKIPPED.search(source):
        return ends, parts
    at, stack, n_open = 0, [("", 0, False)], Counter()  # open elements: name, start, whether inside is a drawing

    def pop() -> tuple[str, int]:
        name, start, _ = stack.pop()
        n_open[name] -= 1
        return name, start

    while m := _TOKEN.search(source, at):
        at = m.end()
        if not m[2]:
            continue
        name, begin, drawing = m[2].lower(), m.start(), stack[-1][2]
        if m[1]:
            if n_open[name]:
                found, start = pop()
                while found != name:
                    found, start = pop()
                if name in SKIPPED:
                    ends[start] = at
            continue
        if drawing and name in _LEAVES_SVG:
            while stack[-1][2]:
                pop()
            drawing = False
        if drawing and name in RAW:
            parts.add(begin)
        elif name in RAW:
            end = _RAW_END[name].search(source, at)
            at = end.end() if end else len(source)
            continue
        if m[3].endswith("/") and (drawing or name in ("svg", "math")):
            ends[begin] = at
        elif drawing or not (name in VOID or name in INLINE or name == "p"):
            stack.append((name, begin, name == "svg" or drawing and name not in _HTML_IN_SVG))
            n_open[name] += 1
    return ends, parts


class Page:
    """Nodes in page order. Elements and text blocks share the arrays ``parent`` and ``tag``.

    A text block is a node tagged ``#text`` under the block element it stands
    in; ``text`` is its normalised text and ``linked`` the characters of it
    that are inside links. ``attrs`` holds the attribute string of an element.
    """

    def __init__(self, source: str):
        self.parent: list[int] = [-1]
        self.tag: list[str] = ["#root"]
        self.attrs: list[str] = [""]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]
        self._stack = [(0, "#root")]   # open block elements
        self._inline: list[str] = []   # open inline elements
        self._buffer: list[str] = []
        self._in_link = 0
        self._parse(source)

    def _add(self, parent: int, tag: str, attrs: str, text: str, linked: int) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.attrs.append(attrs)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.parent) - 1

    def _flush(self) -> None:
        text = " ".join("".join(self._buffer).split())
        if text:
            self._add(self._stack[-1][0], "#text", "", text, min(self._in_link, len(text)))
        self._buffer, self._in_link = [], 0

    def _write(self, piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            self._buffer.append(piece)
            if "a" in self._inline:
                self._in_link += len(piece.strip())

    def _pop_to(self, names: tuple[str, ...], limits: tuple[str, ...] = ()) -> None:
        """Close the innermost open element with one of the names, unless a limit stands before it."""
        for depth in range(len(self._stack) - 1, 0, -1):
            name = self._stack[depth][1]
            if name in names:
                self._flush()
                del self._stack[depth:]
                self._inline.clear()
                return
            if name in limits:
                return

    def _open(self, name: str, attrs: str) -> None:
        if name in _CLOSES_P:
            self._pop_to(("p",), ("td", "th", "table", "button", "caption", "object"))
        if name in _ENDS:
            names = _ENDS[name]
            while any(n in names for _, n in self._stack):
                before = len(self._stack)
                self._pop_to(names, _LIMITS.get(name, ()))
                if len(self._stack) == before:
                    break
        self._flush()
        self._stack.append((self._add(self._stack[-1][0], name, attrs, "", 0), name))

    def _parse(self, source: str) -> None:
        at, find = 0, _TOKEN.search
        ends, parts = _elements(source)
        while m := find(source, at):
            self._write(source[at:m.start()])
            at = m.end()
            if not m[2]:
                if m[0].startswith("<![CDATA["):
                    self._buffer.append(m[0][9:].removesuffix("]]>"))
                continue
            name = m[2].lower()
            if name in SKIPPED:
                if not m[1]:
                    at = ends.get(m.start(), at)
            elif name in _FORMULA or name in _DRAWING or m.start() in parts:
                if name in ("mtr", "mtd"):
                    self._buffer.append(" ")
            elif m[1]:
                if name in INLINE:
                    if name in self._inline:
                        self._inline.reverse()
                        self._inline.remove(name)
                        self._inline.reverse()
                elif name in ("br", "p") and name not in (n for _, n in self._stack):
                    self._buffer.append(" ")
                else:
                    self._pop_to((name,), ("table",) if name in ("p", "div", "li") else ())
            elif name in RAW:
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else len(source)
            elif name == "br":
                self._buffer.append(" ")
            elif name == "hr":
                self._pop_to(("p",), ("td", "th", "table"))
                self._flush()
            elif name in INLINE:
                if name not in VOID:
                    self._inline.append(name)
            elif name not in VOID:
                self._open(name, m[3])
        self._write(source[at:])
        self._flush()


def attributes(raw: str) -> dict[str, str]:
    """Attribute names (lower case) and values of a tag's attribute string; first one counts."""
    out: dict[str, str] = {}
    for name, value, bare in _ATTRIBUTE.findall(raw):
        out.setdefault((name or bare).lower(), html.unescape(value.strip("\"'")))
    return out

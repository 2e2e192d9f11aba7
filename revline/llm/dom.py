"""A tolerant HTML reader: element tree, class words and text runs of a page.

One pass over the page with a stack of open elements. Elements that never hold
readable text (scripts, styles, the head, form controls) are read over. Every step
costs time in proportion to what it reads or closes, however the page is nested.
"""

from __future__ import annotations

import html
import re

#: fixed values of the HTML standard: element names by their role in reading a page
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
            "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol "
            "p pre search section summary table tbody td tfoot th thead tr ul".split())
RAW = set("iframe noembed noframes script style textarea title xmp".split())
UNREAD = set("audio button canvas datalist head iframe noembed noframes noscript object optgroup option "
             "script select style svg template textarea title video".split())
SCOPE = set("caption html marquee object table td template th".split())
HEADING = set("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = set("base link meta noscript script style template title".split())
#: a start tag closes an open element of the family that lies behind no barrier
_FAMILY = {"li": "li", "dd": "dd", "dt": "dd", "tr": "tr", "td": "td", "th": "td", "tbody": "tbody",
           "thead": "tbody", "tfoot": "tbody", "option": "option", "p": "p"}
_BARRIER = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
            "tbody": {"table"}, "option": {"select"}, "p": SCOPE | {"button"}}

_TAG = re.compile(r"<(?:(!--)|([a-zA-Z][^\s/>]*)|/([a-zA-Z][^\s/>]*)|[!?/])")
_SKIP = re.compile(r"[\s/]*")
_NAME = re.compile(r"=?[^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_BARE = re.compile(r"[^\s>]*")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW}
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: attributes whose words say what an element is for
_TELLING = ("class", "id", "role", "itemprop", "aria-label")


def _attributes(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes of a tag from behind its name, the place behind ``>``, whether it is closed."""
    found: dict[str, str] = {}
    if page[at:at + 1] == ">":
        return found, at + 1, True
    while True:
        at = _SKIP.match(page, at).end()
        if at >= len(page):
            return found, at, False
        if page[at] == ">":
            return found, at + 1, True
        name = _NAME.match(page, at)
        at, value = name.end(), ""
        equals = _EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at:at + 1]
            if quote in ("'", '"') and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return found, len(page), False
                value, at = page[at + 1:end], end + 1
            else:
                bare = _BARE.match(page, at)
                value, at = bare.group(), bare.end()
        found.setdefault(name.group().lower(), value)


class Page:
    """``tag``, ``parent``, ``words`` (of telling attributes) by element, in page order,
    element 0 being the page itself; ``runs``: (element, text), or (-1, " ") between blocks.
    ``marks`` has the value of the attribute ``mark`` where an element has it."""

    def __init__(self, page: str, mark: str | None = None):
        self.tag, self.parent, self.words = ["#page"], [-1], [()]
        self.runs: list[tuple[int, str]] = []
        self.marks: dict[int, str] = {}
        self._mark = mark
        # open elements: (name, element or -1 where unread, nearest open places of families,
        # nearest barrier of each kind, nearest block, unread)
        self._open: list[tuple] = [("#page", 0, {}, -1, -1, False)]
        self._places: dict[str, list[int]] = {}
        self._read(page)

    # -- open elements ---------------------------------------------------
    def _pop_to(self, place: int) -> None:
        """Close the element at ``place`` and all in it."""
        while len(self._open) > place:
            name = self._open.pop()[0]
            self._places[name].pop()
            if name in BLOCK:
                self.runs.append((-1, " "))

    def _push(self, name: str, attributes: dict[str, str]) -> None:
        _, above, families, scope, block, unread = self._open[-1]
        place = len(self._open)
        unread = unread or name in UNREAD
        node = above
        if not unread:
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(above)
            self.words.append(_telling(attributes))
            if self._mark in attributes:
                self.marks[node] = attributes[self._mark]
        family = _FAMILY.get(name)
        blocked = [f for f in families if name in _BARRIER.get(f, ())]
        if blocked or family:
            families = {f: p for f, p in families.items() if f not in blocked}
            if family:
                families[family] = place
        self._open.append((name, node, families, place if name in SCOPE else scope,
                           place if name in BLOCK else block, unread))
        self._places.setdefault(name, []).append(place)

    def _start(self, name: str, attributes: dict[str, str]) -> None:
        if name in ("html", "body", "head") and (self._places.get(name) or (name == "head" and
                                                                             self._places.get("body"))):
            return
        if name not in IN_HEAD and name != "head" and self._places.get("head"):
            self._pop_to(self._places["head"][-1])
        families = self._open[-1][2]
        if name in BLOCK and "p" in families:
            self._pop_to(families["p"])
            families = self._open[-1][2]
        family = _FAMILY.get(name)
        if family in families:
            self._pop_to(families[family])
        if name in HEADING and self._open[-1][0] in HEADING:
            self._pop_to(len(self._open) - 1)
        if name == "a" and self._places.get("a") and self._places["a"][-1] > self._open[-1][4]:
            self._pop_to(self._places["a"][-1])
        if name in BLOCK or name in ("br", "hr"):
            self.runs.append((-1, " "))
        if name not in VOID:
            self._push(name, attributes)

    def _end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.runs.append((-1, " "))
            return
        names = HEADING if name in HEADING else (name,)
        place = max((self._places[n][-1] for n in names if self._places.get(n)), default=-1)
        if place < 0:
            return
        _, _, _, scope, block, _ = self._open[-1]
        if scope > place and name not in SCOPE | {"tr", "tbody", "thead", "tfoot"}:
            return
        if name not in BLOCK and name not in UNREAD and block > place:
            return
        if name == "li" and "li" not in self._open[-1][2]:
            return
        self._pop_to(place)

    def _text(self, text: str) -> None:
        if "&" in text:
            text = html.unescape(text)
        if self._places.get("head") and not text.isspace():
            self._pop_to(self._places["head"][-1])
        _, node, _, _, _, unread = self._open[-1]
        if text and not unread:
            self.runs.append((node, text))

    # -- tokens ----------------------------------------------------------
    def _read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            tag = _TAG.search(page, at)
            if not tag:
                self._text(page[at:])
                break
            if tag.start() > at:
                self._text(page[at:tag.start()])
            comment, start, end = tag.groups()
            at = tag.end()
            if comment:
                if page.startswith(">", at) or page.startswith("->", at):
                    at = page.index(">", at) + 1
                else:
                    closed = re.compile(r"--!?>").search(page, at)
                    at = closed.end() if closed else size
            elif start:
                attributes, at, closed = _attributes(page, at)
                if not closed:
                    break
                name = start.lower()
                if name == "plaintext":
                    self._text(page[at:])
                    break
                self._start(name, attributes)
                if name in RAW:
                    stop = _RAW_END[name].search(page, at)
                    if name == "xmp" and not self._open[-1][5]:
                        self.runs.append((self._open[-1][1], page[at:stop.start() if stop else size]))
                    at = stop.start() if stop else size
            elif end:
                _, at, closed = _attributes(page, at)
                if closed:
                    self._end(end.lower())
            else:
                close = page.find(">", at - 1)
                at = close + 1 if close >= 0 else size


def _telling(attributes: dict[str, str]) -> tuple[str, ...]:
    if not attributes:
        return ()
    said = " ".join([attributes[a] for a in _TELLING if a in attributes])
    out = [w.lower() for w in _WORD.findall(said) if len(w) > 1] if said else []
    if "hidden" in attributes or _HIDDEN.search(attributes.get("style", "")):
        out.append("hidden")
    return tuple(dict.fromkeys(out))

"""Cuts pages into blocks of text and describes each block by numbers."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np

PATH_SIZE, LEAF_SIZE, WORD_SIZE, PLAIN_SIZE = 32, 16, 32, 8
SIZE = PATH_SIZE + LEAF_SIZE + WORD_SIZE + PLAIN_SIZE

# Fixed values of HTML: elements without content, of raw text, never shown, and inside a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
HIDDEN = frozenset("head template noscript object canvas audio video select datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rb rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr"
    " math maction menclose merror mfenced mfrac mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts"
    " mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split()
)
# Raw text that is shown.
SHOWN_RAW = frozenset("xmp plaintext".split())
# What a head can hold; any other element and any text end it.
IN_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
# Elements in a line whose text is not shown; inside them, those that show text, and never shown parts.
FOREIGN = frozenset("svg annotation annotation-xml".split())
FOREIGN_SHOWN = frozenset("text foreignobject".split())
FOREIGN_HIDDEN = frozenset("defs symbol desc metadata clippath mask pattern marker".split()) | HIDDEN
# Elements of a page that end a drawing they begin in.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta"
    " nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
# Start tags: the open elements they end, and those beyond which they don't look.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# A tag whose quoted values, if any, hold no angle brackets; others are read value by value.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_PLAIN = re.compile(r"[^>\"']*+")
_COMMENT_END = re.compile(r"--!?>")
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SPACE = re.compile(r"\s+")


@dataclass(eq=False, slots=True)
class Element:
    """An open element: its name, its name and words as one text, and the element it is in."""

    name: str
    described: str
    parent: Element | None
    depth: int


@dataclass
class Block:
    """A piece of text between block elements: the innermost element it is in, and what is in it."""

    element: Element | None
    text: str
    linked: int = 0


def along_paths(page: list[Block], start, step) -> list:
    """``step(state, element)`` carried from the outermost to the innermost element of each block.

    Elements that blocks share are gone through once, so the effort is that of all elements, however
    deep they are nested.
    """
    known: dict[Element | None, object] = {None: start}
    for block in page:
        element, way = block.element, []
        while element not in known:
            way.append(element)
            element = element.parent
        for inner in reversed(way):
            known[inner] = step(known[inner.parent], inner)
    return [known[block.element] for block in page]


@dataclass
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    open: list[Element] = field(default_factory=list)
    # Where the open elements of a name are in ``open``, and how many elements in a line are open.
    places: defaultdict[str, list[int]] = field(default_factory=lambda: defaultdict(list))
    inline: Counter = field(default_factory=Counter)
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    hidden: int = 0
    # Open elements of drawings: name, whether text is shown, whether it is in a part that never is, whether of a page.
    foreign: list[tuple[str, bool, bool, bool]] = field(default_factory=list)
    within: Counter = field(default_factory=Counter)

    def text(self, piece: str, raw: bool = False) -> None:
        if self.open and self.open[-1].name == "head" and piece.strip(" \t\n\f\r"):
            self._end_head()
        if piece and not self.hidden and not (self.foreign and not self.foreign[-1][1]):
            piece = unescape(piece) if "&" in piece and not raw else piece
            self.parts.append(piece)
            if self.inline["a"]:
                self.linked += len(piece)

    def cut(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", "".join(self.parts)).strip()
            if text:
                self.blocks.append(Block(self.open[-1] if self.open else None, text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def _end_head(self) -> None:
        self.cut()
        while self.open and self.open[-1].name == "head":
            self._pop()

    def raw(self, name: str, rest: str, text: str) -> None:
        """An element of raw text."""
        if name not in IN_HEAD and self.open and self.open[-1].name == "head":
            self._end_head()
        if name in SHOWN_RAW:
            self.start(name, rest)
            self.text(text, raw=True)
            self.close(name)

    def _start_foreign(self, name: str, rest: str) -> None:
        """An element in a drawing, or the drawing: in a line, whatever it is. Parts of a page in it are set off by spaces."""
        _, shown, never, page = self.foreign[-1] if self.foreign else ("", False, False, False)
        if page and (name not in INLINE or name == "br"):
            self.text(" ")
        if rest.endswith("/") and (not page or name in FOREIGN) or page and name in VOID:
            return
        never = never or name in FOREIGN_HIDDEN
        shown = not never and (name in FOREIGN_SHOWN or shown and name not in FOREIGN)
        self.foreign.append((name, shown, never, name == "foreignobject" or page and name not in FOREIGN))
        self.within[name] += 1

    def _close_foreign(self, name: str) -> bool:
        """Whether an end tag is one of the drawing, or has no effect in it."""
        if not self.within[name]:
            return self.foreign[-1][3]
        while self.within[name]:
            last, _, _, page = self.foreign.pop()
            self.within[last] -= 1
            if page and last not in INLINE:
                self.text(" ")
            if last == name:
                break
        return True

    def start(self, name: str, rest: str) -> None:
        if self.open and self.open[-1].name == "head" and name not in IN_HEAD:
            self._end_head()
        if self.foreign and name in BREAKOUT and not self.foreign[-1][3]:
            self._break_out()
        if self.foreign or name in FOREIGN:
            self._start_foreign(name, rest)
            return
        if name == "br":
            self.text(" ")
        if name in VOID:
            if name not in INLINE:
                self.cut()
            return
        if name in INLINE:
            self.inline[name] += 1
            return
        self.cut()
        self._end_open(name)
        self.places[name].append(len(self.open))
        self.open.append(Element(name, _words(name, rest), self.open[-1] if self.open else None, len(self.open) + 1))
        if name in HIDDEN:
            self.hidden += 1

    def _break_out(self) -> None:
        while self.foreign and not self.foreign[-1][3]:
            self.within[self.foreign.pop()[0]] -= 1

    def _end_open(self, name: str) -> None:
        if self.open and self.open[-1].name == "p":
            self._pop()
        if name not in ENDS:
            return
        ends, until = (max((self.places[n][-1] for n in names if self.places[n]), default=-1) for names in ENDS[name])
        if ends > until:
            while len(self.open) > ends:
                self._pop()

    def _pop(self) -> None:
        name = self.open.pop().name
        self.places[name].pop()
        self.inline.clear()
        if name in HIDDEN:
            self.hidden -= 1

    def close(self, name: str) -> None:
        if self.foreign:
            if self._close_foreign(name):
                return
            # The end of an element around the drawing ends the drawing; any other has no effect.
            if not self.places[name] and not self.inline[name]:
                return
            self.foreign.clear()
            self.within.clear()
        if name in INLINE:
            if self.inline[name]:
                self.inline[name] -= 1
            return
        self.cut()
        if self.places[name]:
            while self.open[-1].name != name:
                self._pop()
            self._pop()


def _described(name: str, rest: str) -> str:
    """An element's name and the words of its class, id and role: ``div content main``."""
    words = [p.lower() for m in _NAMES.finditer(rest) for p in _PARTS.findall(m[1] or m[2] or m[3] or "")]
    return " ".join([name, *dict.fromkeys(words)])


_remembered = lru_cache(maxsize=20_000)(_described)


def _words(name: str, rest: str) -> str:
    """``_described``, remembered unless it is long."""
    return _remembered(name, rest) if len(rest) < 500 else _described(name, rest)


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order. Text of a block has one space for any white space.

    Comments, scripts, styles, the head and other parts that are not shown give none. Unclosed
    elements end where HTML ends them, the head at what it can't hold; a sign that begins no tag is
    text. Formulas and the texts of drawings are part of the line they are in.
    """
    reader, at = _Reader(), 0
    while (sign := html.find("<", at)) >= 0:
        after = html[sign + 1 : sign + 4]
        if after == "!--":
            reader.text(html[at:sign])
            at = _comment_end(html, sign + 4)
            continue
        if after[:1] in ("!", "?"):
            end = html.find(">", sign)
            reader.text(html[at:sign])
            at = len(html) if end < 0 else end + 1
            continue
        m = _TAG.match(html, sign) or _long_tag(html, sign)
        if m is None:
            reader.text(html[at : sign + 1])
            at = sign + 1
            continue
        reader.text(html[at:sign])
        close, name, rest = m[1], m[2].lower(), m[3]
        at = m.end() if isinstance(m, re.Match) else m[4]
        if close:
            reader.close(name)
        elif name in RAW and not (reader.foreign and rest.endswith("/")):
            end = _end_tag(name).search(html, at) if name != "plaintext" else None
            reader.raw(name, rest, html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        else:
            reader.start(name, rest)
    reader.text(html[at:])
    reader.cut()
    return reader.blocks


def _comment_end(html: str, at: int) -> int:
    """Behind a comment whose text begins at ``at``; some comments end before they have any."""
    for early in (">", "->"):
        if html.startswith(early, at):
            return at + len(early)
    end = _COMMENT_END.search(html, at)
    return end.end() if end else len(html)


@lru_cache(maxsize=64)
def _end_tag(name: str) -> re.Pattern:
    return re.compile(rf"</{name}\b[^>]*>", re.I)


def _long_tag(html: str, at: int) -> tuple[str, str, str, str, int] | None:
    """A tag with angle brackets inside its quoted values; without an end it takes the rest."""
    m = _NAME.match(html, at)
    if m is None:
        return None
    place = m.end()
    while True:
        place = _PLAIN.match(html, place).end()
        if place >= len(html):
            return "", m[1], m[2], "", len(html)
        if html[place] == ">":
            return "", m[1], m[2], html[m.end() : place], place + 1
        # A quote opens a value only behind an equals sign.
        if html[max(m.end(), place - 9) : place].rstrip()[-1:] == "=":
            end = html.find(html[place], place + 1)
            place = len(html) if end < 0 else end + 1
        else:
            place += 1


@lru_cache(maxsize=50_000)
def _signs(word: str, size: int) -> np.ndarray:
    """A fixed random direction for a word."""
    return np.random.default_rng(zlib.crc32(word.encode())).choice([-1.0, 1.0], size).astype(np.float32) / np.sqrt(size)


def _element_vector(described: str) -> np.ndarray:
    """Sums of the directions of an element's words: for the path it is on, and for it as the innermost."""
    out = np.zeros(PATH_SIZE + LEAF_SIZE, np.float32)
    for word in described.split(" "):
        out[:PATH_SIZE] += _signs(word, PATH_SIZE)
        out[PATH_SIZE:] += _signs(word, LEAF_SIZE)
    return out


_remembered_vector = lru_cache(maxsize=20_000)(_element_vector)


def _on_path(outer: np.ndarray, element: Element) -> np.ndarray:
    """The sum over all elements of a path, and the vector of the innermost."""
    known = _remembered_vector if len(element.described) < 500 else _element_vector
    out = known(element.described).copy()
    out[:PATH_SIZE] += outer[:PATH_SIZE]
    return out


def describe(page: list[Block]) -> np.ndarray:
    """A row of numbers per block: tag path, innermost element, hashed words, plain counts."""
    out = np.zeros((len(page), SIZE), np.float32)
    if not page:
        return out
    hashes = [list(map(zlib.crc32, b.text.encode("utf-8", "replace").split())) for b in page]
    counts = np.array([len(h) for h in hashes])
    flat = np.fromiter((x for h in hashes for x in h), np.int64, counts.sum()) % WORD_SIZE
    row = np.repeat(np.arange(len(page)), counts)
    words = np.bincount(row * WORD_SIZE + flat, minlength=len(page) * WORD_SIZE).reshape(len(page), WORD_SIZE)
    lengths = np.array([len(b.text) for b in page], np.float32)
    # The text outside of all elements has the direction of the empty word, as innermost.
    outside = np.concatenate([np.zeros(PATH_SIZE, np.float32), _signs("", LEAF_SIZE)])
    for i, vector in enumerate(along_paths(page, outside, _on_path)):
        out[i, : PATH_SIZE + LEAF_SIZE] = vector
    out[:, PATH_SIZE + LEAF_SIZE : -PLAIN_SIZE] = words / np.sqrt(np.maximum(1, counts))[:, None]
    out[:, -8] = np.log1p(lengths) / 5
    out[:, -7] = np.log1p(counts) / 4
    out[:, -6] = [b.linked / len(b.text) for b in page]
    out[:, -5] = [b.text[-1] in ".!?…»”\"'" for b in page]
    out[:, -4] = [any(c in b.text for c in "©®|·") for b in page]
    out[:, -3] = [min(8, b.element.depth if b.element else 0) / 8 for b in page]
    out[:, -2] = np.arange(len(page)) < 3
    out[:, -1] = np.arange(len(page))[::-1] < 3
    return out

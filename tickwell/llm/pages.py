"""Main text of web pages from flat text blocks.

A page becomes a flat list of blocks. Each block has its words, its share of linked words, those of
its two neighbours, the kind of container it lies in, and how far the names of its containers speak
against it. A decision tree fitted to a small table of labelled blocks says which blocks belong to the
article; no name and no container decides by itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import table, text_of
from tickwell.shipping import ship

# Comments, elements that run to the end of the page if they are not closed, declarations, tags.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    # A value ends at a quote that something which may follow a value follows; where a quote was lost,
    # the next one opens a value, and the tag is read up to its first bracket instead.
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>"']|"[^"]*"(?=[\s/>])|'[^']*'(?=[\s/>]))*)>"""
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest2>[^>]*)>",
    re.DOTALL | re.IGNORECASE,
)
HINT = re.compile(r"""(?<![\w-])(class|id|role|style|aria-hidden|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
LETTER_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")
PART = re.compile(r"[^a-z0-9]+")

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
SPACE = frozenset(["br"])
BOXES = frozenset(
    "article aside body div dl dialog figure footer form header html li main menu nav ol section table "
    "tbody td th thead tr ul fieldset button label legend details center blockquote".split()
)
OUTER = frozenset("nav aside footer form menu dialog fieldset button label legend".split())
INNER = frozenset(["article", "main"])
#: Their content is never text. Like `head` they end at their end tag or with their container.
LEFT_OUT = frozenset("template object select svg math".split())
#: Their content is no markup, so only their end tag counts.
PLAIN_CONTENT = frozenset(["noscript", "iframe"])
#: What may stand in a head; any other tag, and text, ends it.
IN_HEAD = frozenset("head html base basefont bgsound link meta noframes noscript script style template title".split())
#: Tags that cannot stand in a drawing or a formula and end it.
NO_DRAWING = BOXES | frozenset("b big br code dd dt em embed h1 h2 h3 h4 h5 h6 hr i img p pre s small span strong sub sup tt u var".split())
#: Words in a class, id or role that mark a container as no part of the article.
NOTICES = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer discussion disqus dropdown footer form gdpr hidden legal login masthead "
    "menu menubar modal nav navbar navigation newsletter notice notices notification overlay pagination pager "
    "popup promo promoted promotion related reply replies respond search share sharing sidebar signup sitenav skip "
    "social sponsor sponsored subscribe tags toolbar topbar widget widgets".split()
)
#: Of these, what readers say: an article in such a container is one of theirs.
REMARKS = frozenset("comment comments discussion disqus replies reply respond".split())
#: A word before a notice that says the container only goes with one, or goes without.
ASIDE_FROM = frozenset("with has have no non without hide after before not".split())
#: Headings above the remarks of readers.
REMARK_HEADINGS = frozenset(
    "comments comment discussion responses replies kommentare kommentar diskussion commentaires commentaire "
    "comentarios comentario respuestas".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PLAIN, INSIDE, OUTSIDE, SKIPPED = 0, 1, 2, 3

#: `zone`: the container by its element. `hint`: the largest share of notice words in the name of a
#: container, up to the article's own element; `around`: the same for the containers outside of that.
FEATURES = ("words", "links", "before", "links_before", "after", "links_after", "zone", "hint", "around")

#: Labelled blocks: the features in order, then 1 for article text. Unnamed blocks first: long ones and
#: short ones among them are text; linked ones and short ones among those are not.
LABELLED = (
    (42, 0.0, 0, 0.0, 55, 0.0, 0, 0, 0, 1), (55, 0.0, 42, 0.0, 31, 0.0, 0, 0, 0, 1), (31, 0.05, 55, 0.0, 18, 0.0, 0, 0, 0, 1),
    (18, 0.0, 31, 0.05, 60, 0.0, 0, 0, 0, 1), (12, 0.0, 48, 0.0, 37, 0.1, 0, 0, 0, 1), (7, 0.0, 0, 0.0, 64, 0.0, 0, 0, 0, 1),
    (3, 0.0, 45, 0.0, 52, 0.0, 0, 0, 0, 1), (90, 0.2, 3, 0.0, 2, 1.0, 0, 0, 0, 1), (25, 0.12, 30, 0.0, 4, 1.0, 0, 0, 0, 1),
    (16, 0.0, 4, 1.0, 22, 0.0, 0, 0, 0, 1), (9, 0.0, 26, 0.0, 33, 0.0, 0, 0, 0, 1), (120, 0.03, 8, 0.0, 70, 0.0, 0, 0, 0, 1),
    (60, 0.0, 40, 0.0, 0, 0.0, 0, 0, 0, 1), (14, 0.0, 40, 0.0, 1, 1.0, 0, 0, 0, 1), (35, 0.0, 2, 1.0, 1, 1.0, 0, 0, 0, 1),
    (2, 0.0, 1, 1.0, 40, 0.0, 0, 0, 0, 1), (4, 0.0, 6, 1.0, 30, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 25, 0.0, 0, 0, 0, 1),
    (9, 0.0, 1, 1.0, 0, 0.0, 0, 0, 0, 1), (12, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 1), (10, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 1),
    (5, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1), (8, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (4, 0.0, 0, 0.0, 5, 0.0, 0, 0, 0, 1), (5, 0.0, 4, 0.0, 6, 0.0, 0, 0, 0, 1), (6, 0.0, 5, 0.0, 0, 0.0, 0, 0, 0, 1),
    (3, 0.0, 0, 0.0, 4, 0.0, 0, 0, 0, 1), (4, 0.0, 3, 0.0, 4, 0.0, 0, 0, 0, 1), (3, 0.0, 4, 0.0, 0, 0.0, 0, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (2, 1.0, 1, 1.0, 3, 1.0, 0, 0, 0, 0), (4, 1.0, 2, 1.0, 40, 0.0, 0, 0, 0, 0),
    (3, 0.67, 3, 1.0, 2, 1.0, 0, 0, 0, 0), (8, 0.75, 1, 1.0, 6, 0.5, 0, 0, 0, 0), (30, 0.8, 5, 1.0, 12, 0.9, 0, 0, 0, 0),
    (5, 0.4, 2, 1.0, 0, 0.0, 0, 0, 0, 0), (2, 0.0, 1, 1.0, 1, 1.0, 0, 0, 0, 0), (4, 0.0, 3, 1.0, 0, 0.0, 0, 0, 0, 0),
    (3, 0.0, 0, 0.0, 1, 1.0, 0, 0, 0, 0), (6, 0.5, 60, 0.0, 1, 1.0, 0, 0, 0, 0), (10, 0.6, 30, 0.0, 2, 1.0, 0, 0, 0, 0),
    (2, 0.0, 2, 1.0, 0, 0.0, 0, 0, 0, 0), (1, 0.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (1, 1.0, 0, 0.0, 30, 0.0, 0, 0, 0, 0),
    # In an article or main element.
    (5, 0.0, 0, 0.0, 50, 0.0, 1, 0, 0, 1), (1, 0.0, 60, 0.0, 40, 0.0, 1, 0, 0, 1), (2, 0.0, 20, 0.0, 1, 1.0, 1, 0, 0, 1),
    (80, 0.0, 5, 0.0, 33, 0.0, 1, 0, 0, 1), (33, 0.1, 80, 0.0, 2, 0.0, 1, 0, 0, 1), (4, 1.0, 40, 0.0, 35, 0.0, 1, 0, 0, 1),
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1), (15, 0.5, 9, 0.0, 12, 0.0, 1, 0, 0, 1), (3, 0.0, 1, 1.0, 1, 1.0, 1, 0, 0, 1),
    (1, 0.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1), (6, 0.0, 1, 1.0, 0, 0.0, 1, 0, 0, 1), (2, 1.0, 0, 0.0, 0, 0.0, 1, 0, 0, 1),
    (1, 0.0, 1, 1.0, 1, 0.0, 1, 0, 0, 1), (3, 0.0, 2, 1.0, 7, 0.0, 1, 0, 0, 1), (2, 0.0, 1, 1.0, 12, 0.0, 1, 0, 0, 1),
    # In navigation, asides, footers and forms.
    (1, 1.0, 0, 0.0, 1, 1.0, 2, 0, 0, 0), (25, 0.0, 1, 1.0, 9, 0.0, 2, 0, 0, 0), (60, 0.0, 45, 0.0, 50, 0.0, 2, 0, 0, 0),
    (4, 0.0, 70, 0.0, 0, 0.0, 2, 0, 0, 0), (12, 0.1, 30, 0.0, 14, 0.0, 2, 0, 0, 0), (110, 0.0, 12, 0.0, 8, 0.5, 2, 0, 0, 0),
    (7, 0.3, 80, 0.0, 3, 0.0, 2, 0, 0, 0), (40, 0.05, 6, 0.0, 40, 0.0, 2, 0, 0, 0), (2, 0.0, 0, 0.0, 65, 0.0, 2, 0, 0, 0),
    (5, 0.0, 0, 0.0, 0, 0.0, 2, 0, 0, 0), (14, 0.0, 0, 0.0, 40, 0.0, 2, 0, 0, 0),
    # In containers with names that are mostly notices, and with one notice in a longer name.
    (40, 0.0, 30, 0.0, 25, 0.0, 0, 1, 0, 0), (12, 0.0, 0, 0.0, 45, 0.0, 0, 1, 0, 0), (70, 0.0, 50, 0.0, 0, 0.0, 0, 0.5, 0, 0),
    (5, 0.0, 60, 0.0, 20, 0.0, 0, 0.5, 0, 0), (3, 1.0, 40, 0.0, 1, 1.0, 0, 0.67, 0, 0), (22, 0.0, 4, 1.0, 33, 0.0, 0, 0.5, 0, 0),
    (30, 0.0, 60, 0.0, 9, 0.0, 1, 1, 0, 0), (5, 0.0, 48, 0.0, 20, 0.0, 1, 0.5, 0, 0), (90, 0.0, 30, 0.0, 0, 0.0, 1, 0.5, 0, 0),
    (16, 0.1, 60, 0.0, 3, 0.0, 1, 0.67, 0, 0), (2, 1.0, 40, 0.0, 2, 1.0, 1, 1, 0, 0), (8, 0.0, 0, 0.0, 0, 0.0, 0, 1, 0, 0),
    (45, 0.0, 3, 0.0, 30, 0.0, 0, 0.33, 0, 1), (30, 0.0, 45, 0.0, 20, 0.0, 0, 0.33, 0, 1), (9, 0.0, 40, 0.0, 22, 0.0, 0, 0.25, 0, 1),
    (28, 0.0, 40, 0.0, 30, 0.0, 1, 0.33, 0, 1), (4, 0.0, 30, 0.0, 26, 0.0, 1, 0.33, 0, 1), (6, 0.0, 0, 0.0, 0, 0.0, 0, 0.33, 0, 1),
    # In an article element that lies in a container so named: the page's own has length, cards have not.
    (50, 0.0, 4, 0.0, 60, 0.0, 1, 0, 0.5, 1), (4, 0.0, 0, 0.0, 44, 0.0, 1, 0, 0.5, 1), (26, 0.1, 50, 0.0, 3, 1.0, 1, 0, 1, 1),
    (33, 0.0, 2, 1.0, 41, 0.0, 1, 0, 1, 1), (12, 0.0, 38, 0.0, 27, 0.0, 1, 0, 0.5, 1), (6, 0.0, 55, 0.0, 47, 0.0, 1, 0, 1, 1),
    (5, 1.0, 6, 0.0, 7, 0.0, 1, 0, 0.5, 0), (8, 0.0, 4, 1.0, 5, 1.0, 1, 0, 1, 0), (3, 0.0, 8, 0.0, 4, 1.0, 1, 0, 0.5, 0),
    (7, 0.9, 7, 0.9, 9, 0.8, 1, 0, 0.5, 0), (10, 0.0, 5, 1.0, 6, 1.0, 1, 0, 1, 0), (4, 0.0, 9, 0.0, 8, 0.0, 1, 0, 1, 0),
)


@dataclass(frozen=True)
class Branch:
    feature: int
    cut: float
    low: Branch | float
    high: Branch | float


def fit(rows: np.ndarray, depth: int = 8) -> Branch | float:
    """A tree by Gini impurity over a labelled table (features, then the label)."""
    label = rows[:, -1]
    share = float(label.mean()) if len(rows) else 0.0
    if depth == 0 or share in (0.0, 1.0):
        return share
    best, found = len(rows) * share * (1 - share) - 1e-9, None
    for feature in range(rows.shape[1] - 1):
        values = np.unique(rows[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            side = rows[:, feature] <= cut
            impurity = sum(label[s].sum() * (1 - label[s].mean()) for s in (side, ~side))
            if impurity < best:
                best, found = impurity, (feature, float(cut), side)
    if found is None:
        return share
    feature, cut, side = found
    return Branch(feature, cut, fit(rows[side], depth - 1), fit(rows[~side], depth - 1))


def grade(tree: Branch | float, block: tuple) -> float:
    while isinstance(tree, Branch):
        tree = tree.low if block[tree.feature] <= tree.cut else tree.high
    return tree


def hint_of(name: str, rest: str) -> tuple[float, bool]:
    """How far a container says of itself that it is no part of the article, and whether of readers' remarks.

    The share of notice words in a name, for the class, id or role where it is largest. A notice after a
    word such as `with` or `no` is none. What is hidden speaks against itself altogether.
    """
    share, remarks = 0.0, False
    for hint in HINT.finditer(rest):
        key, value = hint[1].lower(), (hint[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return 1.0, False
        if key == "style":
            if "display:none" in value.replace(" ", "").lower():
                return 1.0, False
        elif key in ("class", "id", "role") and name not in ("body", "html", "main"):
            for token in value.split():
                words = [w for w in PART.split(LETTER_CASE.sub("-", token).lower()) if w]
                said = [w for at, w in enumerate(words) if w in NOTICES and not (at and words[at - 1] in ASIDE_FROM)]
                if said and len(said) / len(words) > share:
                    share, remarks = len(said) / len(words), not REMARKS.isdisjoint(said)
    return share, remarks


@dataclass(frozen=True)
class Place:
    """Where in the page a block lies."""

    zone: int = PLAIN
    hint: float = 0.0
    around: float = 0.0
    remarks: bool = False


class Page:
    """Cuts one page into blocks."""

    def __init__(self) -> None:
        self.blocks: list[tuple[str, int, int, Place]] = []
        self.open: list[tuple[str, Place]] = []
        self.place = Place()
        self.text: list[str] = []
        self.linked: list[str] = []
        self.link = False

    @property
    def zone(self) -> int:
        return self.place.zone

    def end_block(self) -> None:
        words = html.unescape("".join(self.text)).split()
        if words:
            links = len(html.unescape(" ".join(self.linked)).split()) if self.linked else 0
            self.blocks.append((" ".join(words), len(words), min(links, len(words)), self.place))
        self.text, self.linked = [], []

    def in_head(self) -> bool:
        return self.zone == SKIPPED and self.open[-1][0] == "head"

    def words(self, piece: str) -> None:
        if self.in_head() and piece.strip():
            self.leave("head")
        if piece and self.zone != SKIPPED:
            self.text.append(piece)
            if self.link:
                self.linked.append(piece)

    def left_out(self, name: str, close: bool, rest: str) -> bool:
        """Whether a tag lies in content that is left out, once it has ended what it cannot stand in."""
        while self.zone == SKIPPED:
            inner = self.open[-1][0]
            if close:
                at = max((k for k, (n, _) in enumerate(self.open) if n == name), default=-1)
                if at >= 0 and self.open[at][1].zone != SKIPPED and name not in LEFT_OUT and name != "head":
                    return False  # the container ends
                self.leave(name)
                return True
            if inner == "head" and name not in IN_HEAD or inner in ("svg", "math") and name in NO_DRAWING:
                self.leave(inner)
            elif name == "body" and any(n == "head" for n, _ in self.open):
                self.leave("head")
            else:
                if (name in BOXES or name in LEFT_OUT or name == "foreignobject") and not rest.endswith("/"):
                    self.open.append((name, self.place))
                return True
        return False

    def tag(self, name: str, close: bool, rest: str, ends: bool) -> None:
        """`ends`: the page has an end tag of that name further on."""
        if self.left_out(name, close, rest):
            return
        if name in LEFT_OUT or name == "head":
            if name == "head":
                self.end_block()
            empty = name in ("svg", "math") and rest.endswith("/")
            if not close and not empty and (ends or name == "head"):
                self.open.append((name, self.place))
                self.place = replace(self.place, zone=SKIPPED)
        elif name == "a":
            self.link = not close
        elif name in SPACE:
            self.text.append(" ")
        elif name not in INLINE:
            if close and name in HEADINGS:
                self.heading()
            self.end_block()
            self.link = False
            if name in BOXES and not rest.endswith("/"):
                self.leave(name) if close else self.enter(name, rest)
        elif not close and rest and hint_of(name, rest)[0] >= 0.5:
            # A marked inline element is a box of its own.
            self.end_block()
            self.enter(name, rest)
        elif close and any(n == name for n, _ in self.open):
            self.end_block()
            self.leave(name)

    def heading(self) -> None:
        """A heading such as `Comments` names the rest of its container."""
        words = html.unescape("".join(self.text)).lower().split()
        if len(words) <= 3 and self.blocks and not REMARK_HEADINGS.isdisjoint(w.strip("()0123456789:.,") for w in words):
            self.place = replace(self.place, hint=1.0, remarks=True)

    def enter(self, name: str, rest: str) -> None:
        """What a box changes. An article or main in a form, or in a container with a name, is inside again."""
        now = self.place
        share, remarks = hint_of(name, rest)
        zone, hint, around = now.zone, max(now.hint, share), now.around
        remarks = remarks or now.remarks
        wrapped = zone == OUTSIDE and all(n in ("form", "fieldset") for n, _ in self.open if n in OUTER)
        if name in INNER and (zone != OUTSIDE or wrapped) and not remarks:
            # What the containers around are called is a fact of its own; the article's own name counts.
            zone, hint, around = INSIDE, share, max(now.around, now.hint)
        elif name in OUTER or name == "header" and zone == PLAIN:
            zone = OUTSIDE
        self.open.append((name, now))
        self.place = Place(zone, hint, around, remarks)

    def leave(self, name: str) -> None:
        """Closes the last box of that name and what was left open in it; a stray end tag does nothing."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == name:
                self.place = self.open[at][1]
                del self.open[at:]
                return


def blocks_of(source: str) -> list[tuple[str, int, int, Place]]:
    """(text, words, linked words, place) of each block in page order."""
    tokens = list(TOKEN.finditer(source))
    last = {(t["name"] or t["name2"]).lower(): k for k, t in enumerate(tokens) if t["close"] or t["close2"]}
    page, at, until = Page(), 0, ""
    for number, token in enumerate(tokens):
        if not until:
            page.words(source[at : token.start()])
        at = token.end()
        found = token["name"] or token["name2"]
        if not found:
            continue
        name, close, rest = found.lower(), bool(token["close"] or token["close2"]), token["rest"] or token["rest2"] or ""
        ends = last.get(name, -1) > number
        if until:
            until = "" if close and name == until else until
        elif not close and ends and (name in PLAIN_CONTENT or name == "title" and page.in_head()):
            until = name
            if name == "iframe" and page.zone != SKIPPED:
                page.end_block()
        else:
            page.tag(name, close, rest, ends)
    page.words(source[at:])
    page.end_block()
    return page.blocks


def main_text(source: str, tree: Branch | float) -> str:
    """The blocks that the tree takes for article text, joined by line breaks."""
    blocks = blocks_of(source)
    sizes = [(0, 0.0), *((n, k / n) for _, n, k, _ in blocks), (0, 0.0)]
    kept = []
    for at, (text, _, _, place) in enumerate(blocks):
        facts = (*sizes[at + 1], *sizes[at], *sizes[at + 2], place.zone, place.hint, place.around)
        if grade(tree, facts) >= 0.5:
            kept.append(text)
    return "\n".join(kept)


def with_main_text(pages: DataFrame, into: str = "text", column: str = "html") -> DataFrame:
    """Adds the main text of each whole page; other columns stay, one called `into` is replaced.

    Null and empty pages, and pages without article blocks, give the empty text. Broken markup is read
    as far as it goes: stray end tags do nothing, open elements end with their container, a head without
    an end tag at the first text or tag that cannot stand in it. Repeated
    rows are read one by one. No shuffle.
    """
    ship(pages.sparkSession)
    tree = fit(np.array(LABELLED, float))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for sources in batches:
            yield pa.array([main_text(s.as_py() or "", tree) for s in sources], pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return pages.withColumn(into, F.arrow_udf(run, "string")(text_of(column)))


def op9(spark, sf_dir: str) -> DataFrame:
    found = with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

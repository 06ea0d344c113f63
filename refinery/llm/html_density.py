"""Main text of web pages by text-to-tag ratios.

Streaming parser events cut a page into lines: one for each block of text, with the tags that
opened since the line before. A line's ratio is its characters of running text (text in links
counts against it) per tag. Ratios are smoothed with a Gaussian over neighbouring lines, and the lines above a share
of the standard deviation form clusters. The element that holds the heaviest clusters is the
content region; its lines are the text, a short paragraph between two long ones included. So are
those of other elements that hold cluster lines and running text like the region's. ``article`` and
``main`` are a prior only, see :func:`_region`.

Elements that are never article text are left out by their tag or role: menus, headers and footers of
a page, anything hidden. Adverts, cookie banners and readers' comments by their whole name, and
``noscript``, are set aside: they are the text only of a page whose other lines hold no running text.
Forms, and what a name only suggests (sidebars, notices, discussions, a section on consent within an
article), are in doubt: they stay in the region if their own text per element and their links look
like its text, or if they hold the heaviest clusters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Standard deviation of the smoothing in lines, and the threshold in standard deviations of the
#: smoothed ratios.
SIGMA, THRESHOLD = 1.0, 0.25
#: A section replaces the one around it if it holds this part of its clusters' text.
MOST = 0.85
#: Sections marked article or main need only this part of it.
MARKED = 0.5
#: An element outside the region is text if it has at least this part of the region's text per element.
BESIDE = 0.25
#: The same for an element in doubt inside the region.
DOUBTED = 1 / 3
#: Characters of clusters outside an article or main from which on a page has running text, half a sentence.
LEAST_TEXT = 40

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_SKIPPED = frozenset(
    "head script style template svg math iframe object embed canvas audio video map nav aside footer "
    "button select option textarea input dialog menu".split()
)
_RAW = frozenset("script style".split())
_ROLES = frozenset(
    "navigation banner contentinfo complementary search menu menubar toolbar dialog alert alertdialog "
    "status tablist".split()
)
#: Words that say what an element is if its name has no others but these and ``_PLACES``.
_NEVER = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsors sponsored cookie "
    "cookies consent gdpr comments disqus hidden sr-only visually-hidden skip-link comment".split()
)
#: Names of what is not shown.
_HIDDEN = frozenset("hidden sr-only visually-hidden skip-link".split())
#: Of these words, those that an article may have a section on.
_TOPICS = frozenset("cookie cookies consent gdpr sponsor sponsors".split())
#: Words that only suggest it, where a name ends in them (and in ``_PLACES``).
_SUGGESTS = _NEVER | frozenset(
    "leaderboard skyscraper promo promos promotion promotions banner banners nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars side-bar side-col side-column side-nav side-menu footer footers "
    "masthead topbar site-header page-header notice notices notification notifications alert alerts "
    "popup popups pop-up modal modals overlay overlays newsletter newsletters subscribe subscription "
    "subscriptions signup sign-up login log-in paywall replies respond discussion related recommended "
    "recommendations share sharing social toolbar pagination pager search copyright disclaimer".split()
)
#: Words that say where or how a thing stands.
_PLACES = frozenset(
    "area article articles bar block body bottom box button buttons col column container content dialog form "
    "google group heading holder icon icons info inner is item items js label left link links list main media next "
    "outer page panel post posts previous primary reader right row secondary section site slot stories text this "
    "title top unit user warning widget widgets wp wrap wrapper".split()
)
_WORDS, _PLACED = "|".join(sorted(_SUGGESTS)), "|".join(sorted(_PLACES))
_IS_NEVER = re.compile(f"(?:(?:{_WORDS}|{_PLACED})-)*(?:{'|'.join(sorted(_NEVER))})(?:-(?:{_WORDS}|{_PLACED}))*")
_NOT_NEGATED = r"(?:^|(?<!\bno)(?<!\bhas)(?<!\bwith)(?<!\bwithout)(?<!\boverflow)-)"
_IS_SUGGESTED = re.compile(f"{_NOT_NEGATED}(?:{_WORDS})(?:-(?:{_PLACED}))*$")
_IS_HEADER = re.compile(f"{_NOT_NEGATED}(?:header|top)(?:-(?:{_PLACED}))*$")
_IS_TITLE = re.compile("post|entry|article|content|title")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MARKS = ("article", "main")
_SECTIONS = frozenset("article main section div td noscript body".split())
_ENDS_P = _BLOCK - {"body", "html"}
#: Tags whose open element a new one of the same group closes.
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_HOLDERS = frozenset("ul ol dl table tbody thead tfoot div section article main body".split())
_SPACE = re.compile(r"\s+")


@dataclass(eq=False)
class _Element:
    tag: str
    number: int
    skipped: bool
    parent: "_Element | None"
    #: Itself and the elements around it, as far as they are in doubt.
    doubts: "tuple[_Element, ...]" = ()
    #: Whether it or an element around it is set aside.
    aside: bool = False
    #: Start tags before its own content and up to its end.
    before: int = 0
    upto: int = 0


@dataclass
class _Line:
    holder: _Element
    text: str
    tags: int
    linked: int


def _tokens(name: str) -> list[str]:
    """The names in a class or id, small, their words joined by - and without numbers."""
    found = ["-".join(filter(None, re.split(r"[\d_-]+", token.lower()))) for token in _CAMEL.sub("-", name).split()]
    return [token for token in found if token]


class _Events(HTMLParser):
    """Turns parser events into lines; keeps the stack of open elements only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.open = [_Element("", 0, False, None)]
        self.made, self.parts, self.tags, self.linked, self.links, self.started = 0, [], 0, 0, 0, 0
        self.parts_aside, self.tags_aside, self.linked_aside = [], 0, 0

    def _end_line(self) -> None:
        if self.open[-1].aside:
            self._end_aside()
        else:
            self._end_plain(self.open[-1])

    def _end_plain(self, holder: _Element) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append(_Line(holder, text, self.tags, min(self.linked, len(text))))
            self.tags = self.tags_aside = 0
        self.parts, self.linked = [], 0

    def _end_aside(self) -> None:
        """A line set aside has its own text and tags: the line around it goes on as if it were not there."""
        text = _SPACE.sub(" ", "".join(self.parts_aside)).strip()
        if text:
            self.lines.append(_Line(self.open[-1], text, self.tags_aside, min(self.linked_aside, len(text))))
            self.tags_aside = 0
        self.parts_aside, self.linked_aside = [], 0

    def _judged(self, tag: str, attrs: list[tuple[str, str | None]]) -> str:
        """What becomes of an element: "skipped", "aside", "doubted", or "" for one like others."""
        if tag in _SKIPPED:
            return "skipped"
        named = dict(attrs)
        inside = {e.tag for e in self.open}
        if tag == "header" and not inside & {"article", "main"}:
            return "skipped"
        role = (named.get("role") or "").lower()
        if "hidden" in named or named.get("aria-hidden") == "true" or role in _ROLES:
            return "skipped"
        style = (named.get("style") or "").replace(" ", "").lower()
        if "display:none" in style or "visibility:hidden" in style:
            return "skipped"
        if tag in ("html", "body", "article", "main") or re.fullmatch(r"h[1-6]", tag):
            return ""
        if tag == "noscript":
            return "aside"
        tokens = [token for key in ("class", "id") for token in _tokens(named.get(key) or "")]
        if _HIDDEN & set(tokens):
            return "skipped"
        topics = _TOPICS if "article" in inside else frozenset()
        if any(_IS_NEVER.fullmatch(token) and token not in topics for token in tokens):
            return "aside"
        doubted = tag == "form" or role == "form" or any(_IS_SUGGESTED.search(token) for token in tokens)
        if not doubted and not inside & {"article", "main"}:
            doubted = any(_IS_HEADER.search(token) and not _IS_TITLE.search(token) for token in tokens)
        return "doubted" if doubted else ""

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        self.tags_aside += 1
        self.started += 1
        if tag == "br":
            (self.parts_aside if self.open[-1].aside else self.parts).append("\n")
        if tag in _BLOCK:
            self._end_line()
            if tag in _ENDS_P:
                self._close("p", _HOLDERS | {"td", "th", "li", "blockquote"})
            if tag in _CLOSED_BY:
                stop = _HOLDERS - {"tbody", "thead", "tfoot"} if tag in ("li", "dt", "dd") else {"table"}
                for other in _CLOSED_BY[tag]:
                    self._close(other, stop)
        if tag in _VOID:
            return
        parent = self.open[-1]
        self.made += 1
        judged = self._judged(tag, attrs)
        e = _Element(tag, self.made, parent.skipped or judged == "skipped", parent, parent.doubts, parent.aside or judged == "aside", self.started)
        if judged == "doubted":
            e.doubts += (e,)
        self.open.append(e)
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag in ("svg", "path", "iframe", "script"):
            self.handle_endtag(tag)

    def _close(self, tag: str, stop: frozenset | set) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._pop_to(i)
                return
            if self.open[i].tag in stop:
                return

    def _pop_to(self, i: int) -> None:
        self._end_line()
        if self.open[-1].aside and not self.open[i].aside:
            # What was set aside ends with the element around it.
            self._end_plain(next(e for e in reversed(self.open) if not e.aside))
        self._end(i, len(self.open))

    def _end(self, i: int, j: int) -> None:
        if self.open[-1].aside:
            self._end_aside()
        for e in self.open[i:j]:
            e.upto = self.started
            self.links -= e.tag == "a"
        del self.open[i:j]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        self.tags_aside += 1
        if tag in _BLOCK:
            self._end_line()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                if tag not in _BLOCK and any(e.tag in _BLOCK for e in self.open[i + 1 :]):
                    # An inline end inside a block that was opened later: only the inline one ends.
                    self._end(i, i + 1)
                elif tag in _BLOCK:
                    self._pop_to(i)
                else:
                    self._end(i, len(self.open))
                return
            if tag not in _BLOCK and self.open[i].tag in ("article", "main", "body"):
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].skipped or self.open[-1].tag in _RAW:
            return
        if self.open[-1].aside:
            self.parts_aside.append(data)
            self.linked_aside += len(data) if self.links else 0
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self._pop_to(0)


def lines_of(html: str) -> list[_Line]:
    parser = _Events()
    parser.feed(html)
    parser.close()
    return parser.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    inside = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / inside


def _clusters(lines: list[_Line]) -> np.ndarray:
    """The plain text of each line that belongs to a cluster, or of all lines if none does."""
    plain = np.array([len(line.text) - line.linked for line in lines], float)
    ratios = smoothed(plain / np.array([max(line.tags, 1) for line in lines]))
    cluster = ratios > THRESHOLD * ratios.std() if len(lines) > 1 else np.ones(1, bool)
    weights = np.where(cluster, plain, 0.0)
    return weights if weights.any() else plain


def _without_asides(lines: list[_Line]) -> list[_Line]:
    """The lines that are not set aside, or all of a page whose text is nowhere else.

    A page has text elsewhere if an article or main has a line, or clusters have half a sentence.
    """
    rest = [line for line in lines if not line.holder.aside]
    if len(rest) == len(lines) or any(_within(line.holder, _MARKS) for line in rest):
        return rest
    return rest if rest and _clusters(rest).sum() >= LEAST_TEXT else lines


def _cleared(lines: list[_Line]) -> set[int]:
    """Numbers of the elements in doubt that hold the heaviest clusters.

    A form needs half of the clusters' text for that, another element as much as a section needs to
    replace the one around it. If no line is left without them, all are cleared.
    """
    doubts = {e.number: e for line in lines for e in line.holder.doubts}
    held = dict.fromkeys(doubts, 0.0)
    weights = _clusters(lines) if doubts else np.zeros(0)
    for line, weight in zip(lines, weights.tolist()):
        for e in line.holder.doubts:
            held[e.number] += weight
    whole = weights.sum()
    cleared = {n for n, e in doubts.items() if held[n] >= (MARKED if e.tag == "form" else MOST) * whole}
    if not any(all(e.number in cleared for e in line.holder.doubts) for line in lines):
        return set(doubts)
    return cleared


def _region(lines: list[_Line], weights: np.ndarray, doubted: list[_Line], cleared: set[int]) -> set[int]:
    """Numbers of the elements whose lines are content.

    Every section gets the weight of the lines of the clusters inside it; from the page inwards,
    a section that keeps most of the weight of the one around it is taken, an article whole. Half
    of the weight is enough for an article or main, if the step does not lead out of another one.

    What the steps left beside the region is content as well where an element holds cluster lines,
    more plain text than links and, unless it stands in the same main, enough text per element.
    An element in doubt has to stand inside content, and to have the same by itself.
    """
    inside: dict[int, float] = {}
    marked: dict[int, float] = {}
    plain: dict[int, int] = {}
    linked: dict[int, int] = {}
    children: dict[int, set[int]] = {}
    element: dict[int, _Element] = {}
    for line, weight in zip(lines, weights.tolist()):
        e, below, mark = line.holder, None, 0.0
        while e is not None:
            n = e.number
            if e.tag in _MARKS:
                mark = weight
            element[n] = e
            inside[n] = inside.get(n, 0.0) + weight
            marked[n] = marked.get(n, 0.0) + mark
            plain[n] = plain.get(n, 0) + len(line.text) - line.linked
            linked[n] = linked.get(n, 0) + line.linked
            if below is not None:
                children.setdefault(n, set()).add(below)
            below, e = n, e.parent
    at = 0
    while True:
        heaviest = max(children.get(at, ()), key=lambda n: (inside[n], -n), default=None)
        if heaviest is None or not inside[at]:
            break
        by_mark = not _within(element[at], _MARKS) and marked[heaviest] >= MARKED * inside[at]
        if inside[heaviest] < MOST * inside[at] and not by_mark:
            break
        at = heaviest
        if element[at].tag == "article":
            break
    # Out again to the section that holds it: paragraphs have neighbours.
    while at and element[at].tag not in _SECTIONS:
        at = element[at].parent.number

    def per_element(n: int) -> float:
        return plain[n] / max(element[n].upto - element[n].before, 1)

    path, e = {}, element[at]
    while e is not None:
        path[e.number] = _within(e, ("main",))
        e = e.parent
    enough = BESIDE * per_element(at)
    content: dict[int, bool] = {n: False for n in path} | {at: True}
    for line in lines:
        chain, e = [], line.holder
        while e.number not in content:
            chain.append(e.number)
            e = e.parent
        # Once an element is content, all inside it is.
        known, free = content[e.number], path.get(e.number, _within(e, ("main",)) and path[at])
        for n in reversed(chain):
            known = known or bool(inside[n] and plain[n] > linked[n] and (free or per_element(n) >= enough))
            content[n] = known

    enough = DOUBTED * per_element(at)
    for line in doubted:
        e = line.holder
        while e is not None:
            element.setdefault(e.number, e)
            if e in line.holder.doubts:
                plain[e.number] = plain.get(e.number, 0) + len(line.text) - line.linked
                linked[e.number] = linked.get(e.number, 0) + line.linked
            e = e.parent
    for line in doubted:
        chain, e = [], line.holder
        while e.number not in content:
            chain.append(e)
            e = e.parent
        known = content[e.number]
        for e in reversed(chain):
            if e in e.doubts and e.number not in cleared:
                known = known and plain[e.number] > linked[e.number] and per_element(e.number) >= enough
            content[e.number] = known
    return {n for n, known in content.items() if known}


def main_text(html: str) -> str:
    """The text of a page's content region: its blocks in order, joined by one space."""
    lines = _without_asides(lines_of(html))
    if not lines:
        return ""
    cleared = _cleared(lines)
    sure = [all(e.number in cleared for e in line.holder.doubts) for line in lines]
    certain = [line for line, is_sure in zip(lines, sure) if is_sure]
    doubted = [line for line, is_sure in zip(lines, sure) if not is_sure]
    content = _region(certain, _clusters(certain), doubted, cleared)
    # The title of a page may stand above the section of its text.
    return " ".join(
        line.text
        for line, is_sure in zip(lines, sure)
        if line.holder.number in content or is_sure and line.holder.tag == "h1"
    )


def _within(element: _Element, tags: tuple[str, ...]) -> bool:
    while element is not None:
        if element.tag in tags:
            return True
        element = element.parent
    return False


def extract(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` but html, with text and n_chars (its code points).

    A null, empty or textless page has an empty text. Broken markup is read as far as it goes. A
    page is one row and is read whole; repeated rows repeat. Columns named like the results are
    replaced; an empty table gives an empty result.
    """
    rest = pages.drop("text", "n_chars")
    names = [c for c in rest.columns if c != "html"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(html.as_py() or "") for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                [*names, "text", "n_chars"],
            )

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rest.schema if f.name != "html")
    return rest.select(*names, F.col("html").cast("string").alias("html")).mapInArrow(run, f"{kinds}text string, n_chars bigint")

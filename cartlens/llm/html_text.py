"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's parser is fed piece by piece; its events make lines, one for each block of
the page, with their text and their number of tags. Elements whose name or role says that they are
not the article (menus, footers and so on) are left out with all they contain. On every page the ratios
of text to tags per line, as logarithms and zero for lines that are nothing but links, are smoothed by a
Gaussian; their two clusters give a threshold, and regions of lines above it are the content. Clusters whose
middles differ by less than a factor of APART are one.

What the page says about itself is weighed against the ratios. A class, id or form that marks an element as
an advert, comments and so on is not believed if the element holds most of the content, nor, for words that
are also used for subjects (WEAK), if it holds running text. A part of a line is left out if its class is just such a
word, as that of a share button; another mark on a part of a line counts only if the line has nothing else. Lines of an article are content unless they are below the threshold, nothing but links and
before or after all its text; regions around it are if they are running text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartlens.llm.common import field_type, longs, picked, strings

PIECE = 1 << 18
SIGMA = 1.5
APART = 8.0
GAP = 2  # lines below the threshold between two lines above it that still belong to the region
MOST = 0.5  # share of the content above which the marks of an element are not believed
RUNNING = 80  # characters that a region beside an article has at least

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
# elements that are never part of an article
OUTSIDE = frozenset(
    "aside button canvas datalist dialog fieldset footer head header iframe input map menu nav noscript object "
    "script select style svg template textarea title video audio".split()
)
ROLES = frozenset("alert banner complementary contentinfo dialog menu menubar navigation search".split())
# words of a class or id that mark what is not part of an article, and words before them that say otherwise
MARKS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "consent disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe toolbar widget".split()
)
WEAK = frozenset("header search share sharing social toolbar".split())
UNMARKS = frozenset("has have no non with without".split())
# all that a head may hold; anything else ends it
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# parts of a line, which hold no blocks
PHRASES = frozenset("a abbr b cite code em font i kbd label mark q s samp small span strong sub sup time tt u var".split())
# of these, the ones that are left out of a line, if their class is just a word of MARKS, but not in code
BUTTONS = frozenset("a small span".split())
CODE = frozenset(("code", "kbd", "pre", "samp"))
# these end an open paragraph, as the start of any block does
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = frozenset(("ul", "ol", "dl", "table", "menu", "select", "article", "main", "section", "div", "body", "nav", "aside"))


def is_outside(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    if tag in OUTSIDE:
        return True
    if tag in ARTICLE or tag in ("html", "body"):
        return False
    for name, value in attributes:
        if name == "role" and value and value.strip().lower() in ROLES:
            return True
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
    return False


def is_button(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    return tag in BUTTONS and any(name == "class" and value and MARKS.intersection(value.lower().split()) for name, value in attributes)


def mark_of(tag: str, attributes: list[tuple[str, str | None]]) -> int:
    """0 for an element without a mark, 1 for one with weak words only, 2 for others."""
    if tag in ARTICLE or tag in ("html", "body"):
        return 0
    found = 2 if tag == "form" else 0
    for name, value in attributes:
        if name in ("class", "id") and value:
            for token in value.lower().split():
                words = re.split(r"[^a-z]+", token)
                meant = [w for k, w in enumerate(words) if w in MARKS and not UNMARKS.intersection(words[:k])]
                found = max([found, *(1 if w in WEAK else 2 for w in meant)])
        if name == "role" and value and value.strip().lower() == "form":
            found = 2
    return found


class Line(NamedTuple):
    text: str
    tags: int
    inside: bool  # of an article
    linked: bool  # all of the text is in links
    marks: tuple[int, ...]  # the marked elements around it


class Lines(HTMLParser):
    """Collects lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, bool, bool]] = []  # tag, outside, marked block, marked part of a line
        self.outside = 0
        self.article = 0
        self.marks: tuple[int, ...] = ()
        self.n_marks = 0
        self.weak: set[int] = set()
        self.marked_parts = 0
        self.unmarked = False  # the line has text outside of marked parts
        self.links = 0
        self.parts: list[str] = []
        self.plain = False  # the line has text outside of links
        self.tags = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            marks = self.marks
            if not self.unmarked:  # all of the line is in marked parts
                self.n_marks += 1
                marks += (self.n_marks,)
            self.lines.append(Line(text, max(self.tags, 1), self.article > 0, not self.plain, marks))
            self.tags = 0
        self.parts = []
        self.plain = self.unmarked = False

    def leave(self, keep: int) -> None:
        while len(self.open) > keep:
            tag, outside, marked, part = self.open.pop()
            if tag in BLOCKS or marked:
                self.end_line()
            if marked:
                self.marks = self.marks[:-1]
            self.links -= tag == "a"
            self.marked_parts -= part
            self.outside -= outside
            self.article -= tag in ARTICLE and not outside and not self.outside

    def close_implied(self, tag: str) -> None:
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name == "p" or name in CLOSES.get(tag, ()):
                self.leave(k)
                if name != "p":
                    return
            elif name in LIMITS or (name in BLOCKS and tag not in CLOSES):
                return

    def close_head(self, always: bool) -> None:
        """Ends a head without an end tag; one of its elements that is still open keeps it open, unless the body begins."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == "head" and (always or k == len(self.open) - 1):
                self.leave(k)
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag not in HEAD:
            self.close_head(tag == "body")
        if tag in BLOCKS:
            self.end_line()
            self.close_implied(tag)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        outside = is_outside(tag, attrs) or (is_button(tag, attrs) and not any(entry[0] in CODE for entry in self.open))
        mark = 0 if outside or self.outside else mark_of(tag, attrs)
        part = bool(mark) and tag in PHRASES
        marked = bool(mark) and not part
        if marked:
            self.end_line()
            self.n_marks += 1
            self.marks += (self.n_marks,)
            if mark == 1:
                self.weak.add(self.n_marks)
        self.marked_parts += part
        self.article += tag in ARTICLE and not outside and not self.outside
        self.links += tag == "a"
        self.outside += outside
        self.open.append((tag, outside, marked, part))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.end_line()
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.leave(k)
                return
            # an inline end tag does not close blocks
            if tag not in BLOCKS and self.open[k][0] in BLOCKS and not self.open[k][1]:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self.close_head(False)
        if not self.outside:
            self.parts.append(data)
            self.plain |= not self.links and not data.isspace()
            self.unmarked |= not self.marked_parts and not data.isspace()


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel, "same")[: len(ratios)] if len(ratios) > 2 * reach else None
    if weight is None:
        out = [np.average(ratios, weights=np.exp(-0.5 * ((np.arange(len(ratios)) - k) / sigma) ** 2)) for k in range(len(ratios))]
        return np.array(out)
    return np.convolve(ratios, kernel, "same") / weight


def threshold(values: np.ndarray) -> float:
    """Border between the two clusters of the values (2-means in one dimension)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        middle = (low + high) / 2
        above = values > middle
        if not above.any() or above.all():
            break
        now = float(values[~above].mean()), float(values[above].mean())
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def density(line: Line) -> float:
    """Logarithm of the characters per tag; a line that is nothing but links has none."""
    return 0.0 if line.linked else float(np.log1p(len(line.text) / line.tags))


def dense(lines: list[Line]) -> tuple[list[int], float]:
    """Places of the lines in regions with much text per tag, and the threshold."""
    if not lines:
        return [], 0.0
    values = smoothed(np.array([density(x) for x in lines]))
    border = threshold(values)
    above = values > border
    if above.all() or not above.any() or values[above].mean() - values[~above].mean() < np.log(APART):  # one cluster
        return list(range(len(lines))), 0.0
    good = np.flatnonzero(values >= border)
    kept = set(good.tolist())
    for a, b in zip(good, good[1:]):
        if b - a - 1 <= GAP:
            kept.update(range(int(a), int(b)))
    return sorted(kept), border


def believed(lines: list[Line], weak: set[int]) -> set[int]:
    """Marks of elements that are not content: those that hold no more than a part of the article and of the dense
    text, and weak ones if they hold no running text."""
    marks = {m for x in lines for m in x.marks}
    out: set[int] = set()
    inside = [x for x in lines if x.inside]
    running = Counter(m for x in lines if not x.linked and len(x.text) >= RUNNING for m in x.marks)
    marks = {m for m in marks if not (m in weak and running[m])}
    if not marks:
        return out

    def shares(base: list[Line]) -> dict[int, float]:
        held = dict.fromkeys(marks, 0)
        for x in base:
            for m in marks.intersection(x.marks):
                held[m] += len(x.text)
        return {m: n / (sum(len(x.text) for x in base) or 1) for m, n in held.items()}

    if inside:
        out = {m for m, share in shares(inside).items() if share <= MOST}
    rest = [lines[k] for k in dense(lines)[0] if not out.intersection(lines[k].marks)]
    return out | {m for m, share in shares(rest).items() if share <= MOST}


def content_lines(lines: list[Line], weak: set[int] = frozenset()) -> list[str]:
    """Lines of the regions with much text per tag, in the light of articles and marks."""
    no = believed(lines, weak)
    lines = [x for x in lines if not no.intersection(x.marks)]
    good, border = dense(lines)
    if not any(x.inside for x in lines):
        return [lines[k].text for k in good]
    chosen = set(good)
    text = [k for k, x in enumerate(lines) if x.inside and not x.linked]
    amid = range(text[0], text[-1]) if text else range(0)
    kept = {k for k, x in enumerate(lines) if x.inside and (k in chosen or not x.linked or k in amid)}
    # beside the article: runs of running text, dense by themselves and not by their neighbours only
    for _, run in groupby(enumerate(k for k in good if not lines[k].inside), lambda p: p[1] - p[0]):
        places = [k for _, k in run]
        rich = any(density(lines[k]) >= border for k in places)
        if rich and sum(len(lines[k].text) for k in places) >= RUNNING:
            kept.update(places)
    return [lines[k].text for k in sorted(kept)]


def main_text(html: str) -> str:
    parser = Lines()
    for at in range(0, len(html), PIECE):
        parser.feed(html[at : at + PIECE])
    if re.match("<[a-zA-Z/!?]", parser.rawdata):  # the page ends inside a tag or comment, which is no text
        parser.rawdata = ""
    parser.close()
    parser.leave(0)
    parser.end_line()
    return "\n".join(content_lines(parser.lines, parser.weak))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars.

    A null or empty page, or one without content, has an empty text. Repeated rows are extracted each,
    other columns are left out. Map-only.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in strings(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), longs([len(t) for t in texts])],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {field_type(pages, page_id)}, url {field_type(pages, url)}, text string, n_chars bigint"
    return picked(pages, page_id=page_id, url=url, html=html).mapInArrow(run, schema)

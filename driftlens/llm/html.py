"""Operator 3: main text of web pages by smoothed text-to-tag ratios.

The standard library's parser turns a page into lines: a line ends where a
block element begins or ends. Each line has its text, its number of tags and
its element. A line's ratio is its characters outside links by its tags;
ratios are smoothed with a Gaussian and split in two clusters, and the lines
of the upper one are the content. The content region is the article or main
element with most of them; if they lie in several articles, the innermost
element that holds them all; without article and main, that element or one
around it, as long as the outer one adds only headings and paragraphs.

Inside the region the ratios reject blocks: a run of lines that are links and
nothing else, if its mean smoothed ratio is below the cut, and a block whose
class, id or role names page furniture (adverts, notices, comments) or that is
a form, if its ratios, lowered for that, are below the cut. Other lines of the
region all count, so a short paragraph between long ones is not lost. The name
of an element that holds the first article or main, or without these nearly
the whole text, does not count. Elements that are no main text by their kind
(menus, scripts, footers) have no ratio and are never part of the region.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from driftlens.llm.common import table, values

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: Elements whose text is never main text.
OTHER = frozenset("aside button datalist dialog footer head iframe input menu nav noscript object optgroup option script select style svg template textarea title".split())
#: Words of a class, id or role that name page furniture.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist complementary contentinfo cookie cookies consent "
    "disclaimer footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices overlay pagination paywall popup promo promoted recommended related "
    "search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that may stand beside them in one name ("comment-list", "ad-slot").
BESIDE = frozenset("area bar block body bottom box button buttons card container content footer form header inner item items left link links list main outer page panel post posts reader right section site slot top unit user wrap wrapper".split())
#: Elements that can be the content region; else it is any other block.
REGIONS = frozenset(("article", "main"))
#: Elements that end an open one of the same group (their end tag may be left out).
ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that belong to the text they stand beside.
PLAIN = HEADINGS | {"p"}
SIGMA = 1.0
#: A named block's ratios count this much.
LOWERED = 0.05
#: Without article and main, an element with this share of the text is the page itself, whatever its name.
WHOLE = 0.9
#: So many lines of links in a row are judged by their ratio.
LINKS = 2


class Line(NamedTuple):
    text: str
    tags: int
    element: int  # innermost block element, -1 outside all
    linked: int  # characters in links


@functools.lru_cache(maxsize=4096)
def named_other(name: str) -> bool:
    """Does one name of a class, id or role name page furniture? Each of its
    parts must be such a word or one that stands beside it, so that neither
    ``share-story`` nor ``no-sidebar`` does."""
    parts = set(re.findall(r"[a-z]+", name.lower()))
    return not parts.isdisjoint(OTHER_WORDS) and parts <= OTHER_WORDS | BESIDE


class Lines(HTMLParser):
    """Collects the lines and block elements of a page. Elements are numbered in
    page order, each with its tag, its parent's number, whether it or one
    around it is other by kind, and whether it is named (or a form)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.names: list[str] = []
        self.parents: list[int] = []
        self.other: list[bool] = []
        self.named: list[bool] = []
        self.open: list[int] = []  # open block elements
        self.open_names: Counter[str] = Counter()
        self.parts: list[str] = []
        self.tags = 0
        self.links = 0  # open links
        self.linked = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(Line(text, self.tags, self.open[-1] if self.open else -1, self.linked))
        self.parts, self.tags, self.linked = [], 0, 0

    def pop(self) -> None:
        self.open_names[self.names[self.open.pop()]] -= 1

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.tags += 1
            if tag == "br" or tag == "hr":
                self.parts.append(" ")
                if tag == "hr":
                    self.end_line()
            return
        if tag in INLINE:
            self.tags += 1
            self.links += tag == "a" and not self.links  # links do not nest
            return
        self.end_line()
        self.tags += 1
        ends = ENDS.get(tag, {"p"} if tag != "body" else set())
        while self.open and self.names[self.open[-1]] in ends:
            self.pop()
        around = self.open[-1] if self.open else -1
        other = tag in OTHER or (tag == "header" and not any(self.open_names[r] for r in REGIONS))
        named = tag == "form"
        if attrs and tag not in ("html", "body"):
            named = named or any(named_other(n) for k, v in attrs if v and k in ("class", "id", "role") for n in v.split())
        self.open.append(len(self.names))
        self.open_names[tag] += 1
        self.names.append(tag)
        self.parents.append(around)
        self.other.append(other or (around >= 0 and self.other[around]))
        self.named.append(named)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID or tag in INLINE:
            self.handle_starttag(tag, attrs)
            if tag == "a":
                self.links = 0
        else:
            self.handle_starttag(tag, attrs)
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "a":
            self.links = 0
        if tag in VOID or tag in INLINE or not self.open_names[tag]:
            return
        self.end_line()
        while self.names[self.open[-1]] != tag:
            self.pop()
        self.pop()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.links:
            self.linked += len("".join(data.split()))

    def around(self, element: int) -> Iterator[int]:
        """The element and those around it, inside out."""
        while element >= 0:
            yield element
            element = self.parents[element]

    def sums(self, sizes: dict[int, int]) -> list[int]:
        """Each element's total of sizes given by innermost element."""
        out = [sizes.get(e, 0) for e in range(len(self.names))]
        for e in range(len(out) - 1, 0, -1):  # a child has a larger number
            if self.parents[e] >= 0:
                out[self.parents[e]] += out[e]
        return out

    def outermost(self, which) -> list[int]:
        """For each element the outermost one around it (or itself) that ``which`` holds for, or -1."""
        out: list[int] = []
        for e, parent in enumerate(self.parents):
            above = out[parent] if parent >= 0 else -1
            out.append(above if above >= 0 else e if which(e) else -1)
        return out


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(ratios, kernel / kernel.sum())[reach : reach + len(ratios)]


def threshold(values: np.ndarray) -> float:
    """Where two clusters of the values part (2-means in one dimension)."""
    low, high = float(values.min()), float(values.max())
    cut = (low + high) / 2
    for _ in range(50):
        upper = values >= cut
        if not upper.any() or upper.all():
            break
        new = (float(values[~upper].mean()) + float(values[upper].mean())) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def sized(lines: Iterable[Line]) -> dict[int, int]:
    sizes: dict[int, int] = {}
    for line in lines:
        sizes[line.element] = sizes.get(line.element, 0) + len(line.text)
    return sizes


def blocks(page: Lines, plain: list[int]) -> list[int]:
    """For each element the outermost named block that it is in, or -1. The
    names of elements around the first article or main do not count; without
    these, the names of elements with nearly the whole text do not."""
    mark = next((e for e, n in enumerate(page.names) if n in REGIONS and not page.other[e] and not page.named[e]), -1)
    if mark >= 0:
        void = set(page.around(mark))
    else:
        held = page.sums(sized(page.lines[i] for i in plain))
        total = sum(len(page.lines[i].text) for i in plain)
        void = {e for e, size in enumerate(held) if size >= WHOLE * total}
    return page.outermost(lambda e: page.named[e] and e not in void)


def climb(page: Lines, plain: list[int], region: int) -> int:
    """The outermost element around ``region`` that is reached by adding only
    headings and paragraphs. Each line is looked at once, at the element around
    both it and the region."""
    chain = list(page.around(region))
    place = {e: at for at, e in enumerate(chain)}
    stop = len(chain)
    meets = [-1] * len(page.names)  # element to the place in the chain where it meets it
    for e, parent in enumerate(page.parents):
        meets[e] = place[e] if e in place else meets[parent] if parent >= 0 else stop
    for i in plain:
        e = page.lines[i].element
        at = meets[e] if e >= 0 else stop
        if 0 < at < stop and not (page.names[e] in PLAIN and page.parents[e] == chain[at]):
            stop = at
    return chain[stop - 1] if chain else region


def content_region(page: Lines, plain: list[int], content: list[int]) -> int:
    """The element that holds the main text, -1 for the whole page."""
    lines = page.lines
    held = page.sums(sized(lines[i] for i in content))
    total = sum(len(lines[i].text) for i in content)
    article = page.outermost(lambda e: page.names[e] == "article")
    articles = {article[lines[i].element] for i in content if lines[i].element >= 0} - {-1}
    if len(articles) > 1:
        return max((e for e, size in enumerate(held) if size == total), default=-1)
    regions = [e for e, size in enumerate(held) if size * 2 > total]
    if best := [e for e in regions if page.names[e] in REGIONS]:
        return min(articles & set(best), default=max(best))
    leaf = {lines[i].element for i in content}
    return climb(page, plain, max((e for e in regions if e not in leaf and held[e] == total), default=-1))


def link_runs(page: Lines, kept: list[int]) -> Iterator[list[int]]:
    """Runs of lines that are links and nothing else; headings are none."""
    run: list[int] = []
    for i in kept:
        line = page.lines[i]
        if line.linked >= _solid(line.text) and (line.element < 0 or page.names[line.element] not in HEADINGS):
            run.append(i)
            continue
        if len(run) >= LINKS:
            yield run
        run = []
    if len(run) >= LINKS:
        yield run


def _solid(text: str) -> int:
    return len(text) - text.count(" ")


def main_text(html: str | None) -> str:
    """Main text of a page, a line per block; empty if it has none."""
    page = Lines()
    page.feed(html or "")
    page.close()
    page.end_line()
    lines = page.lines
    open_lines = [i for i, line in enumerate(lines) if line.element < 0 or not page.other[line.element]]
    block = blocks(page, open_lines)
    block_of = {i: block[lines[i].element] for i in open_lines if lines[i].element >= 0 and block[lines[i].element] >= 0}
    plain = [i for i in open_lines if i not in block_of]
    if not plain:
        return ""
    ratios = np.array([(_solid(line.text) - line.linked if line.linked else len(line.text)) / max(1, line.tags) for line in lines])
    in_text = np.zeros(len(lines))
    in_text[plain] = ratios[plain]
    smoothed = smooth(in_text)
    cut = threshold(smoothed[plain])
    region = content_region(page, plain, [i for i in plain if smoothed[i] >= cut])
    within = page.outermost(lambda e: e == region)
    kept = {i for i in open_lines if region < 0 or (lines[i].element >= 0 and within[lines[i].element] >= 0)}
    for run in link_runs(page, sorted(kept - block_of.keys())):
        if smoothed[run].mean() < cut:
            kept.difference_update(run)
    rows: dict[int, list[int]] = {}
    for i in sorted(kept & block_of.keys()):
        rows.setdefault(block_of[i], []).append(i)
    for run in rows.values():
        own = smooth(ratios[run]) / smooth(np.ones(len(run)))
        if LOWERED * np.average(own, weights=[len(lines[i].text) for i in run]) < cut:
            kept.difference_update(run)
    return "\n".join(lines[i].text for i in sorted(kept))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row. Null or empty html has the
    empty text; null ids and URLs are kept; repeated rows are treated alike;
    further columns are left out; an empty table gives none; tags left open or cut
    off end with the page, and neither their number nor their depth matters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in values(batch, 2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

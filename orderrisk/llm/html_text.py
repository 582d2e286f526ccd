"""Main text of web pages from the events of the standard library's streaming parser.

A page is read as lines, one for each block of text. Every line has a ratio of text to tags; the ratios
are smoothed with a Gaussian and split into two clusters. A region (the lines of one container) is content
if a line of it lies in the upper cluster; then it is taken whole, so that short paragraphs stay.

Class words and forms mark what lies beside the article, or a wrapper around it: a mark does not count if it
encloses the main element, the longest article where no other is left, or most of the text that is not links.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Element and attribute names of HTML and words that name parts beside the article.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
_NEVER = frozenset(
    "script style head title noscript template iframe object embed svg math canvas audio video select option "
    "textarea button fieldset nav aside footer menu dialog".split()
)
_BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside widget footer cookie cookies consent gdpr notice notices notification "
    "banner alert popup modal overlay newsletter subscribe subscription paywall signup login share sharing social "
    "related recommended recommendations comment comments commentlist disqus reply replies respond discussion "
    "pagination pager toolbar copyright disclaimer search skip".split()
)
_DISCUSSION = frozenset("comment comments commentlist disqus reply replies respond discussion".split())
_ABOVE = frozenset("header masthead topbar".split())
_BESIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
_CONTAINERS = frozenset("body section div td th article main".split())
_MAIN = frozenset(("article", "main"))
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
_NAMES = re.compile("[a-z0-9]+")

_KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
_KERNEL /= _KERNEL.sum()


class _Lines(HTMLParser):
    """Collects (text, tags, characters in links, region, inside an article, beside the article, marks, article) per line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool, bool, tuple[int, ...], int]] = []
        #: Whether a mark is that of a discussion, the marks around main elements and around each article.
        self.marks: list[bool] = []
        self.around_main: set[int] = set()
        self.around: list[tuple[int, ...]] = [()]
        # (element, beside, region, inside an article, marks, outermost article)
        self._open: list[tuple[str, bool, int, bool, tuple[int, ...], int]] = [("", False, 0, False, (), 0)]
        # How many open elements have each name, and the places of open inline ones whose text is beside the line they stand in.
        self._count: dict[str, int] = {}
        self._muted: list[int] = []
        self._regions = 0
        self._text: list[str] = []
        self._tags = 0
        self._linked = 0

    def _end_line(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            _, beside, region, inside, marks, article = self._open[-1]
            self.lines.append((text, self._tags, min(self._linked, len(text)), region, inside, beside, marks, article))
            self._tags = 0
        self._text, self._linked = [], 0

    def _close_from(self, at: int) -> None:
        for name, *_ in self._open[at:]:
            self._count[name] -= 1
        del self._open[at:]
        while self._muted and self._muted[-1] >= at:
            self._muted.pop()

    def _pop(self, names: tuple[str, ...], within: frozenset[str]) -> None:
        if not any(self._count.get(name) for name in names):
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] in names:
                self._close_from(at)
                return
            if self._open[at][0] in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in ("br", "hr"):
            self._text.append(" ")
        if tag not in _INLINE and tag != "br":
            self._end_line()
            self._pop(_CLOSES.get(tag, ("p",)), _CONTAINERS | {"ul", "ol", "table", "blockquote"})
        if tag in _VOID:
            return
        _, beside, region, inside, marks, article = self._open[-1]
        held = dict(attrs)
        apart = self._is_beside(tag, held, inside)
        names = self._names(tag, held, inside)
        if tag in _INLINE and (apart or names):
            # An advert within a line, for instance; it encloses no article.
            self._muted.append(len(self._open))
            apart, names = True, set()
        beside = beside or tag in _NEVER or apart
        if names or tag == "form":
            marks = (*marks, len(self.marks))
            self.marks.append(not names.isdisjoint(_DISCUSSION))
        if tag == "main" and not beside:
            self.around_main.update(marks)
        if tag == "article" and not article:
            article = len(self.around)
            self.around.append(marks)
        if tag in _CONTAINERS and not inside:
            self._regions += 1
            region = self._regions
        self._count[tag] = self._count.get(tag, 0) + 1
        self._open.append((tag, beside, region, inside or tag in _MAIN, marks, article))

    @staticmethod
    def _is_beside(tag: str, attrs: dict[str, str | None], inside: bool) -> bool:
        if tag == "header" and not inside:
            return True
        if not attrs or tag in ("html", "body", *_MAIN):
            return False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or (attrs.get("role") or "").lower() in _BESIDE_ROLES:
            return True
        return "display:none" in (attrs.get("style") or "").replace(" ", "").lower()

    @staticmethod
    def _names(tag: str, attrs: dict[str, str | None], inside: bool) -> set[str]:
        """Words of class and id that name parts beside the article."""
        if not attrs or tag in ("html", "body", *_MAIN):
            return set()
        names = set(_NAMES.findall(f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower()))
        return names & (_BESIDE if inside else _BESIDE | _ABOVE)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag not in _INLINE:
            self._end_line()
        if not self._count.get(tag):
            return
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at][0] == tag:
                self._close_from(at)
                return
            if tag in _INLINE and self._open[at][0] not in _INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self._muted:
            return
        self._text.append(data)
        if self._count.get("a"):
            self._linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_line()


def _threshold(values: np.ndarray) -> float:
    """Half way between the centres of two clusters of numbers."""
    low, high = values.min(), values.max()
    for _ in range(50):
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all() or not upper.any():
            break
        low, high = values[~upper].mean(), values[upper].mean()
        if (low + high) / 2 == cut:
            break
    return (low + high) / 2


def _wrappers(parser: _Lines) -> set[int]:
    """Marks of elements that are around the article, not beside it."""
    free = set(parser.around_main)
    shown = [(len(text) - linked, inside, marks, article) for text, _, linked, _, inside, beside, marks, article in parser.lines if not beside]
    if any(n and inside and free.issuperset(marks) for n, inside, marks, _ in shown):
        return free
    sizes: dict[int, int] = {}
    for n, _, marks, article in shown:
        # Marks inside the article are beside its text.
        if article and len(marks) == len(parser.around[article]):
            sizes[article] = sizes.get(article, 0) + n
    if any(sizes.values()):
        return free.union(parser.around[max(sizes, key=sizes.__getitem__)])
    under = np.zeros(len(parser.marks), np.int64)
    for n, _, marks, _ in shown:
        under[list(marks)] += n
    total = sum(n for n, *_ in shown)
    return free.union(m for m, n in enumerate(under.tolist()) if 2 * n > total and not parser.marks[m])


def main_text(html: str | None) -> str:
    """The blocks of the page's content regions, joined by one space; empty if there are none."""
    parser = _Lines()
    parser.feed(html or "")
    parser.close()
    if not parser.lines:
        return ""
    free = _wrappers(parser) if parser.marks else set()
    lines = [(*line, beside or not free.issuperset(marks)) for *line, beside, marks, _ in parser.lines]
    ratio = np.array([(len(text) - linked) / max(tags, 1) for text, tags, linked, *_ in lines])
    smooth = np.convolve(np.pad(ratio, 2), _KERNEL, "valid")
    cut = _threshold(smooth)
    peaks: dict[int, float] = {}
    linked: dict[int, list[int]] = {}
    inner: set[int] = set()
    for (text, _, in_links, region, inside, beside), height in zip(lines, smooth, strict=True):
        if beside:
            continue
        peaks[region] = max(peaks.get(region, 0.0), float(height))
        share = linked.setdefault(region, [0, 0])
        share[0] += in_links
        share[1] += len(text)
        if inside:
            inner.add(region)
    able = [r for r in peaks if 2 * linked[r][0] <= linked[r][1]]
    able = [r for r in able if r in inner] or able
    if not able:
        return ""
    kept = {r for r in able if peaks[r] >= cut} or {max(able, key=peaks.__getitem__)}
    return " ".join(text for text, _, _, region, _, beside in lines if region in kept and not beside)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, text and n_chars of each page.

    A null, empty or textless page has the empty text and 0 characters. Repeated rows are extracted each,
    null keys and addresses stay null, an empty table gives no rows and other columns play no part. Pages of any length and
    depth take time in proportion to their length.
    """

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 500):
                some = part.slice(at, 500)
                texts = [main_text(x) for x in some.column(2).to_pylist()]
                columns = [some.column(0), some.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, [key, url, "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in (key, url)}
    schema = f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string, n_chars long"
    return pages.select(key, url, html).mapInArrow(read, schema)

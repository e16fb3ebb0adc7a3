"""Main text of web pages, by the text-to-tag ratio of their lines.

The standard library's parser streams a page as events; block elements cut it into lines. Each line has a ratio, its
text's length by the number of tags since the line before. A Gaussian smooths the ratios along the page, so that a short
paragraph shares in its neighbours' weight, and two clusters of the smoothed ratios give the threshold above which lines are
content. Content lines select a region: the page's articles, or its main element where that holds more outside them than in any, or
else the smallest element that holds most of their text. Only an article inside an article is a comment on it. What the region holds is the main text, except elements that say by their name, class, id or role that they are
something else: navigation, headers and footers of the page, sidebars, notices, adverts, forms, comments. An element that
says so but holds a heading or article and most of the page's text, such as a page-wide form or a wrapper named after its sidebar, is believed only
about what is not in its content. One named after comments is doubted if it holds the page's heading, or is an article of most of
the page's text, or if nothing else is left; a section of an article, known by its id only, that is named after what may be its
subject is part of the article. Names of html, body, main and headings do not count.

Pages are independent: one pass, no shuffle. Defined results: null, empty and text-free pages have an empty text; a
page is never cut; repeated pages give repeated rows; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Container, Iterable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import common

#: Standard deviation of the smoothing, in lines.
SIGMA = 1.5
#: Share of the content lines' text that a region must hold.
REGION = 0.7
#: A line outside an article whose text is links to a larger share is a menu.
LINKS = 0.5

# Element names of HTML.
_SILENT = frozenset("script style title textarea option".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead "
    "tr ul".split()
)
_UNSEEN = frozenset(
    "script style noscript template head title iframe object svg math canvas audio video map nav footer aside form menu dialog "
    "button select option textarea input label datalist search".split()
)
_CLOSED_BY = {
    "li": frozenset(("ul", "ol", "menu", "dir")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",)),
    "tr": frozenset(("table",)), "td": frozenset(("tr", "table")), "th": frozenset(("tr", "table")), "option": frozenset(("select",)),
}
_SCOPES = frozenset("html body article main section div nav footer aside header table td th form blockquote".split())
_REGIONS = frozenset("body main section div center td".split())
_ARTICLES = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())
# Words of class names, ids and roles that mark something other than the article.
_OTHER = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices notification alert popup modal overlay newsletter subscribe subscription signup login paywall sidebar sidebars "
    "widget widgets related recommended recommendations share sharing social breadcrumb breadcrumbs menu menus nav navbar "
    "navigation footer complementary contentinfo dialog search searchbox pagination pager toolbar comment comments commentlist "
    "disqus reply replies discussion respond form skip disclaimer".split()
)
_OUTSIDE = frozenset(("header", "masthead", "topbar"))
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


# Elements whose names say nothing about their text.
_NAMELESS = frozenset("html body main h1 h2 h3 h4 h5 h6 hgroup".split())
# Words of class names that tell a state, as in comments-open, or what an element has, as in with-sidebar.
_STATES = frozenset("open opened closed enabled disabled allowed on off".split())
_WITH = frozenset("has no with without".split())
# Words that may be the subject of a section with this id.
_SUBJECTS = frozenset(
    "discussion respond reply replies notice notices notification alert menu menus navigation dialog search share sharing toolbar "
    "pagination widget widgets form consent cookie cookies subscription sponsor banner disclaimer".split()
)
# Elements of running text. Inside an article their class may name the subject, as in share-price or a list of dishes called menu.
_TEXT = frozenset("p ul ol dl table pre blockquote figure".split())
_SUBJECT_NAMES = frozenset("menu menus".split())
_TOPICS = frozenset("share search form discussion menu menus".split())
# Last words of class names of what is not running text.
_CONTROLS = frozenset(
    "bar box button buttons link links list items item icon icons tools container wrapper wrap inner block area panel this row field "
    "fields input group content body text title label count message".split()
)
_SURE, _DOUBTED, _COMMENT, _SUBJECT = range(4)  # that an element is not the article
_COMMENTS = frozenset("comment comments commentlist disqus reply replies discussion respond".split())


class _Line:
    """A block of text; ``at`` is the innermost element it lies in."""

    __slots__ = ("text", "tags", "links", "at", "hidden")

    def __init__(self, text: str, tags: int, links: int, at: int):
        self.text, self.tags, self.links, self.at, self.hidden = text, tags, links, at, False


class _Element:
    """What an open element hands down to those inside it."""

    __slots__ = ("name", "number", "silent", "linked", "inside", "headed", "depth", "sure")

    def __init__(self, name: str, number: int, silent: bool, linked: bool, inside: bool, headed: bool, depth: int, sure: bool):
        self.name, self.number, self.silent, self.linked = name, number, silent, linked
        self.inside, self.headed, self.depth, self.sure = inside, headed, depth, sure


_ROOT = _Element("", 0, False, False, False, False, 0, False)


class _Page(HTMLParser):
    """Lines of a page and the tree of its elements: an element's number is greater than its parent's, and those inside it have
    the numbers up to its last, so every question about a page is one pass over elements and lines, at any depth."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.articles: set[int] = set()  # elements of articles' text: main, article, and what says that it is one of them
        self.mains: set[int] = set()  # those that are no article, but hold the page's
        self.depth: dict[int, int] = {}  # article elements proper, with how many of these each lies in
        self.stack: list[_Element] = []
        self.open: Counter[str] = Counter()  # names on the stack
        self.names: list[str] = [""]  # by number; 0 is the page
        self.parents: list[int] = [0]
        self.others: dict[int, int] = {}  # elements that say they are not the article, and how sure that is
        self.heads: list[int] = []  # where headings and articles lie
        self.title = 0  # where the page's heading lies
        self.tags = 0
        self.parts: list[str] = []
        self.links = 0

    # lines
    def _cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append(_Line(text, max(1, self.tags), self.links, self.stack[-1].number if self.stack else 0))
            self.tags = 0
        self.parts, self.links = [], 0

    def _close(self, place: int) -> None:
        for element in self.stack[place:]:
            self.open[element.name] -= 1
        del self.stack[place:]

    def _open_at(self, names: frozenset[str] | set[str], stops: frozenset[str]) -> int | None:
        if not any(self.open[name] for name in names):
            return None
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place].name in names:
                return place
            if self.stack[place].name in stops:
                return None
        return None

    # the tree
    def sums(self, entries: Iterable[tuple[int, int]]) -> list[int]:
        """By element, the sum of what lies in it, of (element, amount) entries."""
        found = [0] * len(self.parents)
        for number, amount in entries:
            found[number] += amount
        for number in range(len(found) - 1, 0, -1):
            if self.parents[number]:
                found[self.parents[number]] += found[number]
        return found

    def tops(self, numbers: Container[int]) -> list[int]:
        """By element, the outermost of these elements that it is or lies in; 0 for none."""
        found = [0] * len(self.parents)
        for number in range(1, len(found)):
            found[number] = found[self.parents[number]] or (number if number in numbers else 0)
        return found

    def around(self, number: int) -> set[int]:
        """The element and those it lies in."""
        found = set()
        while number:
            found.add(number)
            number = self.parents[number]
        return found

    def levels(self) -> list[int]:
        found = [-1] * len(self.parents)
        for number in range(1, len(found)):
            found[number] = found[self.parents[number]] + 1
        return found

    # events
    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "td", "th"):
            self.parts.append(" ")
        if tag in _BLOCK:
            self._cut()
            place = self._open_at({"p"}, _SCOPES)
            if place is not None:
                self._close(place)
        if tag in _CLOSED_BY:
            same = {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else {tag}
            place = self._open_at(same, _CLOSED_BY[tag])
            if place is not None:
                self._close(place)
        if tag == "body":  # ends a head that was left open
            self._close(int(bool(self.stack) and self.stack[0].name == "html"))
        self.tags += 1
        if tag in _VOID:
            return
        number, outer = len(self.names), self.stack[-1] if self.stack else _ROOT
        doubt = _other(tag, attrs, outer.inside, outer.headed, outer.depth > 0)
        if doubt is not None:
            self.others[number] = doubt
        silent = outer.silent or tag in _SILENT or (doubt is not None and tag not in _BLOCK)
        is_article, depth = tag in _ARTICLES or _is_article(attrs), outer.depth
        if is_article:
            self.articles.add(number)
            kind = _kind(tag, attrs)
            if kind == "main":
                self.mains.add(number)
            elif kind == "article":
                self.depth[number] = depth
                depth += 1
        if tag == "h1" or is_article:
            self.heads.append(outer.number)
        if tag == "h1" and not self.title and not outer.sure:
            self.title = outer.number
        self.names.append(tag)
        self.parents.append(outer.number)
        self.open[tag] += 1
        self.stack.append(_Element(
            tag, number, silent, outer.linked or tag == "a", outer.inside or is_article,
            outer.headed or (tag in _HEADINGS and tag != "header"), depth, outer.sure or doubt == _SURE,
        ))

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID:
            return
        place = self._open_at({tag}, frozenset(("html",)) if tag in _SCOPES else _SCOPES)
        if tag in _BLOCK:
            self._cut()
        self.tags += 1
        if place is not None:
            self._close(place)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1].silent:
            return
        self.parts.append(data)
        if self.stack and self.stack[-1].linked:
            self.links += len("".join(data.split()))

    def finish(self) -> None:
        self.close()
        self._cut()
        weight = self.sums((line.at, len(line.text)) for line in self.lines)
        links = self.sums((line.at, line.links) for line in self.lines)
        headed = self.sums((number, 1) for number in self.heads)
        whole = sum(len(line.text) for line in self.lines)
        title = self.around(self.title)

        def believed(number: int, doubt: int) -> bool:
            most = 2 * weight[number] > whole
            if doubt != _SURE and self.depth.get(number) == 0 and (most or number in title):
                return False
            if doubt == _DOUBTED:
                return not (most and headed[number])
            if doubt == _COMMENT:
                return number not in title
            return doubt == _SURE or links[number] > LINKS * weight[number]

        others = {number: doubt for number, doubt in self.others.items() if believed(number, doubt)}
        tops = self.tops(others)
        if all(tops[line.at] for line in self.lines):
            others = {number: doubt for number, doubt in others.items() if doubt != _COMMENT}
            tops = self.tops(others)
        for line in self.lines:
            line.hidden = tops[line.at] > 0


def _words(attrs: list[tuple[str, str | None]], names: tuple[str, ...]) -> set[str]:
    found: set[str] = set()
    for name, value in attrs:
        for token in (value or "").split() if name in names else ():
            words = [word.lower() for word in _WORDS.findall(token)]
            if words and words[0] not in _WITH:
                found.update(set(words) - _COMMENTS if _STATES.intersection(words) else words)
    return found


def _compound(attrs: list[tuple[str, str | None]], marks: set[str]) -> bool:
    """Whether each of these words stands in a class name as the first of several, and so describes what the last one names."""
    firsts = set()
    for name, value in attrs:
        for token in (value or "").split() if name == "class" else ():
            words = [word.lower() for word in _WORDS.findall(token)]
            if len(words) > 1 and words[-1] not in _CONTROLS | _OTHER:
                firsts.add(words[0])
    return marks <= firsts


def _other(tag: str, attrs: list[tuple[str, str | None]], inside: bool, headed: bool, in_article: bool) -> int | None:
    """None for what may be part of the article; else how sure it is that it is not. ``inside``: an article or main element,
    ``headed``: a heading, where ids are places to link to."""
    if tag in _UNSEEN or (tag == "header" and not inside):
        return _DOUBTED if tag == "form" else _SURE
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return _SURE
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return _SURE
    if not attrs or tag in _NAMELESS or _kind(tag, attrs) == "main":
        return None
    said = _words(attrs, ("class", "role"))
    found = said if headed else said | _words(attrs, ("id",))
    marks = found & _OTHER
    if in_article and marks and marks <= _SUBJECTS and not said & _OTHER and (tag == "section" or "section" in said):
        return _SUBJECT
    if in_article and tag in _TEXT and marks and (marks <= _SUBJECT_NAMES or (marks <= _TOPICS and _compound(attrs, marks))):
        return _SUBJECT
    if found & _COMMENTS:
        return _COMMENT
    if marks or (not inside and found & _OUTSIDE):
        return _DOUBTED
    return None


def _is_article(attrs: list[tuple[str, str | None]]) -> bool:
    return any(
        (name == "itemprop" and (value or "").lower() == "articlebody") or (name == "role" and value in ("main", "article"))
        for name, value in attrs
    )


def _kind(tag: str, attrs: list[tuple[str, str | None]]) -> str:
    roles = {value for name, value in attrs if name == "role"}
    if tag == "article" or "article" in roles:
        return "article"
    return "main" if tag == "main" or "main" in roles else "body"


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel)[reach : reach + len(ratios)] / weight  # no weight beyond the page's ends


def threshold(values: np.ndarray, rounds: int = 50) -> float:
    """Half way between two clusters' means (on a log scale, found by Lloyd's rounds from the extremes)."""
    logs = np.log1p(values)
    low, high = logs.min(), logs.max()
    for _ in range(rounds):
        upper = logs >= (low + high) / 2
        if upper.all() or not upper.any():
            break
        means = logs[~upper].mean(), logs[upper].mean()
        if means == (low, high):
            break
        low, high = means
    return float(np.expm1((low + high) / 2))


def _regions(page: _Page, seen: list[_Line], chosen: list[_Line], weight: list[int]) -> set[int]:
    """The elements whose text is the page's: its outermost articles, or its main elements."""
    tops = page.tops(page.articles)
    roots = {tops[line.at] for line in chosen} - {0}
    if not roots:
        return set()
    best = max(roots, key=lambda number: (weight[number], -number))
    inside = roots & page.mains if best in page.mains else set()
    within, tops = page.tops(inside), page.tops(page.articles - page.mains)
    found = {tops[line.at] for line in seen if not inside or within[line.at]} - {0}
    if inside:
        held = page.tops(found)
        rest = sum(len(line.text) for line in chosen if within[line.at] and not held[line.at])
        if max((weight[number] for number in found), default=0) < max(rest, 1):
            return inside
    size = page.sums((line.at, len(line.text)) for line in seen)
    links = page.sums((line.at, line.links) for line in seen)
    heaviest = max(found, key=lambda number: (weight[number], -number))
    return {number for number in found if number == heaviest or links[number] <= LINKS * size[number]}


def _comments(page: _Page, seen: list[_Line], chosen: list[_Line], parts: set[int]) -> set[int]:
    """Articles inside an article; but those that hold nearly all of it, or all besides its headings, are its own text.

    A part is judged by its content lines, and one without any by all its lines.

    How deep an article must lie to be a comment is the least depth at which its part keeps a line besides headings: an article
    hides the lines in it at all depths up to its own, so a line's greatest depth says from where on it is the part's own.
    """
    tops, headings = page.tops(parts), page.tops({number for number, name in enumerate(page.names) if name in _HEADINGS})
    held = {tops[line.at] for line in chosen}
    judged = chosen + [line for line in seen if tops[line.at] not in held]
    weight = page.sums((line.at, len(line.text)) for line in judged)
    deepest = [0] * len(page.names)  # depth of the innermost article around that is small enough to be a comment
    for number in range(1, len(deepest)):
        outer = deepest[page.parents[number]]
        small = number in page.depth and tops[number] and weight[number] <= REGION * weight[tops[number]]
        deepest[number] = max(outer, page.depth[number]) if small else outer
    least: dict[int, int] = {}
    for line in judged:
        part = tops[line.at]
        if part and not headings[line.at]:
            least[part] = min(least.get(part, deepest[line.at] + 1), deepest[line.at] + 1)
    return {
        number for number, depth in page.depth.items()
        if tops[number] in least and depth >= least[tops[number]] and weight[number] <= REGION * weight[tops[number]]
    }


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.finish()
    lines = page.lines
    seen = [line for line in lines if not line.hidden]
    if not seen:
        return ""
    ratios = np.array([0.0 if line.hidden else len(line.text) / line.tags for line in lines])
    smooth = smoothed(ratios)
    content = (smooth >= threshold(smooth)) & np.array([not line.hidden for line in lines])
    if not content.any():
        content = np.array([not line.hidden for line in lines])
    chosen = [line for line, is_content in zip(lines, content) if is_content]
    whole = sum(len(line.text) for line in chosen)
    weight = page.sums((line.at, len(line.text)) for line in chosen)
    parts = _regions(page, seen, chosen, weight)
    if parts:
        tops, comments = page.tops(parts), page.tops(_comments(page, seen, chosen, parts))
        taken = [line for line in seen if tops[line.at] and not comments[line.at]]
    else:
        level, held_lines = page.levels(), page.sums((line.at, 1) for line in seen)
        region = [
            number for number in range(1, len(weight))
            if weight[number] >= REGION * whole and weight[number] and page.names[number] in _REGIONS and held_lines[number] > 1
        ]
        best = max(region, key=lambda number: (level[number], -number), default=None)
        held = page.tops({best})
        places = np.flatnonzero(content & np.array([best is None or held[line.at] > 0 for line in lines]))
        low, high = (int(places[0]), int(places[-1])) if len(places) else (0, -1)
        near = 0.25 * smooth[low : high + 1].mean() if len(places) else np.inf
        taken = [
            line for place, line in enumerate(lines)
            if not line.hidden and (best is None or held[line.at]) and line.links <= LINKS * len(line.text)
            and (low <= place <= high or smooth[place] > near)
        ]
    return "\n\n".join(line.text for line in taken)


def with_text(pages: DataFrame, name: str = "text") -> DataFrame:
    """The rows with one more column, the main text of column ``html``."""

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "html"):
            found = [main_text(html) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, name])

    return common.mapped(pages, extract, pages.withColumn(name, F.lit(None).cast("string")).schema)


def report(pages: DataFrame) -> DataFrame:
    found = with_text(pages.select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))

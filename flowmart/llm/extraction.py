"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters."""

from __future__ import annotations

import html.parser
import re

from pyspark.sql import DataFrame, functions as F, types as T

from flowmart.llm.common import small_batches

# Element names of the HTML standard.
SKIPPED = frozenset("script style noscript template head title svg math iframe object canvas select textarea button datalist".split())
FURNITURE = frozenset("nav header footer aside form menu dialog fieldset".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - frozenset("dd dt li td th tr tbody thead tfoot option optgroup body html summary legend figcaption".split())
CONTENT = frozenset(("article", "main"))
# Words of names in class, id or role that stand for furniture of a page.
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments disqus complementary contentinfo consent cookie cookies "
    "copyright dialog footer gdpr masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted related replies "
    "reviews search share sharing sidebar social sponsor sponsored sponsors subscribe subscription tags toolbar widget widgets".split()
)
# Of these, what holds articles of others: such names count around an article, too.
OTHERS = frozenset("comment comments disqus replies reviews related promo promoted sponsor sponsored sponsors ad ads advert adverts advertisement".split())
# Words that make a name speak of a page's layout or state: in front, and at the end.
STATE_FIRST = frozenset("has have with without no is not show hide enable".split())
STATE_LAST = frozenset("on off enabled disabled active inactive open closed visible layout story page template theme".split())
NAME = re.compile("[a-z0-9]+")
#: Radius of the Gaussian in lines, and the part of the ratios' standard deviation that content must reach.
RADIUS, PART = 2, 0.5
#: Ratio that counts at most for that deviation: characters a tag that are prose at any rate, so that one long paragraph does not
#: raise the threshold over ordinary ones.
PROSE = 80


def furniture_name(names: str) -> int:
    """How surely the names of an element's class, id and role mark furniture: 0 not, 1 by a later word of a name, 2 by its first, 3 as others'.

    ``sidebar-left`` starts with what it is; ``content-sidebar-wrap`` may be a page's layout and counts for less. Names of a state or layout
    (``has-sidebar``, ``related-posts-on``) do not count.
    """
    most = 0
    for name in names.split():
        words = NAME.findall(name.lower())
        if not words or words[0] in STATE_FIRST or words[-1] in STATE_LAST or FURNITURE_WORDS.isdisjoint(words):
            continue
        most = max(most, 3 if words[0] in OTHERS or words[-1] in OTHERS else 2 if words[0] in FURNITURE_WORDS else 1)
    return most


#: Whether a line is content's, furniture by names alone that an article may overrule, or furniture.
PLAIN, NAMED, DROPPED = 0, 1, 2


class _Lines(html.parser.HTMLParser):
    """Text lines from parser events: one for each block, with its tag count, and the container that it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int]] = []  # text, tags, furniture, container
        # Open elements: name, skipped or furniture, and, as they were outside: container, how surely names mark furniture.
        self.path: list[tuple[str, int, int, int]] = []
        self.sections = [0]  # for the page and each open element: the container of the sections right in it
        self.text: list[str] = []
        self.tags = self.skips = self.drops = self.named = 0
        self.containers = 0
        self.where, self.depth_of_content, self.articles = 0, 0, 0

    def cut(self) -> None:
        line = " ".join("".join(self.text).split())
        if line:
            self.lines.append((line, self.tags, DROPPED if self.drops or self.named == 3 else NAMED if self.named else PLAIN, self.where))
        if line or self.tags:
            self.tags = 0
        self.text.clear()

    def _leave(self) -> None:
        name, kind, where, named = self.path.pop()
        self.sections.pop()
        if name in BLOCKS:
            self.cut()
        self.skips -= kind == 1
        self.drops -= kind == 2
        self.depth_of_content -= name in CONTENT
        self.articles -= name == "article"
        self.where, self.named = where, named

    def handle_starttag(self, tag, attrs) -> None:
        if tag in CLOSES_P:
            for i in range(len(self.path) - 1, -1, -1):
                if self.path[i][0] == "p":
                    while len(self.path) > i:
                        self._leave()
                    break
                if self.path[i][0] in BLOCKS:
                    break
        elif tag in ("li", "dt", "dd", "td", "th", "tr", "option") and self.path and self.path[-1][0] == tag:
            self._leave()
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCKS:
            self.cut()
        self.tags += 1
        if tag in VOID:
            return
        kind = sure = 0
        if tag in SKIPPED:
            kind = 1
        elif tag in FURNITURE:
            # A header of the article itself holds its heading; the page's does not.
            kind = 0 if tag == "header" and self.depth_of_content else 2
        elif tag not in CONTENT and tag not in ("html", "body"):
            named = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v)
            if any(k == "hidden" for k, _ in attrs):
                kind = 2
            elif named:
                sure = furniture_name(named)
        self.path.append((tag, kind, self.where, self.named))
        siblings = len(self.sections) - 1
        self.sections.append(0)
        # Names of what stands around the main element, and a name's later words around an article, speak of the page's layout.
        self.named = 0 if tag == "main" or tag == "article" and self.named == 1 else max(self.named, sure)
        self.skips += kind == 1
        self.drops += kind == 2
        self.depth_of_content += tag in CONTENT
        if tag == "article":
            self.articles += 1
            if self.articles == 1 and self.depth_of_content > 1:
                return  # the articles of a main element are one container
        if tag == "section" and not self.depth_of_content:
            if not self.sections[siblings]:
                self.containers += 1
                self.sections[siblings] = self.containers
            self.where = self.sections[siblings]
        elif tag in CONTENT or (tag in ("div", "td", "body") and not self.depth_of_content):
            self.containers += 1
            self.where = -self.containers if self.depth_of_content else self.containers

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.path and self.path[-1][0] == tag and tag not in SKIPPED:
            self._leave()

    def handle_endtag(self, tag) -> None:
        self.tags += 1
        for i in range(len(self.path) - 1, -1, -1):
            if self.path[i][0] == tag:
                while len(self.path) > i:
                    self._leave()
                return
            if tag not in BLOCKS and self.path[i][0] in BLOCKS:
                return  # an inline end tag does not close a block

    def handle_data(self, data) -> None:
        if not self.skips:
            self.text.append(data)


def lines_of(page: str | None) -> list[tuple[str, int, int, int]]:
    """(text, tags, furniture, container) of each block line; containers of an article or main element are negative."""
    page = page or ""
    last = page.rfind("<")
    if last >= 0 and re.fullmatch("/?[A-Za-z][^>]*", page[last + 1:]):
        page = page[:last]  # a tag that the page's end cuts off
    parser = _Lines()
    parser.feed(page)
    parser.close()
    while parser.path:
        parser._leave()
    parser.cut()
    return parser.lines


def content_lines(lines: list[tuple[str, int, int, int]]) -> list[int]:
    """The numbers of the lines that are content.

    A line's ratio is its characters over its tags, and nothing for furniture. Ratios are smoothed by a Gaussian; lines
    at or above a part of their standard deviation (ratios over ``PROSE`` count as that) form the content cluster. Sections
    side by side are one container, and so are the articles of one main element. A container that the cluster reaches gives all
    its lines that are not furniture, so that short headings and last lines stay with their article. Where a page has an
    article or main element that is not empty, other containers count only if no content line stands in one. Where names
    alone mark all lines of all articles and main elements as furniture, the names are not believed.
    """
    import numpy as np

    if not lines:
        return []
    marks, where = np.array([x[2] for x in lines]), np.array([x[3] for x in lines])
    plain = marks == PLAIN
    if not (plain & (where < 0)).any():
        plain |= (marks == NAMED) & (where < 0)
    if not plain.any():
        return []
    ratio = np.array([len(x[0]) / max(1, x[1]) if p else 0.0 for x, p in zip(lines, plain)])
    at = np.arange(-2 * RADIUS, 2 * RADIUS + 1)
    kernel = np.exp(-at**2 / (2 * RADIUS**2))
    smooth = np.convolve(np.pad(ratio, 2 * RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")
    content = plain & (smooth >= PART * np.minimum(ratio, PROSE).std())
    if not content.any():
        content = plain
    found = set(where[content].tolist())
    inside = {w for w in found if w < 0}
    found = inside or found
    return np.flatnonzero(plain & np.isin(where, list(found))).tolist()


def main_text(page: str | None) -> str:
    """The main text of one page, its blocks joined by an empty line; empty where there is none."""
    lines = lines_of(page)
    return "\n\n".join(lines[i][0] for i in content_lines(lines))


@F.arrow_udf(T.StringType())
def _main_text(page):
    import pyarrow as pa

    return pa.array([main_text(p) for p in page.to_pylist()], pa.string())


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of the text).

    The text is the article's: menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and reader
    comments are left out, character references decoded, white space in a block made one blank. A null, empty or text-free
    page gives an empty text. Repeated rows give repeated rows; null keys and urls stay; other columns are not read.
    """
    small_batches(pages.sparkSession)
    found = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"), _main_text(F.col(f"`{html}`")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))

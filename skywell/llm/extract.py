"""Main text of web pages by text-to-tag ratio.

The standard library's streaming parser turns a page into lines, one per block, each with its text,
its tags, its link text and the containers it stands in. Lines inside elements that are never
article text (scripts, menus, forms, adverts, comments by name or role) are left out as they stream by. The
other lines get a ratio of text outside links to tags; the ratios are smoothed with a Gaussian and split in two
clusters. The container that holds most text of the upper cluster is the article: all
its lines if it is marked up as one, all but links in another container, and in a bare body those between
the first and last of the cluster with the heading above.
"""

import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame, functions as F

from skywell.llm.common import fresh, mapped, query, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol optgroup option p pre search section select "
    "summary table tbody td template textarea tfoot th thead title tr ul".split()
)
CONTAINER = frozenset("article main section div td body".split())
ARTICLE = frozenset(("article", "main"))
#: Elements whose text is never read.
UNREAD = frozenset(
    "script style head noscript template iframe button select textarea option svg canvas object audio video".split()
)
#: Elements around an article, and those that may also hold one.
AROUND = frozenset("nav aside footer dialog menu search header".split())
SOFT = AROUND | {"form"}
#: Parts of class and id names, and roles, of elements around an article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs "
    "footer sidebar aside widget related recommended share sharing social comment comments disqus respond replies cookie "
    "cookies consent gdpr notice notices banner popup modal overlay newsletter subscribe subscription signup login search pagination "
    "pager skip copyright masthead topbar toolbar".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HEADERS = frozenset(("header",))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A `<p>` ends where one of these begins.
ENDS_P = BLOCK - {"body", "html", "head", "option", "optgroup", "caption", "legend", "td", "th", "tr"}


class Lines(HTMLParser):
    """Lines of a page: `[text, link characters, tags, container, mark, whether a heading]`.

    Containers and marks (elements that by tag, name or role stand around an article) are numbered as they open, each with the one
    it is in, so a line needs one number of each; places of open tags are kept by tag. A page costs its length, however deep.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple] = []  # (tag, whether unread, container or -1, mark or -1)
        self.places: dict[str, list[int]] = {}  # of the open elements of a tag
        self.containers: list[tuple[str, int]] = []  # tag and outer container
        self.marks: list[tuple[str, int, int]] = []  # tag, outer mark, articles and headings before it
        self.mark_ends: dict[int, tuple[int, int]] = {}  # articles and headings before the end of a mark
        self.within, self.marked = [-1], [-1]  # innermost container and mark, with those they are in
        self.lines: list[list] = []
        self.unread = self.links = self.headings = self.articles = 0
        self.seen = (0, 0)  # articles, first headings so far
        self.parts, self.link_chars, self.tags = [], 0, 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.lines.append([text, min(self.link_chars, len(text)), self.tags, self.within[-1], self.marked[-1], self.headings > 0])
        self.parts, self.link_chars, self.tags = [], 0, 0

    def kind(self, tag: str, attrs: list) -> tuple[bool, bool]:
        """Whether an element is not read, and whether it stands around an article."""
        if tag in UNREAD:
            return True, False
        if tag in ("html", "body") or (tag in ARTICLE and not self.articles):
            return False, False
        soft = tag in SOFT and not (tag == "header" and self.articles)
        for name, value in attrs:
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, False
            if not value:
                continue
            if name in ("class", "id") and tag != "header":
                words = set(re.split(r"[^a-z]+", value.lower()))
                soft |= bool(words & NAMES) or (not self.articles and bool(words & HEADERS))
            elif name == "role" and tag != "header":
                soft |= value.lower() in ROLES
            elif name == "style" and HIDDEN.search(value):
                return True, False
        return False, soft

    def close_to(self, at: int) -> None:
        """Close the open elements from position `at` on."""
        for tag, unread, container, mark in self.open[at:]:
            self.places[tag].pop()
            self.unread -= unread
            self.links -= tag == "a"
            self.headings -= tag in HEADINGS
            self.articles -= tag in ARTICLE
            if container >= 0:
                self.within.pop()
            if mark >= 0:
                self.marked.pop()
                self.mark_ends[mark] = self.seen
        del self.open[at:]

    def position(self, tag: str, until) -> int | None:
        """Where the innermost open `tag` is, if none of `until` is open in it."""
        if not self.places.get(tag):
            return None
        at = self.places[tag][-1]
        return None if any(self.places.get(u) and self.places[u][-1] > at for u in until) else at

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.end_line()
            if tag in ENDS_P and (at := self.position("p", CONTAINER)) is not None:
                self.close_to(at)
            if tag == "li" and (at := self.position("li", ("ul", "ol", "menu"))) is not None:
                self.close_to(at)
            if tag in ARTICLE and not self.seen[0] and (self.unread or self.marked[-1] >= 0):
                # the first article ends whatever was left open before it
                self.close_to(next(i for i, x in enumerate(self.open) if x[1] or x[3] >= 0))
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        unread, soft = self.kind(tag, attrs)
        container = mark = -1
        if tag in CONTAINER:
            container = len(self.containers)
            self.containers.append((tag, self.within[-1]))
            self.within.append(container)
        if soft:
            mark = len(self.marks)
            self.marks.append((tag, self.marked[-1], self.seen))
            self.marked.append(mark)
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, unread, container, mark))
        self.unread += unread
        self.links += tag == "a"
        self.headings += tag in HEADINGS
        self.articles += tag in ARTICLE
        self.seen = (self.seen[0] + (tag in ARTICLE), self.seen[1] + (tag == "h1"))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        at = self.position(tag, () if tag in BLOCK else CONTAINER)
        if tag in BLOCK:
            self.end_line()
        if at is not None:
            self.close_to(at)

    def handle_data(self, data):
        if not self.unread:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)

    def around(self) -> list[bool]:
        """For each mark, whether its lines stand around the article.

        They don't where it holds half of the page's text and the article itself: the first article, else the first
        main heading; a page without either is taken to be in it, unless its tag says otherwise.
        """
        held = [0] * len(self.marks)
        for line in self.lines:
            if line[4] >= 0:
                held[line[4]] += len(line[0]) - line[1]
        for i in range(len(held) - 1, -1, -1):
            if self.marks[i][1] >= 0:
                held[self.marks[i][1]] += held[i]
        total = sum(len(x[0]) - x[1] for x in self.lines)
        out = []
        for i, (tag, outer, before) in enumerate(self.marks):
            after = self.mark_ends.get(i, self.seen)
            if self.seen[0]:
                holds = before[0] == 0 < after[0]
            elif self.seen[1]:
                holds = before[1] == 0 < after[1]
            else:
                holds = tag not in AROUND
            out.append(not (holds and 2 * held[i] >= total) or (outer >= 0 and out[outer]))
        return out


def smoothed(x: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian-weighted means; the ends use the weights that exist."""
    reach = int(3 * sigma)
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    over = np.convolve(x, weights)[reach : reach + len(x)]
    return over / np.convolve(np.ones(len(x)), weights)[reach : reach + len(x)]


def threshold(x: np.ndarray) -> float:
    """The middle of the two clusters' means in one dimension, from the ends' middle on."""
    cut = (x.min() + x.max()) / 2
    for _ in range(50):
        low, high = x[x < cut], x[x >= cut]
        if not len(low):
            return x.min()
        new = (low.mean() + high.mean()) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The article's blocks, one a line. Empty for null, empty and textless pages.

    Lines in the upper cluster of the smoothed ratio of text to tags are content. With them go the lines that lie between
    the first and the last of them, or in the same article or innermost container, but for those that are mostly
    links, and headings just before them. Lines of marked elements take no part.
    """
    page = Lines()
    page.feed(html or "")
    page.close()
    page.end_line()
    around = page.around()
    lines = [x for x in page.lines if x[4] < 0 or not around[x[4]]]
    own = np.array([len(x[0]) - x[1] for x in lines], float)
    content = own > 0
    if len(lines) > 4:  # fewer show no clusters
        ratio = smoothed(own / np.array([max(x[2], 1) for x in lines]), sigma)
        content &= ratio >= threshold(ratio)
    if not content.any():
        return ""
    region: list[int] = []  # of each container: the innermost article it is in, else itself; -1 in the body
    for i, (tag, outer) in enumerate(page.containers):
        inside = outer >= 0 and region[outer] >= 0 and page.containers[region[outer]][0] in ARTICLE
        region.append(-1 if tag == "body" else i if tag in ARTICLE or not inside else region[outer])
    places = [region[x[3]] if x[3] >= 0 else -1 for x in lines]
    chosen = {place for place, ok in zip(places, content) if ok and place >= 0}
    first, last = (int(i) for i in np.flatnonzero(content)[[0, -1]])
    while first and lines[first - 1][5]:
        first -= 1
    near = [first <= i <= last or place in chosen for i, place in enumerate(places)]
    return "\n".join(x[0] for x, ok, by in zip(lines, content, near) if ok or (by and x[1] < 0.5 * len(x[0])))


def extract(df: DataFrame, html: str = "html", keep: tuple = ("page_id", "url")) -> DataFrame:
    """Add `text` to `keep`, one row per input row: null and textless pages give an empty text.

    Repeated rows repeat, whole pages are read whatever their length, other columns are not read.
    """
    return mapped(df, html, keep, f"`{fresh('text', keep)}` string", lambda pages: [[main_text(p) for p in pages]])


@query()
def op7_extract(spark, sf_dir):
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))

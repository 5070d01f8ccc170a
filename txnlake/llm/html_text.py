"""Main text of HTML pages.

The standard library's parser streams events; they become lines (one per block
element) that carry their text, their number of tags, the content container
they stand in and whether a menu, header, footer, sidebar, notice, advert,
form or reader comment encloses them. A form or a name of that kind does not
count on an element around the article or most of the page's dense text. The text-to-tag ratio of the lines is
smoothed with a Gaussian, lines above the page's threshold form the content
cluster, and the containers that hold most of the cluster's dense text are the
content region: all their lines that no boilerplate element encloses are kept,
short ones too. Tags and class names decide only among containers that hold
most of it: articles, then named containers, with their siblings that carry
content; without any, the smallest container that holds nearly all, without
article cards that hold little.

Edge cases: a null or empty page has an empty text; unclosed and misnested tags
are closed by the parser's rules below; repeated rows are extracted each; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements by their role in a page.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
SKIPPED = frozenset(
    "script style noscript template head title svg math iframe object canvas audio video map "
    "datalist".split()
)
BOILERPLATE = frozenset(
    "nav footer aside form button select option textarea input fieldset label dialog menu".split()
)
CONTAINERS = frozenset("article main section div td body".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
BOILERPLATE_NAME = re.compile(
    r"(?:^|[\s_-])(ads?|adverts?|advertisement|banner|breadcrumbs?|comments?|cookies?|consent|"
    r"disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|"
    r"pagination|pager|popup|promo|promoted|related|replies|reply|share|sharing|sidebar|social|"
    r"sponsor|sponsored|subscribe|toolbar|widget)(?=$|[\s_-])"
)
# Names that wrappers of a whole page carry too (has-sidebar, with-menu).
LAYOUT_NAME = frozenset(
    "footer header masthead menu nav navbar navigation sidebar toolbar".split()
)
BOILERPLATE_ROLE = frozenset(
    "banner complementary contentinfo navigation search form alert alertdialog dialog menu "
    "menubar toolbar".split()
)
CONTENT_HINT = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|entry|main|post|story)(?=$|[\s_-])")


class Line:
    __slots__ = ("text", "tags", "container", "boiler", "mark")

    def __init__(self, container: int, boiler: bool, mark: int):
        self.text, self.tags = [], 1
        self.container, self.boiler, self.mark = container, boiler, mark


class Open:
    """An open element and what holds inside it."""

    __slots__ = ("tag", "container", "boiler", "mark", "skipped", "in_p", "in_article")

    def __init__(self, tag, container, boiler, mark, skipped, in_p, in_article):
        self.tag, self.container, self.boiler, self.mark = tag, container, boiler, mark
        self.skipped, self.in_p, self.in_article = skipped, in_p, in_article


class LineEvents(HTMLParser):
    """Turns parser events into lines."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.line = Line(0, False, -1)
        self.lines = [self.line]
        # parent, rank of its kind, mark around it, whether its name is boilerplate
        self.containers: list[tuple[int, int, int, bool]] = [(-1, 0, -1, False)]
        # elements that a name or form makes boilerplate unless they hold the
        # content: mark around it, whether its name is that of a page's layout
        self.marks: list[tuple[int, bool]] = []
        self.open = [Open("", 0, False, -1, False, False, False)]

    def updatepos(self, i, j):  # line numbers are not needed
        return j

    def handle_starttag(self, tag, attrs):
        self.line.tags += 1
        block = tag in BLOCKS
        # an open paragraph or list item ends where the next block or item begins
        if block and tag != "br" and self.open[-1].in_p:
            self._close("p")
        if tag == "li" and self.open[-1].tag == "li":
            self._close("li")
        if tag not in VOID:
            self._push(tag, attrs)
        if block:
            self._new_line()

    def _push(self, tag, attrs):
        above = self.open[-1]
        container, boiler, article = above.container, above.boiler, above.in_article
        mark = above.mark
        named = role = ""
        for k, v in attrs:
            if k in ("class", "id"):
                named += " " + (v or "").lower()
            elif k == "role":
                role = (v or "").lower()
            elif k == "hidden" or (k == "aria-hidden" and v == "true"):
                boiler = True
        if not boiler:
            boiler = (
                (tag in BOILERPLATE and tag != "form")
                or (tag == "header" and not article)
                or (role in BOILERPLATE_ROLE and role != "form")
            )
        found = () if named == "" or tag in ("body", "html", "header") else [
            x.group(1) for x in BOILERPLATE_NAME.finditer(named)
        ]
        if not boiler and (found or tag == "form" or role == "form"):
            self.marks.append((mark, LAYOUT_NAME.issuperset(found)))
            mark = len(self.marks) - 1
        if tag in CONTAINERS:
            article = article or tag in ("article", "main")
            kind = 0
            if tag == "main" or role == "main":
                kind = 3
            elif tag == "article" or role == "article":
                kind = 2
            elif named and CONTENT_HINT.search(named):
                kind = 1
            self.containers.append((container, kind, above.mark, bool(found)))
            container = len(self.containers) - 1
            in_p = False  # a paragraph does not reach into a container
        else:
            in_p = above.in_p or tag == "p"
        skipped = above.skipped or tag in SKIPPED
        self.open.append(Open(tag, container, boiler, mark, skipped, in_p, article))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.line.tags += 1
        self._close(tag)
        if tag in BLOCKS:
            self._new_line()

    def _close(self, tag):
        stack = self.open
        for i in range(len(stack) - 1, 0, -1):
            name = stack[i].tag
            if name == tag:
                del stack[i:]
                return
            # an inline end tag does not close the block around it, nor does the
            # end of a paragraph or item close its container
            if name in BLOCKS and (tag not in BLOCKS or (tag in ("p", "li") and name in CONTAINERS)):
                return

    def _new_line(self):
        top, line = self.open[-1], self.line
        if line.text:
            self.line = line = Line(top.container, top.boiler, top.mark)
            self.lines.append(line)
        else:
            line.container, line.boiler, line.mark = top.container, top.boiler, top.mark

    def handle_data(self, data):
        top = self.open[-1]
        if top.skipped:
            return
        if data.isspace():
            if self.line.text:
                self.line.text.append(data)
            return
        line = self.line
        if line.container != top.container or line.boiler != top.boiler or line.mark != top.mark:
            self._new_line()
        self.line.text.append(data)


def smoothed(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing over neighbouring lines, edges mirrored."""
    radius = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    padded = np.pad(ratios, radius, mode="symmetric")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def clusters(ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines of the content cluster, and its dense lines: where a few lines are
    far above the others, the first threshold refuses none, the second does."""
    level = smoothed(ratios)
    mean, std = level.mean(), level.std()
    low = min(mean - std, mean / 2)
    return level >= low, level >= max(low, min(mean, std) - 1e-9 * mean)


def below(parents: list[int], held: list[int], weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of the lines below each container."""
    mass = np.zeros(len(parents))
    for container, weight in zip(held, weights):
        while weight and container >= 0:
            mass[container] += weight
            container = parents[container]
    return mass


def outermost(parents: list[int], chosen: list[bool]) -> list[int]:
    under = [False] * len(parents)  # parents come before their children
    for c, parent in enumerate(parents):
        under[c] = parent >= 0 and (under[parent] or chosen[parent])
    return [c for c, x in enumerate(chosen) if x and not under[c]]


def content_region(parents, kinds, held, sizes, content, dense) -> list[bool]:
    """Which containers lie in the content region, by the lines' text, the
    cluster's and its dense text."""
    mass, dense_mass = below(parents, held, sizes * content), below(parents, held, sizes * dense)
    text = below(parents, held, sizes)
    total = dense_mass[0]
    region, cards = [], set()
    for least in (2, 1):
        tops = outermost(parents, [k >= least and m > 0 for k, m in zip(kinds, text)])
        if sum(dense_mass[tops]) > total / 2:
            best = max(tops, key=lambda c: (dense_mass[c], -c))
            above, much = parents[best], dense_mass[best] / 2
            if above >= 0 and sum(sizes[dense & (np.array(held) == above)]) >= much:
                region = [above]  # as much text stands beside it
            else:
                # its like beside it, and what holds nearly as much anywhere
                region = [best] + [
                    c for c in range(1, len(parents))
                    if (c in tops or parents[c] == above) and (
                        dense_mass[c] >= much
                        or (parents[c] == above and kinds[c] == kinds[best] and text[c] > 0)
                    )
                ]
            break
    else:
        tops = outermost(parents, [k >= 2 and m > 0 for k, m in zip(kinds, text)])
        if sum(dense_mass[tops]) < total / 3:
            cards = {c for c in tops if kinds[c] == 2}
            for c in cards:
                lost = mass[c]
                while c >= 0:
                    mass[c] -= lost
                    c = parents[c]
        # descend while one child holds nearly all of the content
        at = 0
        while True:
            child = max(
                (c for c, parent in enumerate(parents) if parent == at and c not in cards),
                key=lambda c: mass[c], default=None,
            )
            if child is None or mass[child] < 0.9 * mass[at]:
                break
            at = child
        region = [at]
    inside = [False] * len(parents)
    for c, parent in enumerate(parents):
        inside[c] = c not in cards and (c in region or (parent >= 0 and inside[parent]))
    return inside


def marks_that_hold(events: LineEvents, lines) -> list[bool]:
    """For each mark whether the text below it is boilerplate. A mark does not
    count if its element holds main or the largest article (unless more text, or
    half as much for names such as comments, stands outside all marks), nor if a
    form or a layout's name holds most of the cluster's dense text."""
    around = [above for above, _ in events.marks]
    under = [x[3] for x in lines]
    sizes = np.array([len(x[1]) for x in lines], dtype=float)
    sizes *= clusters(np.array([len(x[1]) / x[2] for x in lines]))[1]
    own = below(around, under, sizes)
    total = sizes.sum()
    counts = [True] * len(around)

    def release(mark: int) -> None:
        while mark >= 0:
            counts[mark] = False
            mark = around[mark]

    def covered() -> list[bool]:
        found = []  # marks come before those inside them
        for above, x in zip(around, counts):
            found.append(x or (above >= 0 and found[above]))
        return found

    def free() -> float:
        """Dense text that no mark makes boilerplate."""
        found = covered()
        return sum(w for w, m in zip(sizes, under) if m < 0 or not found[m])

    mass = below([x[0] for x in events.containers], [x[0] for x in lines], sizes)
    best = None
    for c, (_, kind, mark, named) in enumerate(events.containers):
        if kind == 3 and not named:
            release(mark)
        elif kind == 2 and not named and mass[c] and (best is None or mass[c] > mass[best]):
            best = c
    if best is not None:
        at, layouts = events.containers[best][2], []
        while at >= 0:
            layouts.append(events.marks[at][1])
            at = around[at]
        if mass[best] >= (1 if all(layouts) else 2) * free():
            release(events.containers[best][2])
    for m, (_, layout) in enumerate(events.marks):
        if layout and counts[m] and own[m] > total / 2 and own[m] > 2 * free():
            counts[m] = False
    if not free():  # nothing is left: the name is that of the whole
        for m in range(len(around)):
            if own[m] > total / 2:
                counts[m] = False
    return covered()


def main_text(html: str | None) -> str:
    """The content region's lines, joined by one line feed."""
    if not html:
        return ""
    events = LineEvents()
    events.feed(html)
    events.close()
    texts = [" ".join("".join(x.text).split()) for x in events.lines]
    kept = [
        (x.container, text, x.tags, x.mark)
        for x, text in zip(events.lines, texts)
        if text and not x.boiler
    ]
    if any(mark >= 0 for _, _, _, mark in kept):
        marked = marks_that_hold(events, kept)
        kept = [x for x in kept if x[3] < 0 or not marked[x[3]]]
    if not kept:
        return ""
    parents = [x[0] for x in events.containers]
    kinds = [x[1] for x in events.containers]
    held = [x[0] for x in kept]
    sizes = np.array([len(x[1]) for x in kept], dtype=float)
    content, dense = clusters(np.array([len(x[1]) / x[2] for x in kept]))
    inside = content_region(parents, kinds, held, sizes, content, dense)
    return "\n".join(x[1] for x in kept if inside[x[0]])


def main_text_column(html: Column) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p) for p in pages], dtype=object)

    return extract(html)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    return pages.select("page_id", "url", main_text_column(F.col("html")).alias("text"))

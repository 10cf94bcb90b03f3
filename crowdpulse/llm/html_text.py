"""Main text of web pages by the ratio of text to tags, from parser events.

The standard library's parser sends events; text is collected into blocks, which end wherever a
block-level element starts or ends, and white space in a block is one space. A block is a line of
the method: its ratio is the characters of its text outside links per tag since the last block.
Ratios are smoothed by a Gaussian along the page; blocks whose smoothed ratio is above a threshold,
a share of the standard deviation, are the cluster of content.

The cluster selects the region: the innermost container that holds nearly all of its text, though
nothing within an article. In an article or main element the whole region is content, since a
heading or a short closing line has a low ratio but belongs to the text all the same. In any other
container it is what lies from the first to the last block of the cluster, with a heading right
before it, without blocks that are mostly links.

Never content, whatever their ratio: scripts, styles, templates, forms, navigation, asides, headers
outside an article, footers, and elements whose role is one of these.

Elements whose class or id names an advert, menu, sidebar, notice or comment are decided after the
clustering. One goes unless it holds most of the high-ratio text around it (nearly all where the name
stands alone) and no article stands beside it: 'no-sidebar' may be a wrapper. Ordinary words within a
longer name ('side-effects', 'text-widget') only take away blocks of a low ratio. Where nothing of a
high ratio would be left, names decide nothing.

Null and empty pages give an empty text, unclosed and misnested elements end with the page, and a
page's rows are independent, so repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from crowdpulse.llm.tables import text_of

BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre "
    "section select summary table tbody td template textarea tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav aside footer form button select textarea option iframe object svg "
    "canvas dialog menu input label audio video map math".split()
)
#: Headers are page headers unless they stand in an article.
HEADERS = frozenset(("header", "hgroup"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that one of these ends if it is still open, up to an enclosing container.
CLOSES = {
    "p": frozenset(("p",)),
    "li": frozenset(("li", "p")),
    "dt": frozenset(("dt", "dd", "p")),
    "dd": frozenset(("dt", "dd", "p")),
    "tr": frozenset(("tr", "td", "th", "p")),
    "td": frozenset(("td", "th", "p")),
    "th": frozenset(("td", "th", "p")),
}
INLINE = frozenset("a abbr b bdi bdo big cite code del em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|nav|navbar|"
    r"navigation|menus?|breadcrumbs?|sidebars?|side|footers?|cookies?|consent|gdpr|notices?|notifications?|alerts?|popups?|"
    r"modals?|overlay|newsletters?|subscribe|subscription|signup|login|comments?|commentlist|disqus|replies|respond|"
    r"related|recommended|share|sharing|social|widgets?|pagination|pager|toolbar|masthead|topbar|skip|hidden)(?=$|[\s_-])"
)
#: Names that mean little as a part of longer ones.
ORDINARY = frozenset("side notice notices alert alerts subscription login signup related share sharing social widget widgets skip hidden overlay".split())
#: Names of reader comments, and words that make a name say something about the page instead.
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
ABOUT = frozenset("with has no without allow open closed hide".split())
#: Elements of other languages: these do end with a slash.
FOREIGN = frozenset(("svg", "math"))
#: Elements that can be a content region.
CONTAINERS = frozenset("html body article main section div table tbody tr td center fieldset blockquote dl ol ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Width of the Gaussian in blocks, threshold in standard deviations, text of the cluster a region holds.
SIGMA, SHARE, REGION = 1.5, 0.5, 0.9
#: Blocks of a list of links.
LINKS = 3


class Block(NamedTuple):
    text: str
    linked: int  # characters in links
    tags: int  # since the last block
    inner: int  # the innermost container around it, -1 for none
    heading: bool
    named: tuple[int, ...] = ()  # elements around it whose names speak against it, from the outermost


class Named(NamedTuple):
    ordinary: bool  # only ordinary words, within longer names
    alone: bool  # a name that is not part of a longer one
    comments: bool  # reader comments
    article: int  # the innermost article around it, -1 for none
    depth: int  # articles around it


BLANKS = re.compile(r"\s+")


def names_in(values: dict[str, str]) -> tuple[bool, bool, bool] | None:
    """Whether names in class and id are ordinary words only, one stands alone, one means comments; None: no names."""
    found = []
    for token in " ".join(values.get(k, "") for k in ("class", "id")).split():
        parts = [p for p in re.split("[_-]", token) if p]
        hits = [p for p in parts if NAMED.fullmatch(p)]
        if hits:
            alone = len(hits) == len(parts)
            comments = bool(COMMENTS & {parts[0], parts[-1]}) and not ABOUT.intersection(parts)
            found.append((not alone and ORDINARY.issuperset(hits), alone, comments))
    return (all(o for o, *_ in found), any(a for _, a, _ in found), any(c for *_, c in found)) if found else None


class Events(HTMLParser):
    """Collects the blocks of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, bool, bool]] = []  # name, dropped, main, named
        self.named: list[Named] = []
        self.within: list[int] = []  # open named elements
        self.path: list[int] = []  # open containers
        self.counts: Counter = Counter()  # open elements by name
        # Of containers, in order: the one around it, whether it is an article, the innermost article and
        # the number of articles up to it, its first block and the one after its last.
        self.parent: list[int] = []
        self.is_article: list[bool] = []
        self.article: list[int] = []
        self.depth: list[int] = []
        self.first: list[int] = []
        self.end: list[int] = []
        self.dropped = self.main = self.links = self.tags = self.linked = self.heading = 0
        self.text: list[str] = []

    def flush(self) -> None:
        text = BLANKS.sub(" ", "".join(self.text)).strip()
        if text:
            inner = self.path[-1] if self.path else -1
            self.blocks.append(Block(text, self.linked, self.tags, inner, self.heading > 0, tuple(self.within)))
            self.tags = 0
        self.linked = 0
        self.text.clear()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES and any(self.counts[name] for name in CLOSES[tag]):
            ends, within = CLOSES[tag], len(self.open)
            while within and (self.open[within - 1][0] in ends or self.open[within - 1][0] in INLINE):
                within -= 1
            if any(name in ends for name, *_ in self.open[within:]):
                while len(self.open) > within:
                    self.pop()
        if tag in BLOCKS:
            self.flush()
        self.tags += 1
        if tag in VOID:
            return
        values = {k: (v or "").lower() for k, v in attrs}
        article = tag in ("article", "main") or values.get("role") in ("main", "article")
        dropped = (
            tag in DROPPED
            or tag in HEADERS
            and not self.main
            or values.get("role") in ROLES
            or "hidden" in values
            or values.get("aria-hidden") == "true"
        )
        named = None if dropped or tag in ("html", "body", "article", "main") else names_in(values)
        if named and tag not in BLOCKS:
            dropped = not named[0]  # inline elements are no blocks of their own
            named = None
        # An article within comments or an aside is not the page's.
        article = article and not dropped and not self.dropped
        self.open.append((tag, dropped, article, bool(named)))
        if named:
            self.within.append(len(self.named))
            inner = self.path[-1] if self.path else -1
            self.named.append(Named(*named, *((self.article[inner], self.depth[inner]) if self.path else (-1, 0))))
        self.dropped += dropped
        self.main += article
        self.links += tag == "a"
        self.heading += tag in HEADINGS
        self.counts[tag] += 1
        if tag in CONTAINERS:
            inner, own = self.path[-1] if self.path else -1, len(self.parent)
            self.parent.append(inner)
            self.is_article.append(article)
            self.article.append(own if article else self.article[inner] if self.path else -1)
            self.depth.append((self.depth[inner] if self.path else 0) + article)
            self.first.append(len(self.blocks))
            self.end.append(1 << 60)
            self.path.append(own)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash before the end means nothing on elements that can hold text.
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN:
            self.pop()

    def pop(self) -> None:
        name, dropped, article, named = self.open[-1]
        if name in BLOCKS:
            self.flush()
        self.open.pop()
        self.counts[name] -= 1
        if named:
            self.within.pop()
        self.dropped -= dropped
        self.main -= article
        self.links -= name == "a"
        self.heading -= name in HEADINGS
        if name in CONTAINERS:
            self.end[self.path.pop()] = len(self.blocks)

    def holds(self, container: int, block: int) -> bool:
        return self.first[container] <= block < self.end[container]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        if not self.counts[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                while len(self.open) > k:
                    self.pop()
                return
            if tag in INLINE and self.open[k][0] in BLOCKS:
                return  # an inline end tag closes nothing outside its block

    def handle_data(self, data: str) -> None:
        if not self.dropped:
            self.text.append(data)
            self.linked += len(data) if self.links else 0


def smooth(values: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(3 * sigma + 0.5)
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel, "full")[reach : reach + len(values)]
    return np.convolve(values, kernel, "full")[reach : reach + len(values)] / weight


def cluster(blocks: list[Block], sigma: float, share: float) -> np.ndarray:
    """Which blocks have a high smoothed ratio of text to tags."""
    own = np.array([len(b.text) - b.linked for b in blocks], float)
    smoothed = smooth(own / np.array([1 + b.tags for b in blocks]), sigma)
    links = np.array([2 * b.linked > len(b.text) for b in blocks])
    return (smoothed >= share * smoothed.std()) & (smoothed > 0) & ~links


def region(page: Events, high: np.ndarray) -> int | None:
    """The innermost container with nearly all text of the cluster, an article at most; None: the page."""
    sizes = [0] * len(page.parent)
    for b, h in zip(page.blocks, high):
        if h and b.inner >= 0:
            sizes[b.inner] += len(b.text)
    for k in range(len(sizes) - 1, -1, -1):  # containers open in order, so what they hold comes after them
        if page.parent[k] >= 0:
            sizes[page.parent[k]] += sizes[k]
    need = REGION * sum(len(b.text) for b, h in zip(page.blocks, high) if h)
    holders = [k for k, n in enumerate(sizes) if n and n >= need]  # these are nested
    for k in holders:
        if page.is_article[k]:
            return k
    return holders[-1] if holders else None


def unnamed(blocks: list[Block], high: np.ndarray, page: Events) -> list[Block]:
    """The blocks that names leave."""
    size = [len(b.text) - b.linked if h else 0 for b, h in zip(blocks, high)]
    members: dict[int, list[int]] = {}
    for k, b in enumerate(blocks):
        for e in b.named:
            members.setdefault(e, []).append(k)
    kept = {e for e in members if page.named[e].ordinary}
    for e in sorted(members):  # from the outermost
        if e in kept:
            continue
        about, own = page.named[e], set(members[e])
        near = [k for k in range(len(blocks)) if size[k] and (about.article < 0 or page.holds(about.article, k))]
        within = [k for k in own if blocks[k].inner >= 0 and page.depth[blocks[k].inner] > about.depth]
        if about.comments and not within and any(k not in own and kept.issuperset(blocks[k].named) for k in near):
            continue  # comments beside the text they are about, however long
        beside = any(
            k not in own and kept.issuperset(blocks[k].named)
            and blocks[k].inner >= 0 and page.depth[blocks[k].inner] > about.depth
            for k in near
        )
        need = (REGION if about.alone else 0.5) * sum(size[k] for k in near)
        if not beside and sum(size[k] for k in own) > need:
            kept.add(e)
    left = [k for k, b in enumerate(blocks) if kept.issuperset(b.named)]
    if not any(size[k] for k in left):
        return blocks
    return [blocks[k] for k in left if high[k] or not any(page.named[e].ordinary for e in blocks[k].named)]


def without_link_lists(blocks: list[Block]) -> list[Block]:
    """An article's blocks but for lists of links: LINKS or more in a row that are mostly link."""
    out: list[Block] = []
    row: list[Block] = []
    for b in [*blocks, None]:
        if b and not b.heading and 2 * b.linked > len(b.text):
            row.append(b)
            continue
        out += row if len(row) < LINKS else []
        row = []
        out += [b] if b else []
    return out


def extract(html: str | None, sigma: float = SIGMA, share: float = SHARE) -> str:
    page = Events()
    page.feed(html or "")
    page.close()
    while page.open:
        page.pop()
    page.flush()
    if not page.blocks:
        return ""
    chosen = range(len(page.blocks))
    if page.named:
        left = unnamed(page.blocks, cluster(page.blocks, sigma, share), page)
        kept = {id(b) for b in left}
        chosen = [k for k, b in enumerate(page.blocks) if id(b) in kept]
    blocks = [page.blocks[k] for k in chosen]
    high = cluster(blocks, sigma, share)
    if not high.any():
        high[:] = True
    whole = np.zeros(len(page.blocks), bool)
    whole[np.array(chosen, int)] = high
    place = region(page, whole)
    inside = [place is None or page.holds(place, k) for k in chosen]
    if place is not None and page.is_article[place]:
        return "\n".join(b.text for b in without_link_lists([b for b, i in zip(blocks, inside) if i]))
    core = np.flatnonzero(high & inside)
    first, last = core[0], core[-1]
    while first and blocks[first - 1].heading and inside[first - 1]:
        first -= 1
    picked = [b for b, i in zip(blocks[first : last + 1], inside[first : last + 1]) if i]
    return "\n".join(b.text for b in picked if 2 * b.linked <= len(b.text))


def main_text(html: Column) -> Column:
    @arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([extract(p.as_py()) for p in pages], pa.string())

    return run(html)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select("page_id", "url", main_text(text_of("html")).alias("text"))
    return rows.withColumn("n_chars", F.length("text").cast("long"))

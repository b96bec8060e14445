"""Main text of web pages.

The standard library's parser streams the events of a page, which are cut into lines, one
per block of text. A line's ratio is its text outside links over its tags, 0 in elements
that are not content by their tag, role or class. The ratios are smoothed by a
Gaussian and cut at their standard deviation. The upper cluster decides three things: the element that holds nearly
all of its text, and what little else stands beside it or in the same article, is the content region; where
most of it stands in articles, so does the content; and an element whose class or id may mean a notice or just a
topic is content where its lines are in the upper cluster and not mostly links. All other lines of the region are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SIGMA = 1.0
NEARLY_ALL = 0.9     # of the upper cluster's text that a region holds
BESIDE = 0.25        # text that a wider element may add to the region, by the region's
MOSTLY_LINKS = 0.5   # share of link text above which a line outside an article is left out

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
    optgroup option p pre section summary table tbody td tfoot th thead title tr ul""".split())
CONTAINERS = frozenset("article body center div html main section table td".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_CONTENT = frozenset("""aside button canvas datalist dialog fieldset footer form head iframe input menu
    meter nav noscript object optgroup option progress script select style svg template textarea title""".split())
NOT_CONTENT_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation
    search toolbar""".split())
# A class or id is judged token by token, by its words. A token of words of these kinds alone, with one of the first, means that an
# element is not content; with one of the second, that it may not be. Fixed values, as is common on web pages.
CERTAIN = frozenset("""ad ads adsense adslot advert advertisement advertisements adverts breadcrumb breadcrumbs comment
    commentlist comments commenting consent cookie cookies disqus footer gdpr login modal navbar newsletter overlay pager
    pagination paywall popup promo respond share sharing signup skip sponsored subscribe tagcloud toolbar topbar
    widget widgets""".split())
POSSIBLE = frozenset("""advertising disclaimer discussion navigation notice notices notification promotion promotions related
    recommended recommendations replies reply response responses social sponsor subscription""".split())
SOFT = frozenset("banner header masthead menu nav sidebar side topnav".split())     # certain outside articles only
BESIDE_THEM = frozenset("""area article articles bar block body bottom box button buttons center column content entry form global
    icons inner item items layout left line link links list main media more outer page panel post posts row section site slot
    story text top right title wrapper wrap container""".split())
CONTENT_WORDS = frozenset("article body content entry main page post story text wrapper container layout".split())
# A start tag ends these open elements, up to the nearest element that may hold them.
ENDS = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
        "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
        "option": ("option", ("select", "datalist"))}
ENDS = {tag: (frozenset(ends.split()), frozenset(within)) for tag, (ends, within) in ENDS.items()}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Line:
    text: str
    linked: int       # characters inside links
    tags: int
    container: int
    content: bool
    article: int      # 2 inside an article, 1 inside the main element alone
    doubtful: bool    # in an element that may not be content


def standing(class_: str, id_: str, article: int) -> int:
    """2 if an element of this class and id is content, 1 if it may be, 0 if not. Inside an article ids come from
    titles, so they are no certain sign there."""
    least = 2
    for named, certain in ((class_, True), (id_, not article)):
        for token in named.split():
            words = {w.lower() for w in _WORDS.findall(token)}
            alone = all(w in CERTAIN or w in POSSIBLE or w in SOFT or w in BESIDE_THEM or w.isdigit() for w in words)
            soft = words & SOFT and not words & CONTENT_WORDS and not article
            if alone and (words & CERTAIN or soft):
                least = min(least, 0 if certain else 1)
            elif alone and words & POSSIBLE or not article and (words & (CERTAIN | POSSIBLE) or soft):
                least = min(least, 1)
    return least


class _Lines(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents = [-1]            # of containers; 0 is the page
        self.articles = [False]        # whether a container is an article
        # tag, content, article, container, link, doubtful
        self.open: list[tuple[str, bool, int, int, bool, bool]] = []
        self.state = (True, 0, 0, False, False)
        self.parts: list[str] = []
        self.linked = self.tags = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                content, article, container, _, doubtful = self.state
                self.lines.append(Line(text, self.linked, self.tags, container, content, article, doubtful))
                self.tags = 0
            self.parts, self.linked = [], 0

    def pop(self, at: int) -> None:
        if any(tag in BLOCKS or not content for tag, content, *_ in self.open[at:]):
            self.flush()
        del self.open[at:]
        self.state = self.open[-1][1:] if self.open else (True, 0, 0, False, False)

    def standing(self, tag: str, attrs, article: int) -> int:
        if tag in NOT_CONTENT or tag == "header" and not article:
            return 0
        if not attrs:
            return 2
        named = dict(attrs)
        if "hidden" in named or _HIDDEN.search(named.get("style") or "") or named.get("aria-hidden") == "true":
            return 0
        if (named.get("role") or "").lower() in NOT_CONTENT_ROLES:
            return 0
        if tag in ("html", "body", "main"):
            return 2
        return standing(named.get("class") or "", named.get("id") or "", article or 2 * (tag == "article"))

    def handle_starttag(self, tag, attrs) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            for at in range(len(self.open) - 1, -1, -1):    # a block ends an open paragraph
                if self.open[at][0] == "p":
                    self.pop(at)
                    break
                if self.open[at][0] in CONTAINERS:
                    break
            ends, within = ENDS.get(tag, (frozenset(), frozenset()))
            for at in range(len(self.open) - 1, -1, -1) if ends else ():
                if self.open[at][0] in within:
                    break
                if self.open[at][0] in ends:
                    self.pop(at)
                    break
        if tag in VOID:
            return
        content, article, container, link, doubtful = self.state
        inside = 2 if tag == "article" else max(article, tag == "main" or ("role", "main") in attrs)
        found = self.standing(tag, attrs, article)
        if content and not found or found == 1 and not doubtful and tag not in BLOCKS:
            self.flush()
        if tag in CONTAINERS:
            self.parents.append(container)
            self.articles.append(tag == "article")
            container = len(self.parents) - 1
        self.state = (content and found > 0, inside, container, link or tag == "a", doubtful or found == 1)
        self.open.append((tag, *self.state))

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self.pop(len(self.open) - 1)

    def handle_endtag(self, tag) -> None:
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.pop(at)
                return
            if tag not in CONTAINERS and tag not in NOT_CONTENT and self.open[at][0] in CONTAINERS:
                return     # a stray end tag does not leave its container
        if tag in BLOCKS:
            self.flush()

    def handle_data(self, data) -> None:
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        self.parts.append(data)
        if self.state[3]:
            self.linked += len(data.strip())


def page_lines(html: str) -> tuple[list[Line], list[int], list[bool]]:
    """The lines of a page, each container's parent, and whether it is an article."""
    last = html.rfind("<")
    if last > html.rfind(">") and (html[last + 1:last + 2].isalpha() or html[last + 1:last + 2] in ("", "/", "!", "?")):
        html = html[:last]      # a tag cut off by the end of the page
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines, parser.parents, parser.articles


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma * sigma))
    return np.convolve(np.pad(ratio, reach), kernel / kernel.sum(), "valid")


def main_text(html: str | None) -> str:
    """The content lines of a page, joined by line ends."""
    lines, parents, articles = page_lines(html or "")
    if not any(line.content for line in lines):
        return ""
    size = np.array([len(x.text) for x in lines], "f8")
    content = np.array([x.content for x in lines])
    ratio = np.array([max(len(x.text) - x.linked, 0) / max(1, x.tags) if x.content else 0.0 for x in lines])
    few_links = np.array([x.linked <= MOSTLY_LINKS * len(x.text) for x in lines])
    in_article = np.array([x.article == 2 for x in lines])
    smooth = smoothed(ratio)
    upper = content & (ratio > 0) & (smooth >= smooth.std())
    content &= ~np.array([x.doubtful for x in lines]) | upper & few_links
    upper &= content
    if not upper.any():
        upper = content
    held, all_text = np.zeros(len(parents)), np.zeros(len(parents))
    for x, u, c, n in zip(lines, upper, content, size):
        held[x.container] += n * u
        all_text[x.container] += n * c
    for k in range(len(parents) - 1, 0, -1):
        held[parents[k]] += held[k]
        all_text[parents[k]] += all_text[k]
    region = max(k for k in range(len(parents)) if held[k] >= NEARLY_ALL * held[0])   # the innermost, as they nest
    around, k = None, region
    while k >= 0:
        around, k = (k if articles[k] else around), parents[k]
    if around is not None:
        region = around           # the whole of its outermost article
    elif (size * (upper & in_article)).sum() >= held[0] / 2:
        content &= in_article     # most of it stands in articles, more than one
        region = 0
    else:
        while region and all_text[parents[region]] <= (1 + BESIDE) * all_text[region]:
            region = parents[region]
    inside = np.zeros(len(parents), bool)
    inside[region] = True
    for k in range(region + 1, len(parents)):
        inside[k] = inside[parents[k]]
    return "\n".join(x.text for x, c, few in zip(lines, content, few_links) if c and inside[x.container] and (x.article or few))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of `pages`.

    Null or empty html, and pages without content, give an empty text. Broken markup is
    read as far as the parser makes sense of it. Pages are read whole. Repeated rows are rows like
    others; ids and urls may be null. An empty table gives no rows. Other columns are not read.
    """
    def run(batches):
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")

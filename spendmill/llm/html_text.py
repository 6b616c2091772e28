"""Main text of web pages: parser events, text-to-tag ratio, Gaussian smoothing and threshold clustering.

The standard-library parser streams a page into lines, one per block of text. Lines inside menus, forms, notices and the
like are dropped at once. Every other line has a ratio of text characters to tags; the smoothed ratios that reach the
threshold form clusters. Clustered text counts for its container and all containers around that one; the smallest that
holds nearly all of it is the article, an `article` or `main` before others. All lines in that container and in those
inside it belong to the article, short ones as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr br".split()
)
DROPPED = frozenset(
    "script style noscript template head title nav footer aside form button select textarea option dialog menu svg math"
    " iframe object embed canvas audio video map".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words in a class or id that mark what is not the article.
DROPPED_NAMES = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|adsense|banner|sponsor(?:ed)?|promo(?:tion)?s?|sidebars?|nav(?:bar"
    r"|igation)?|menus?|breadcrumbs?|footer|comments?|disqus|notices?|cookies?|gdpr|popup|newsletter|signup|toolbar|pagination"
    r"|pager|skip(?:-?link)?|masthead|site-?header|page-?header|hidden)(?:$|[^a-z])"
)
# Words that articles use for their own parts as well. Inside an article they are a doubt, and what the block holds decides.
DOUBTFUL_NAMES = re.compile(
    r"(?:^|[^a-z])(?:replies|reply|discussion|respond|consent|modal|overlay|subscribe|login|share|sharing|social|related|recommended"
    r"|widgets?|copyright|disclaimer)(?:$|[^a-z])"
)
# Elements that hold the text itself: inside an article no doubtful name takes one away.
TEXT_ELEMENTS = frozenset(
    "h1 h2 h3 h4 h5 h6 p pre blockquote table caption thead tbody tfoot tr td th li dl dt dd figure figcaption code".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LEAST_DOUBTFUL = 60  # code points that a doubtful block needs to be part of the article
CONTAINERS = frozenset("article main body section div td table center blockquote".split())
# Elements that a new one of these closes.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 header hgroup hr main menu nav ol p pre section search table ul".split()
)
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",)}
SIGMA = 1.0
NEARLY = 0.9


KEPT, DOUBTFUL, GONE = range(3)


def _verdict(tag: str, attrs: list[tuple[str, str | None]], in_article: bool, in_main: bool) -> int:
    """Whether an element is left out by its tag and attributes; `in_main` is inside an `article` or `main`."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return GONE
    if tag in ("html", "body", "main", "article"):
        return KEPT
    verdict = KEPT
    for name, value in attrs:
        if name == "hidden":
            return GONE
        if not value:
            continue
        low = value.lower()
        # The id of a heading is made of its own words.
        if name == "class" or (name == "id" and not (in_main and tag in HEADINGS)):
            if DROPPED_NAMES.search(low):
                return GONE
            if DOUBTFUL_NAMES.search(low):
                if not in_main:
                    return GONE
                if tag not in TEXT_ELEMENTS:
                    verdict = DOUBTFUL
        if name == "role" and low in DROPPED_ROLES:
            return GONE
        if name == "aria-hidden" and low == "true":
            return GONE
        if name == "style" and "display:none" in low.replace(" ", ""):
            return GONE
    return verdict


class PageLines(HTMLParser):
    """Lines of a page in order: text, number of tags in it, and the container it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Tag, dropped (also by an ancestor), container, and the doubtful block it stands in (0: none).
        self.stack: list[tuple[str, bool, int, int]] = []
        self.found: list[tuple[str, int, int, int]] = []
        self.doubts: list[list[int]] = [[0, 0]]  # code points of each doubtful block, and those of its links
        self.containers: list[tuple[str, int]] = [("", 0)]  # tag and the container around it
        self.titled: set[int] = set()  # containers that hold a line of a first-level heading
        self.text: list[str] = []
        self.tags = 0
        self.article = 0
        self.heading = 0
        self.open: Counter[str] = Counter()  # open elements by tag, so that a stray end tag is not searched for

    def parse_html_declaration(self, i: int) -> int:
        """A declaration or marked section that the parser gives up on is read as a comment up to its end."""
        try:
            return super().parse_html_declaration(i)
        except AssertionError:
            end = self.rawdata.find(">", i + 2)
            return end + 1 if end >= 0 else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        """Server code ends at its own mark; there may be tags in it."""
        if self.rawdata.startswith(("<?php", "<?="), i):
            end = self.rawdata.find("?>", i)
            return end + 2 if end >= 0 else -1
        return super().parse_pi(i)

    @property
    def lines(self) -> list[tuple[str, int, int]]:
        """All lines but those of doubtful blocks that are short or half links."""
        gone = {d for d, (size, links) in enumerate(self.doubts) if d and (size < LEAST_DOUBTFUL or 2 * links >= size)}
        return [(text, tags, container) for text, tags, container, doubt in self.found if doubt not in gone]

    def _line(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                _, _, container, doubt = self.stack[-1] if self.stack else ("", False, 0, 0)
                self.found.append((line, self.tags, container, doubt))
                if self.heading:
                    self.titled.add(container)
            self.text = []
        self.tags = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            self.tags += 1
            if tag == "br":
                self.text.append(" ")
        else:
            self._line()
            if tag in CLOSES_P:
                self._close("p", CONTAINERS)
            for other in SAME_CLOSES.get(tag, ()):
                self._close(other, LIMITS[tag])
            self.tags = 1
        if tag in VOID:
            return
        _, dropped, container, doubt = self.stack[-1] if self.stack else ("", False, 0, 0)
        if tag in CONTAINERS:
            self.containers.append((tag, container))
            container = len(self.containers) - 1
        if tag == "article":
            self.article += 1
        if tag == "h1":
            self.heading += 1
        verdict = GONE if dropped else _verdict(tag, attrs, self.article > 0, self.article > 0 or self.open["main"] > 0)
        if verdict == DOUBTFUL and not doubt:
            self.doubts.append([0, 0])
            doubt = len(self.doubts) - 1
        self.open[tag] += 1
        self.stack.append((tag, verdict == GONE, container, doubt))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in INLINE:
            self.tags += 1
        else:
            self._line()
        self._close(tag, () if tag not in INLINE else CONTAINERS)

    def _close(self, tag: str, limits) -> None:
        """Pop up to the innermost open `tag`, but not through an element of `limits`."""
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name == tag:
                self.article -= sum(1 for e in self.stack[at:] if e[0] == "article")
                self.heading -= sum(1 for e in self.stack[at:] if e[0] == "h1")
                self.open.subtract(e[0] for e in self.stack[at:])
                del self.stack[at:]
                return
            if name in limits:
                return

    def handle_data(self, data: str) -> None:
        if not (self.stack and self.stack[-1][1]):
            self.text.append(data)
            doubt = self.stack[-1][3] if self.stack else 0
            if doubt:
                size = len("".join(data.split()))
                self.doubts[doubt][0] += size
                self.doubts[doubt][1] += size if self.open["a"] else 0

    def close(self) -> None:
        # A comment, section or piece of server code that is never closed reaches to the end of the page.
        if self.rawdata.startswith(("<!--", "<![", "<?")):
            self.rawdata = ""
        super().close()
        self._line()


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends only the weights that fall inside count."""
    radius = int(3 * sigma + 0.5)
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    if not len(values):
        return values
    return np.convolve(values, weights)[radius : radius + len(values)] / np.convolve(np.ones(len(values)), weights)[
        radius : radius + len(values)
    ]


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one line feed; empty if there is none."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    parser.close()
    lines = parser.lines
    if not lines:
        return ""
    ratios = smoothed(np.array([len(text) / max(tags, 1) for text, tags, _ in lines], float))
    threshold = min(ratios.mean(), ratios.max() / 2)
    clustered: Counter[int] = Counter()
    for (text, _, container), ratio in zip(lines, ratios):
        if ratio >= threshold:
            clustered[container] += len(text)
    lengths: Counter[int] = Counter()
    for text, _, container in lines:
        lengths[container] += len(text)
    article = article_containers(parser, clustered, lengths)
    return "\n".join(text for text, _, container in lines if container in article)


def subtree_sums(parser: PageLines, weight: Counter[int]) -> list[int]:
    """Weight of every container with those inside it. A container opens after the one around it."""
    sums = [weight[c] for c in range(len(parser.containers))]
    for c in range(len(sums) - 1, 0, -1):
        sums[parser.containers[c][1]] += sums[c]
    return sums


def article_containers(parser: PageLines, clustered: Counter[int], lengths: Counter[int]) -> set[int]:
    """The containers whose lines are the article, by their clustered text; `lengths` is all text by container."""
    tags, around = zip(*parser.containers)
    inside = [False] * len(tags)  # of an article or main, or being one
    for c in range(1, len(tags)):
        inside[c] = tags[c] in ("article", "main") or inside[around[c]]
    # If most clustered text stands in articles, the other does not count.
    marked = Counter({c: n for c, n in clustered.items() if inside[c]})
    only_marked = 2 * marked.total() > clustered.total()
    sums = subtree_sums(parser, marked if only_marked else clustered)
    # Holders of more than half lie inside each other, so the last one to open is the smallest. A quotation and a part of an
    # article are never the whole.
    best = max(
        c
        for c in range(len(tags))
        if sums[c] >= NEARLY * sums[0]
        and tags[c] != "blockquote"
        and not (only_marked and inside[around[c]] and tags[c] not in ("article", "main"))
    )
    # A heading beside the text belongs to it, if little else stands beside it.
    everything = subtree_sums(parser, lengths)
    titled = subtree_sums(parser, Counter(parser.titled))
    outer = best
    while not inside[best] and not titled[best] and tags[outer] not in ("", "body"):
        outer = around[outer]
        if tags[outer] in ("", "body") or everything[best] < NEARLY * everything[outer]:
            break
        if titled[outer]:
            best = outer
    kept = {best}
    for c in range(best + 1, len(tags)):
        if around[c] in kept:
            kept.add(c)
    return {c for c in kept if inside[c]} if only_marked else kept


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of `pages`: `page_id`, `url`, `text`, `n_chars` (code points). A null page has no text.

    A page costs time in proportion to its length; pages are spread by row, so no site is bound to one task. Repeated rows
    are read each for itself; further columns are not read.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(html) for html in batch["html"]]
            yield pd.DataFrame(
                {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}
            )

    return pages.select("page_id", "url", "html").mapInPandas(extracted, f"page_id {id_type}, url string, text string, n_chars long")

"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing, a threshold, regions.

The standard library's parser streams events once over a page. They make lines: the text between two block tags, with its
tags, its linked text, and the element it stands in. The ratio of a line is its unlinked text over its tags; lines of
menus, headers, footers, sidebars, notices, adverts, forms and comments have ratio 0. Ratios are smoothed with a Gaussian,
and lines at or above the spread of the smoothed ratios are content. Content lines choose the regions: the articles that
hold much of them, or else the containers; all other lines of a chosen region belong to the text, short ones too.

Cases: null, empty and unreadable pages have empty text; broken markup is read as far as it goes: open elements end with
the page, end tags without a start are passed over, a menu or form left open ends where an article starts; a page without
content lines gives all lines that are not of the kinds above; if a form holds the whole page, forms count as any element.
Very long pages are read whole, one at a time. Rows are independent, also those that repeat; other columns pass through, but
for the page itself, and one named like the result is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set(
    "applet audio button canvas datalist dialog iframe meter noembed noframes noscript object option progress script select style "
    "svg template textarea title video".split()
)
ASIDE = {"aside", "footer", "form", "header", "nav"}
ARTICLE = {"article", "main"}
HEADINGS = {f"h{i}" for i in range(1, 7)}
CONTAINERS = ARTICLE | ASIDE | {"body", "center", "div", "section", "td", "th"}
BLOCKS = CONTAINERS | HEADINGS | DROPPED | set(
    "address blockquote caption dd details dl dt fieldset figcaption figure head hr html legend li menu ol p pre search summary "
    "table tbody tfoot thead tr ul".split()
)
#: Words in class, id and role that tell what an element is for.
HINTS = set(
    "ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies copyright dialog discussion disclaimer disqus footer gdpr header login masthead menu menus modal "
    "nav navbar navigation navigator newsletter notice notices notification overlay pager pagination popup promo promos promoted "
    "promotion recommended related replies reply respond search share sharing sidebar sidebars signin signup skip social sponsor "
    "sponsored subscribe subscription teaser teasers toolbar".split()
)
#: Those that count on an article itself; its other names say how the page is laid out.
ARTICLE_HINTS = set("ad ads advert comment comments promo promoted related reply sponsored teaser".split())
NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NOT_HINTS = {"has", "no", "with", "without"}  # the word after them names a layout
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
KERNEL = np.exp(-0.5 * np.arange(-2, 3) ** 2)
LEAST_SHARE = 0.2  # of the largest region's content text


def hinted(attrs: dict[str, str | None], hints: set[str]) -> bool:
    """Whether class, id or role name one of the hints."""
    for field in ("class", "id", "role"):
        before = ""
        for word in map(str.lower, NAMES.findall(attrs.get(field) or "")):
            if word in hints and before not in NOT_HINTS:
                return True
            before = word
    return False


class Lines(HTMLParser):
    """Lines of a page with what the choice of regions needs to know about each."""

    def __init__(self, keep_forms: bool = False) -> None:
        super().__init__(convert_charrefs=True)
        self.keep_forms = keep_forms
        self.texts: list[str] = []
        #: unlinked characters, linked characters, tags, aside or not, container, article, heading or not
        self.facts: list[tuple[int, int, int, bool, int, int, str]] = []
        self.open: list[tuple[str, str, int, int, str]] = []  # tag, kind, container, article, heading
        self.containers = self.articles = 0
        self.dropped = self.aside = 0
        self.header_at = -1  # where the header of an article is open; its headings belong to the text
        self.parts: list[str] = []
        self.linked = self.tags = 0
        self.in_link = False

    def _end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, _, container, article, heading = self.open[-1] if self.open else ("", "", 0, 0, "")
            linked = min(self.linked, len(text))
            tags = max(self.tags, 1)
            self.texts.append(text)
            self.facts.append((len(text) - linked, linked, tags, self.aside > 0, container, article, heading))
            self.tags = 0
        self.parts.clear()
        self.linked, self.in_link = 0, False

    def _kind(self, tag: str, attrs: dict[str, str | None]) -> str:
        if tag in DROPPED or "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style") or ""):
            return "dropped"
        if tag in ("html", "body", "main"):
            return ""
        if tag == "article":
            return "aside" if hinted(attrs, ARTICLE_HINTS) else ""
        if tag in HEADINGS:
            return "title" if self.header_at >= 0 and self.aside == 1 else ""
        if tag == "form" and self.keep_forms:
            return ""
        return "aside" if tag in ASIDE or hinted(attrs, HINTS) else ""

    def _push(self, tag: str, kind: str, is_header: bool) -> None:
        _, _, container, article, heading = self.open[-1] if self.open else ("", "", 0, 0, "")
        if tag in CONTAINERS:
            self.containers += 1
            container = self.containers
        if tag == "article" and (article <= 0) or tag == "main" and not article:
            self.articles += 1
            article = self.articles if tag == "article" else -self.articles
        if is_header and article:
            self.header_at = len(self.open)
        heading = tag if tag in HEADINGS else heading
        self.dropped += kind == "dropped"
        self.aside += {"aside": 1, "title": -1}.get(kind, 0)
        self.open.append((tag, kind, container, article, heading))

    def _pop(self) -> None:
        kind = self.open.pop()[1]
        self.dropped -= kind == "dropped"
        self.aside -= {"aside": 1, "title": -1}.get(kind, 0)
        if self.header_at >= len(self.open):
            self.header_at = -1

    def _pop_to(self, at: int) -> None:
        while len(self.open) > at:
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in BLOCKS:
            self.tags += 1
            if tag == "br":
                self.parts.append(" ")
            elif tag == "a":
                self.in_link = True
            return
        self._end_line()
        self.tags += 1
        if tag in VOID:
            return
        names = [e[0] for e in self.open]
        if "p" in names:  # a block ends an open paragraph
            self._pop_to(names.index("p"))
        elif tag in ("li", "dt", "dd", "tr", "td", "th", "option") or tag in HEADINGS:
            alike = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            if tag in HEADINGS:
                alike = tuple(HEADINGS)
            if names and names[-1] in alike:
                self._pop()
        if tag in ARTICLE:  # what cannot hold an article was left open
            left = [i for i, e in enumerate(self.open) if e[0] in ("form", "header", "footer", "nav")]
            if left:
                self._pop_to(left[0])
        known = {k: v for k, v in attrs}
        kind = self._kind(tag, known)
        self._push(tag, kind, tag == "header" or kind == "aside" and tag == "div" and hinted(known, {"header"}))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in BLOCKS and tag not in VOID and tag in DROPPED:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in BLOCKS:
            self.tags += 1
            self.in_link = self.in_link and tag != "a"
            return
        self._end_line()
        self.tags += 1
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                return self._pop_to(at)

    def handle_data(self, data: str) -> None:
        if self.dropped:
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data.strip())

    def close(self) -> None:
        super().close()
        self._end_line()


def content_lines(ratios: np.ndarray) -> np.ndarray:
    """Which lines are content: smoothed ratios at or above the spread of all smoothed ratios."""
    near = np.convolve(np.pad(ratios, 2), KERNEL, "valid")
    smooth = near / np.convolve(np.pad(np.ones(len(ratios)), 2), KERNEL, "valid")
    return (smooth >= smooth.std()) & (ratios > 0)


def chosen_lines(facts: list[tuple]) -> np.ndarray:
    """Which lines belong to the main text."""
    own, linked, tags, aside, containers, articles = (np.array(c) for c in list(zip(*facts))[:6])
    headings = [f[6] for f in facts]
    aside = aside.astype(bool)
    ratios = np.where(aside, 0.0, own / tags)
    core = content_lines(ratios)
    if not core.any():
        return ~aside
    for kind in (articles > 0, articles < 0):
        held = {r: own[core & (articles == r)].sum() for r in set(articles[core & kind].tolist())}
        if held:
            regions = [r for r, n in held.items() if n >= LEAST_SHARE * max(held.values())]
            return np.isin(articles, regions) & ~aside
    held = {c: own[core & (containers == c)].sum() for c in set(containers[core].tolist())}
    regions = [c for c, n in held.items() if n >= LEAST_SHARE * max(held.values())]
    inside = np.isin(containers, regions)
    first, *_, last = np.flatnonzero(core & inside).repeat(2)
    at = np.arange(len(own))
    loose = (linked <= own) & ~aside
    chosen = loose & (at >= first) & (at <= last)
    chosen |= loose & inside & (containers > 1)  # beyond the range, lines of the page itself are not trusted
    before = [i for i in range(first) if headings[i] == "h1" and loose[i]]
    chosen[before] = True
    return chosen


def main_text(html: str | None) -> str:
    """The blocks of the article, one to a line."""
    if not html:
        return ""
    for keep_forms in (False, True):  # again if a form holds the whole page
        page = Lines(keep_forms)
        page.feed(html)
        page.close()
        if not all(f[3] for f in page.facts):
            break
    if not page.texts:
        return ""
    return "\n".join(t for t, wanted in zip(page.texts, chosen_lines(page.facts)) if wanted)


def extract_pages(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """The columns of ``df`` without the page, and its main text in ``out``. Nothing is shuffled."""
    keep = [f for f in df.schema.fields if f.name not in (html, out)]
    schema = T.StructType([*keep, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(0)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], texts], names=schema.names)

    return df.select(f"`{html}`", *[f"`{f.name}`" for f in keep]).mapInArrow(run, schema)

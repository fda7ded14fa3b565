"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser streams its events into lines (blocks of text). Menus, headers, footers, sidebars, notices,
adverts, forms and reader comments are known by their elements and by what their class, id or role says; their lines
count in the ratio's course but are never content. The smoothed ratio is cut at a multiple of its deviation; the lines
above the cut are clusters of content, and the elements that enclose them are the regions whose lines stay, short
lines and headings included. A page is one row: nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, text_of
from .tokens import text_slices

#: Lines on either side that the smoothing sees, and its standard deviation in lines.
REACH, SIGMA = 3, 1.0
#: Lines stay whose smoothed ratio is at least this multiple of the deviation of all lines of the page.
CUT = 0.5
#: A region goes on into a part of it that has at least this share of its content.
SHARE = 0.8
#: Articles with less than this share of the content are teasers, if there is a main element with content.
HALF = 0.5
#: A block outside an article is a list of links if they are more than this share of its text.
LINKED = 0.5

VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
#: Elements within a line; all others end it.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split())
#: Never text of the page.
SILENT = frozenset("script style noscript template iframe object svg math canvas audio video map title datalist".split())
#: Page furniture by element. An article within a form, a header or a menu that was never closed is content all the same.
FURNITURE = frozenset("nav footer aside dialog menu header form button select textarea fieldset label legend option optgroup output".split())
_REOPENED = frozenset("nav header form fieldset".split())
#: Page furniture by a word of class or id, and by role.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense banner banners breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion recommended "
    "related reply replies respond search share sharing sidebar signup skip skiplink social sponsor sponsored sponsors subscribe subscription toolbar widget widgets".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: What an article is not, if its class says so.
_NO_ARTICLE = frozenset("ad ads advert advertisement comment comments promo promoted recommended related reply sponsored teaser".split())
#: An open element of these names ends when a new one of the group begins in the same list, table or page.
_SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_TAG = re.compile(r"<[A-Za-z/!?]")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _marked(attrs: dict[str, str | None], known: frozenset[str]) -> bool:
    """Whether a class or the id begins or ends with a known word (`site-footer`, `adBox`), or is one."""
    for name in [*(attrs.get("class") or "").split(), *(attrs.get("id") or "").split()]:
        words = [w.lower() for w in _WORDS.findall(name)]
        if words and words[0] not in ("has", "no", "not", "with", "without", "is") and (words[0] in known or words[-1] in known):
            return True
    return False


def _hidden(attrs: dict[str, str | None]) -> bool:
    return "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower()


class _Line:
    __slots__ = ("linked", "parts", "region", "state", "tags")

    def __init__(self, region: int, state: int):
        self.parts, self.linked, self.tags, self.region, self.state = [], 0, 0, region, state


class Lines(HTMLParser):
    """Lines of a page with tags, linked characters and their element. Any markup is read to its end; depth costs no more than its tags.

    states: 0 text of the page, 1 furniture that an article ends, 2 furniture, 3 no text at all.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.parents, self.kinds = [-1], [""]  # by element that can be a region
        self.stack: list[tuple[str, int, int, str]] = [("", 0, 0, "")]  # name, region, state, "article" or "main" within one
        self.open: dict[str, int] = {}
        self.links = 0
        self.line: _Line | None = None

    def _pop(self) -> None:
        name = self.stack.pop()[0]
        self.open[name] -= 1
        self.links -= name == "a"

    def _break(self) -> None:
        self.line = None

    def _now(self) -> _Line:
        if self.line is None:
            _, region, state, _ = self.stack[-1]
            self.line = _Line(region, state)
            self.lines.append(self.line)
        return self.line

    def handle_starttag(self, tag, attrs):
        inline = tag in INLINE
        if not inline:
            self._break()
            group, within = _SIBLINGS.get(tag, (None, None))
            if tag == "body" and self.open.get("head"):
                self.handle_endtag("head")
            while self.open.get("p") and self.stack[-1][0] in INLINE | {"p"}:  # a block ends the paragraph before it
                ended = self.stack[-1][0] == "p"
                self._pop()
                if ended:
                    break
            if group and any(self.open.get(g) for g in group):
                k = len(self.stack) - 1
                while k and self.stack[k][0] not in group and self.stack[k][0] not in within and (self.stack[k][0] in INLINE or self.stack[k][0] == "p" or tag == "tr"):
                    k -= 1
                if self.stack[k][0] in group:
                    while len(self.stack) > k:
                        self._pop()
        if tag in VOID:
            if tag == "br":
                self.handle_data(" ")
            elif self.line is not None or inline:
                self._now().tags += 1
            return
        found = dict(attrs)
        _, region, state, article = self.stack[-1]
        role = (found.get("role") or "").lower()
        if tag in SILENT or _hidden(found):
            state = 3
        elif tag in ("article", "main") or role == "main" or (found.get("itemprop") or "").lower() == "articlebody":
            if tag == "article" and _marked(found, _NO_ARTICLE):
                state = max(state, 2)
            elif state <= 1:
                state, article = 0, "article" if article == "article" or not (tag == "main" or role == "main") else "main"
        elif tag in FURNITURE or role in ROLES or (tag not in ("html", "body") and _marked(found, MARKS)):
            state = max(state, 1 if tag == "header" or tag in _REOPENED and not article else 2)
        elif tag in _HEADINGS and article and state == 1:
            state = 0  # the heading in an article's own header
        if not inline and tag != "p":
            self.parents.append(region)
            self.kinds.append(article if article != self.stack[-1][3] else tag)
            region = len(self.parents) - 1
        changed = state != self.stack[-1][2]
        self.stack.append((tag, region, state, article))
        self.open[tag] = self.open.get(tag, 0) + 1
        self.links += tag == "a"
        if changed:
            self._break()
        self._now().tags += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("p", "div", "a", "span"):  # a slash doesn't close these
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in VOID or not self.open.get(tag):
            return
        if tag not in INLINE:
            self._break()
        elif self.line is not None:
            self.line.tags += 1
        was = self.stack[-1][2]
        if tag in INLINE:  # an inline end never closes blocks
            k = len(self.stack) - 1
            while k and self.stack[k][0] in INLINE and self.stack[k][0] != tag:
                k -= 1
            if self.stack[k][0] != tag:
                return
            name, region, state, article = self.stack[k]
            del self.stack[k]
            self.open[name] -= 1
            self.links -= name == "a"
        else:
            while True:
                name = self.stack[-1][0]
                self._pop()
                if name == tag:
                    break
        if self.stack[-1][2] != was:
            self._break()

    def handle_data(self, data):
        if self.stack[-1][2] < 3:
            line = self._now()
            line.parts.append(data)
            if self.links:
                line.linked += len(data)


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """The ratios under a Gaussian kernel of REACH lines on either side, rescaled at the ends."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(ratios, kernel)[REACH : REACH + len(ratios)] / np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]


def _read(html: str) -> Lines:
    """A page's lines. A tag or comment that never ends hides the rest of the page, as in browsers; the parser would try it from every start anew."""
    reader = Lines()
    closed = html.rfind("-->") + 1
    comment = html.find("<!--", closed + 2 if closed else 0)
    head = html if comment < 0 else html[:comment]
    tag = _TAG.search(head, head.rfind(">") + 1)
    reader.feed(head[: tag.start()] if tag else head)
    if reader.cdata_elem and comment >= 0:  # no comment, but within a script
        reader.feed(html[comment:])
    reader.close()
    return reader


def main_text(html: str) -> str:
    """The blocks of the page's content, joined by a space; empty if there are none."""
    reader = _read(html)
    found = [(" ".join("".join(x.parts).split()), x) for x in reader.lines]
    texts = np.array([len(t) for t, _ in found], dtype=float)
    if not texts.any():
        return ""
    free = np.array([x.state == 0 for _, x in found])
    region = np.array([x.region for _, x in found])
    ratio = smoothed(np.where(free, texts, 0) / np.maximum(1, [x.tags for _, x in found]))
    dense = free & (texts > 0) & (ratio >= CUT * ratio.std())
    parents, kinds = reader.parents, reader.kinds
    chars, content, links = np.zeros((3, len(parents)))
    np.add.at(chars, region[free], texts[free])
    np.add.at(content, region[dense], texts[dense])
    np.add.at(links, region[free], np.array([min(x.linked, len(t)) for t, x in found], dtype=float)[free])
    for k in range(len(parents) - 1, 0, -1):  # an element comes after the one around it
        for total in (chars, content, links):
            total[parents[k]] += total[k]
    places = {name: [k for k, own in enumerate(kinds) if own == name and chars[k]] for name in ("article", "main")}
    held = [k for k in places["article"] if content[k]]
    whole = [k for k in places["main"] if content[k]]
    if held and content[held].sum() < HALF * content[0] and whole:
        held = []  # the articles are teasers
    chosen = held or whole or (content[0] == 0 and (places["article"] or places["main"])) or []
    inside = np.zeros(len(parents), dtype=bool)
    if chosen:
        inside[chosen] = True
    elif content[0]:
        children: dict[int, list[int]] = {}
        for k in range(1, len(parents)):
            children.setdefault(parents[k], []).append(k)
        top = 0
        while best := max((c for c in children.get(top, []) if kinds[c] not in _HEADINGS and content[c] >= SHARE * content[top]), key=lambda c: content[c], default=0):
            top = best
        while kinds[top] in ("li", "td", "th", "tr", "tbody", "pre", "blockquote") and parents[top] > 0:  # rather all of a list or table than one of its blocks
            top = parents[top]
        inside[top] = True
    kept = inside.copy()
    for k in range(1, len(parents)):
        listed = not chosen and not content[k] and chars[k] and links[k] > LINKED * chars[k]
        kept[k] |= kept[parents[k]] and not listed
    return " ".join(t for (t, x) in found if t and x.state == 0 and kept[x.region])


def extract(pages: DataFrame, html_col: str = "html", text: str = "text") -> DataFrame:
    """All rows of pages as a struct `row` (without the html), with the main text and `n_chars`, its code points.

    Null and empty html, and pages without content, give the empty text. Whole pages are read, whatever their length;
    markup that never ends is read to the page's end. Repeated rows are read alike.
    """
    ready(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in text_slices(batches, "_html", 4 << 20):
            texts = [main_text(h) for h in rows.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["row", text, "n_chars"])

    keep = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c != html_col])
    rows = pages.select(keep.alias("row"), text_of(f"`{html_col}`").alias("_html"))
    return rows.mapInArrow(read, f"row {rows.schema['row'].dataType.simpleString()}, `{text}` string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return found.select("row.page_id", "row.url", "text", "n_chars")

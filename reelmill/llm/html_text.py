"""Main text of web pages: parser events, text-to-tag ratios per line, smoothing and clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import tidied

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Never text to read, wherever it stands.
HIDDEN = frozenset("script style noscript template head title iframe object svg math canvas audio video select textarea button datalist".split())
#: Around the article, not of it.
AROUND = frozenset("nav footer aside menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar status".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead comment comments "
    "commentlist disqus respond reply replies share sharing social related recommended recommendations newsletter subscribe signup login "
    "search pagination pager toolbar copyright skip".split()
)
#: What may stand beside such a name in one word of a class or id: with any other word it is the name of something else.
BESIDE = frozenset(
    "area bar block body bottom box btn button buttons card center close col column container content count css desktop div form frame grid group head header heading "
    "holder icon icons image images inner item items js label large left line link links list main media message mobile module more note outer page panel policy popular "
    "post posts primary region right row secondary section sections site slot small story stories text title tool tools top unit view wrap wrapper".split()
)
#: Names of what is a block of its own and can outgrow the article it stands beside.
LONG = frozenset(
    "ad ads adv advert adverts advertisement advertising adslot sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup "
    "modal comment comments commentlist disqus respond reply replies newsletter".split()
)
ARTICLE = frozenset(("article", "main"))
#: Characters that what is named after a part, but holds most of a page, has at least: less is that part.
LAYOUT = 200
#: What may stand in a head; anything else ends it.
IN_HEAD = frozenset("base link meta title style script noscript template".split())
_SCOPE = frozenset("table td th caption button object template html body".split())
_PARTS = _SCOPE | frozenset("ul ol menu dir dl article aside blockquote footer form header main nav section".split())
#: The start of a key ends the nearest of the elements first named, unless one of the second stands between.
ENDS = {
    **{t: (frozenset(("p",)), _SCOPE) for t in BLOCK - frozenset("br body html caption tbody tfoot thead tr td th legend option optgroup summary figcaption".split())},
    "li": (frozenset(("li", "p")), _PARTS),
    "dt": (frozenset(("dt", "dd", "p")), _PARTS),
    "dd": (frozenset(("dt", "dd", "p")), _PARTS),
    "td": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "th": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    **{t: (frozenset(("tbody", "thead", "tfoot")), frozenset(("table",))) for t in ("tbody", "thead", "tfoot")},
}
ENDABLE = frozenset("p li dt dd td th tr tbody thead tfoot".split())
_WORD = re.compile(r"[a-z]{2,}")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MARKED = ENDABLE | _PARTS

SURE, NAMED, NAMED_LONG, HEADER = 1, 2, 3, 4


def _named(value: str, inside: bool) -> int:
    """How the words of a class or id hide their element: by a name of what isn't the article, alone or with words that go with any."""
    how = 0
    for word in value.split():
        parts = _WORD.findall(_CAMEL.sub(" ", word).lower())
        names = [x for x in parts if x in NAMES or not inside and x == "header"]
        if names and all(x in names or x in BESIDE for x in parts):
            how = max(how, NAMED if LONG.isdisjoint(names) else NAMED_LONG)
    return how


class _Lines(HTMLParser):
    """Collects lines: (text, tags met, characters inside links, the article they stand in).

    What an element is leaves its text out for good; what it is only named leaves it out unless ``_shown`` finds
    that the name is a layout's, so such text is kept with the named element it stands in until the page is read.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, int]] = []  # tag, how it hides its content, article number it opened
        self.open: Counter[str] = Counter()
        self.marks: list[int] = []  # places in the stack of what end tags let out have to do with
        self.hiding = 0
        self.articles: list[int] = [0]
        self.count = 0
        self.around: list[int] = [0]  # of each article number, the article around it
        self.opened_in: list[int] = [0]  # of each article number, the named element around it
        self.named: list[tuple[int, int]] = [(0, 0)]  # of each named element, the one around it and how it hides
        self.chain: list[int] = [0]
        self.headed: set[int] = set()  # named elements that hold a heading outside links
        self.links = 0
        self.blocks: list[tuple[list[tuple[str, int, bool]], int, int]] = []
        self.pieces: list[tuple[str, int, bool]] = []  # text, the named element around it, whether in a link
        self.tags = 0

    def _break(self) -> None:
        if self.pieces:
            self.blocks.append((self.pieces, self.tags, self.articles[-1]))
            self.tags = 0
            self.pieces = []

    def _hides(self, tag: str, attrs: list[tuple[str, str | None]]) -> int:
        if tag in HIDDEN or tag in AROUND:
            return SURE
        if tag in ("body", "html"):
            return 0
        inside = self.articles[-1] > 0
        named = HEADER if tag == "header" and not inside else NAMED if tag == "form" else 0
        for key, value in attrs:
            if key == "hidden" or key == "aria-hidden" and value == "true":
                return SURE
            if not value:
                continue
            if key == "role" and value.lower() in ROLES:
                return SURE
            if not named and (key in ("class", "id") and tag not in ARTICLE or key == "class" and "comment" in value.lower()):
                named = _named(value, inside)
            if key == "style" and "display:none" in value.replace(" ", "").lower():
                return SURE
        return named

    def _pop(self) -> str:
        t, hides, opened = self.stack.pop()
        self.open[t] -= 1
        if self.marks and self.marks[-1] == len(self.stack):
            self.marks.pop()
        self.hiding -= hides == SURE
        if hides > SURE:
            self.chain.pop()
        self.links -= t == "a"
        if opened:
            self.articles.pop()
        return t

    def _end_implied(self, tag: str) -> None:
        """Closes what HTML lets go on without an end tag up to here."""
        if tag == "body" and self.open["head"]:
            while self._pop() != "head":
                pass
        elif self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self._pop()
        if tag not in ENDS:
            return
        ended, stops = ENDS[tag]
        if not any(self.open[t] for t in ended):
            return
        at = None
        for i in reversed(self.marks):
            t = self.stack[i][0]
            if t in ended:
                at = i
                if t != "p":
                    break
            elif t in stops:
                break
        while at is not None and len(self.stack) > at:
            self._pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._break()
        self._end_implied(tag)
        if tag in VOID:
            return
        hides = self._hides(tag, attrs)
        opened = 0
        if tag in ARTICLE and not hides and not self.hiding:
            self.count += 1
            opened = self.count
            self.around.append(self.articles[-1])
            self.opened_in.append(self.chain[-1])
            self.articles.append(opened)
        self.hiding += hides == SURE
        if hides > SURE:
            self.named.append((self.chain[-1], hides))
            self.chain.append(len(self.named) - 1)
        self.links += tag == "a"
        self.open[tag] += 1
        if tag in _MARKED:
            self.marks.append(len(self.stack))
        self.stack.append((tag, hides, opened))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCK:
            self._break()
        if not self.open[tag]:
            return
        while self._pop() != tag:  # what is still open inside ends with it
            pass

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._pop()
        if self.hiding or not data:
            return
        if len(self.chain) > 1 and not self.links and (self.open["h1"] or self.open["h2"]) and data.strip():
            self.headed.add(self.chain[-1])
        self.pieces.append((data, self.chain[-1], self.links > 0))

    def _shown(self) -> list[bool]:
        """Of each named element, whether its text is read after all.

        It is where the element holds most of the page's text outside links, or the article with most of it: then it
        is a layout named after one of its parts. Names of what can outgrow an article need both. A page's header is read
        where there is no article and it has a heading that is no link.
        """
        size = len(self.named)
        prose, held, of_article = [0] * size, [False] * size, [0] * (self.count + 1)
        for pieces, _, article in self.blocks:
            for text, named, linked in pieces:
                if not linked:
                    n = len(text.strip())
                    prose[named] += n
                    of_article[article] += n
        if self.count:
            most = max(range(1, self.count + 1), key=of_article.__getitem__)
            held[self.opened_in[most]] = of_article[most] > 0
        for i in range(size - 1, 0, -1):
            around = self.named[i][0]
            prose[around] += prose[i]
            held[around] |= held[i]
        shown = [True] * size
        for i in range(1, size):
            around, how = self.named[i]
            most_text = 2 * prose[i] > prose[0] and prose[i] >= LAYOUT
            if how == HEADER:
                own = held[i] or not self.count and (most_text or i in self.headed)
            else:
                own = most_text and held[i] if how == NAMED_LONG else most_text or held[i]
            shown[i] = shown[around] and own
        return shown

    def _lines(self, shown: list[bool]) -> list[tuple[str, int, int, int]]:
        lines, tags = [], 0
        for pieces, met, article in self.blocks:
            tags += met
            text = " ".join("".join(t for t, named, _ in pieces if shown[named]).split())
            if text:
                lines.append((text, tags, sum(len(t) for t, named, linked in pieces if linked and shown[named]), article))
                tags = 0
        return lines

    def finish(self) -> list[tuple[str, int, int, int]]:
        self.close()
        self._break()
        return self._lines(self._shown())


def smooth(ratios: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """A Gaussian over neighbouring lines; beyond the ends the end lines go on."""
    reach = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    padded = np.pad(ratios, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def main_text(html: str | None) -> str:
    """The main text of one page.

    Lines are blocks; menus, forms, notices and the like are left out by what their elements say they are. Each
    line has a ratio of text to tags; smoothed over the lines of its region (one article element, or what lies between
    such), the ratios above their standard deviation form the content clusters, without lines that are mostly links.
    A cluster in an article element stands for all lines of that element: its short lines, too, are the article's.
    Clusters outside stand for themselves, and all clusters together are the content. Nothing is forced: where all text is
    in menus, notices and the like, or in links, there is none.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    ratios = np.array([len(t) / max(1, tags) for t, tags, _, _ in lines])
    article = np.array([a for _, _, _, a in lines])
    borders = np.flatnonzero(np.diff(article)) + 1
    level = np.concatenate([smooth(part) for part in np.split(ratios, borders)])  # nothing of an article reaches its neighbours
    content = (level >= min(level.std(), level.max())) | (level >= level.mean())
    content &= np.array([2 * linked <= len(t) for t, _, linked, _ in lines])
    taken = [False] * (parser.count + 1)
    for a in article[content]:
        taken[a] = bool(a)
    for a in range(1, parser.count + 1):  # an article comes after the one around it
        taken[a] |= taken[parser.around[a]]
    return " ".join(t for (t, _, _, a), c in zip(lines, content, strict=True) if c or taken[a])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars; each page is parsed whole where it is read.

    Defined cases: null, empty and text-free pages have an empty text, and so have pages of menus, notices, comments or links alone; broken markup is taken as the parser takes
    it, an end tag closing all that is open inside it, and end tags that HTML lets out are put in; very long pages and deep nesting are
    read whole, in time that grows with their length; null ids and urls stay null; repeated rows each give a
    row; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(tidied(_texts), "page_id long, url string, text string, n_chars long")

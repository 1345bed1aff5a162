"""Main-text extraction from HTML by text-to-tag ratios.

Each page goes once through the standard library's streaming parser. Its events build lines:
block elements end a line, inline ones do not. Parts that are no article by their element (menus,
headers, footers, sidebars, forms, scripts, styles, ...) or by a word of their class, id or role
(adverts, cookie notices, comments, ...) are left out as they are parsed. Every other line has a
text-to-tag ratio: its characters over its tags. The ratios are smoothed with a Gaussian, and a
two-means clustering of the smoothed ratios gives a threshold between boilerplate and content.

Lines that reach it choose the content regions: article or main elements where a page has any (all
of them if no line of theirs reaches it), else the blocks that hold such lines and the blocks beside
them (see ``Lines.beside``). A chosen region gives all its lines, so short paragraphs and headings
of the article stay; text directly in the body is judged line by line, and so is a paragraph
of an article whose class word is a weak mark (``legal``, ``notice``, ``side``, ...).

A part that was left out but holds most of the page's letters outside links is the page itself and
is taken back (the page is then parsed again): a form around the page, a menu or header whose
end tag is missing, a container with a misleading class word beside which nothing is left.

Edge cases: null and empty html give an empty text; unclosed and stray tags end with the block
that holds them; an unclosed head ends at the first element of a body; character references are decoded; white space inside a block becomes one
space; repeated pages give repeated rows; very long pages are parsed in whole; other columns
are kept, and result columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keyweave.llm.common import with_columns

RESULT = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

# Elements without a closing tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
HIDDEN = frozenset("script style noscript template svg math iframe object canvas audio video "
                   "head title".split())
# Elements that are not the article by what they are.
ASIDE = frozenset("nav header footer aside form button select menu dialog fieldset".split())
MAIN = frozenset(("article", "main"))
CONTAINERS = frozenset("article main div section td center".split())
# Elements that do not end a line.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label "
                   "mark q s samp small span strike strong sub sup time tt u var wbr".split())
# Elements that an opening block closes when they are still open.
CLOSED_BY_BLOCK = frozenset(["p"])
SAME_CLOSES = frozenset("li dt dd tr td th option p".split())
# Elements of a head; others end it.
HEAD = frozenset("base link meta title style script noscript template head".split())
# Words of a class, id or role that mark what is not the article ...
NOISE = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|"
    r"overlay|newsletter|subscri\w*|nav\w*|menu|breadcrumbs?|sidebar|masthead|replies|disqus|"
    r"related|recommend\w*|share|sharing|social|toolbar|widget|login|signup|complementary|"
    r"contentinfo|search)(?:$|[_-])", re.I)
# ... and such that may also stand on a paragraph of the article.
WEAK = re.compile(r"(?:^|[_-])(?:notice|side|footer|header|copyright|legal)(?:$|[_-])", re.I)
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt".split())
# Whole words that mark a part with readers' comments (or one of them).
COMMENT = re.compile(r"(?:\w+?[-_])*?comments?(?:[-_]?(?:list|body|item|content|text|area|thread|"
                     r"section|box|entry|wrap|wrapper|container|form|respond|\d+))*", re.I)
# A word that says what a part has, or in which state it is, marks nothing.
STATE = re.compile(r"(?:has|with|no|without|not)[-_]", re.I)
SPACES = re.compile(r"\s+")


class Lines(HTMLParser):
    """Lines of a page: (text, tags, region). A region is an outermost article or main
    element, or else the innermost open container; ``articles`` are those of the first kind.
    ``around`` has each region's parent element, that one's tag, and the region's class words;
    ``letters`` has its characters and those of them in links."""

    def __init__(self, lifted: frozenset[int] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, bool]] = []  # the last: judged by its ratio
        # (tag, left out, article, region around, number, hidden, doubtful)
        self.open: list[tuple[str, bool, bool, int, int, bool, bool]] = []
        self.out = self.inside = self.region = self.n_open = self.hidden = self.doubt = 0
        self.lifted = lifted
        # of parts that were left out and may be taken back: letters, letters in links, closed, sort
        self.left_out: dict[int, list] = {}
        self.outside: list[int] = []  # those that are open
        self.visible = [0, 0]  # letters outside links: of the page, and of what was kept
        self.n_regions, self.articles = 0, set()
        self.around: dict[int, tuple[int, str, set[str]]] = {}
        self.letters: dict[int, list[int]] = {}
        self.link, self.linked = False, 0
        self.parts: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        text = SPACES.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, self.tags, self.region, self.doubt > 0))
            self.tags = 0
            letters = self.letters.setdefault(self.region, [0, 0])
            letters[0] += len(text)
            letters[1] += self.linked
        self.parts, self.linked = [], 0

    def _close(self, k: int) -> None:
        """Close the open element k and all inside it."""
        self.flush()
        self.link = False
        for _, out, article, _, number, hidden, doubt in self.open[k:]:
            self.out -= out
            self.inside -= article
            self.hidden -= hidden
            self.doubt -= doubt
            if self.outside and self.outside[-1] == number:
                self.outside.pop()
        self.region = self.open[k][3]
        del self.open[k:]

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "a":
            self.link = True
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "img", "input"):
                if tag == "br" and not self.out:
                    self.parts.append(" ")
                elif tag == "hr":
                    self.flush()
                return
            if tag in VOID:
                return
            if not any(k in ("class", "id", "hidden") for k, _ in attrs):
                return
        if tag not in HEAD and tag not in ("html", "svg"):
            head = next((k for k, x in enumerate(self.open[:3]) if x[0] == "head"), None)
            if head is not None:
                self._close(head)
        if tag not in INLINE:
            self.flush()
            last = next((k for k in range(len(self.open) - 1, -1, -1)
                         if self.open[k][0] not in INLINE), None)
            if last is not None and (self.open[last][0] in CLOSED_BY_BLOCK
                                     or (tag in SAME_CLOSES and self.open[last][0] == tag)):
                self._close(last)
        mark = "hidden" if tag in HIDDEN else self._mark(tag, attrs)
        self.n_open += 1
        if mark in ("part", "words") and self.n_open in self.lifted:
            mark = ""
        doubt = mark == "words" and self.inside > 0 and tag in LEAVES and self._weak(attrs)
        out = bool(mark) and not doubt
        article = tag in MAIN and not out
        if out and mark in ("part", "words"):
            self.left_out[self.n_open] = [0, 0, False, tag if mark == "part" else "words"]
            self.outside.append(self.n_open)
        around = next((x for x in reversed(self.open) if x[0] not in INLINE), ("", 0, 0, 0, 0))
        self.open.append((tag, out, article, self.region, self.n_open, mark == "hidden", doubt))
        if not self.inside and tag in CONTAINERS:
            self.n_regions += 1
            self.region = self.n_regions
            named = next((v for k, v in attrs if k == "class" and v), "")
            self.around[self.region] = (around[4], around[0], set(named.split()))
            if article:
                self.articles.add(self.region)
        self.out += out
        self.inside += article
        self.hidden += mark == "hidden"
        self.doubt += doubt

    @staticmethod
    def _words(attrs) -> list[str]:
        """Class, id and role words that can mark something."""
        return [w for k, v in attrs if v and k in ("class", "id", "role") for w in v.split()
                if not STATE.match(w)]

    @classmethod
    def _weak(cls, attrs) -> bool:
        return not any(NOISE.search(w) for w in cls._words(attrs))

    @classmethod
    def _mark(cls, tag, attrs) -> str:
        """Why the element is left out: "hidden", "comment", "part" (by what it is), "words" (by
        a class word), or "" (it is not)."""
        if any(k == "hidden" or (k == "style" and v and re.search(
                r"display\s*:\s*none", v, re.I)) for k, v in attrs):
            return "hidden"
        if tag in ASIDE:
            return "part"
        if tag in ("html", "body") or not attrs:
            return ""
        words = cls._words(attrs)
        if any(COMMENT.fullmatch(w) for w in words):
            return "comment"
        if tag not in MAIN and any(NOISE.search(w) or WEAK.search(w) for w in words):
            return "words"
        return ""

    def taken_back(self) -> set[int]:
        """Of the parts left out those that are the page itself (see the module docstring)."""
        total, kept = self.visible
        out = set()
        for number, (letters, linked, closed, sort) in self.left_out.items():
            n = letters - linked
            if 2 * n > total and (sort in ("form", "fieldset") or not closed
                                  or (sort == "words" and 10 * kept < n)):
                out.add(number)
        return out

    def beside(self, chosen: set[int]) -> set[int]:
        """The regions of ``chosen`` and those under the same parent, unless half of a region's
        characters are in links. Directly in the body, where a page has its other parts too,
        they must share a class word or both have no class."""
        parents: dict[int, list[set[str]]] = {}
        for r in chosen & self.around.keys():
            parents.setdefault(self.around[r][0], []).append(self.around[r][2])
        out = set(chosen)
        for r, (parent, tag, named) in self.around.items():
            total, linked = self.letters.get(r, (0, 0))
            if parent in parents and 2 * linked < total and (
                    tag not in ("", "html", "body")
                    or any(named & x or not (named or x) for x in parents[parent])):
                out.add(r)
        return out

    def handle_startendtag(self, tag, attrs):
        self.tags += 1
        if tag == "br" and not self.out:
            self.parts.append(" ")
        elif tag not in INLINE:
            self.flush()

    def handle_endtag(self, tag):
        self.tags += 1
        if tag == "a":
            self.link = False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                if self.open[k][4] in self.left_out:
                    self.left_out[self.open[k][4]][2] = True
                if tag in INLINE:
                    _, out, _, _, number, hidden, doubt = self.open.pop(k)
                    self.out -= out
                    self.hidden -= hidden
                    self.doubt -= doubt
                    if number in self.outside:
                        self.outside.remove(number)
                else:
                    self._close(k)
                return
            if self.open[k][0] in ("html", "body"):
                return
        if tag not in INLINE and tag not in VOID:
            self.flush()

    def handle_data(self, data):
        n = len(data.strip())
        if n and not self.hidden:
            for number in self.outside:
                self.left_out[number][0] += n
                self.left_out[number][1] += n * self.link
            if not self.link:
                self.visible[0] += n
                self.visible[1] += n * (not self.out)
        if not self.out:
            self.parts.append(data)
            if self.link:
                self.linked += n


def smoothed(ratios: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing; the edges repeat their last value."""
    r = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(ratios, r, mode="edge"), kernel / kernel.sum(), mode="valid")


def threshold(values: np.ndarray) -> float:
    """The midpoint between the centres of a two-means clustering of the values."""
    lo, hi = float(values.min()), float(values.max())
    if hi - lo < 1e-9:
        return lo
    for _ in range(50):
        cut = (lo + hi) / 2
        new_lo, new_hi = float(values[values <= cut].mean()), float(values[values > cut].mean())
        if abs(new_lo - lo) + abs(new_hi - hi) < 1e-9:
            break
        lo, hi = new_lo, new_hi
    return (lo + hi) / 2


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The page's main text, blocks joined by an empty line."""
    if not html:
        return ""
    lifted: frozenset[int] = frozenset()
    while True:
        parser = Lines(lifted)
        parser.feed(html)
        parser.close()
        parser.flush()
        more = parser.taken_back()
        if not more:
            break
        lifted |= more  # grows each time, by parts that hold most of the page: few times
    lines = parser.lines
    if not lines:
        return ""
    ratios = np.array([len(text) / max(1, tags) for text, tags, *_ in lines])
    smooth = smoothed(ratios, sigma)
    content = smooth >= threshold(smooth)
    chosen = {line[2] for line, keep in zip(lines, content, strict=True) if keep}
    articles = {line[2] for line in lines} & parser.articles
    if articles:
        chosen = chosen & articles or articles
    else:
        chosen = parser.beside(chosen)
    return "\n\n".join(line[0] for line, keep in zip(lines, content, strict=True)
                       if line[2] in chosen and (keep or (line[2] and not line[3])))


def extract(pages: DataFrame, *, html: str = "html", sigma: float = 1.0) -> DataFrame:
    """``pages`` without the html column, with text and n_chars (code points)."""
    schema = with_columns(T.StructType([f for f in pages.schema.fields if f.name != html]),
                          RESULT)
    keep = [f.name for f in schema.fields[:-2]]

    def run(batches):
        for b in batches:
            texts = [main_text(h, sigma) for h in
                     b.column(b.schema.get_field_index(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in keep),
                 pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=schema.fieldNames())

    return pages.mapInArrow(run, schema)

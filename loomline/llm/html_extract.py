"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into flat blocks at the start and end of block-level elements; inline markup and line breaks stay inside.
Each block has its word count and link density, those of the blocks before and after it, and what is known of the elements
around it: whether it stands in the article, whether the page has one, whether an element for page furniture holds it,
how much of a name (class, id, role) around it means page furniture, whether it is a heading. A CART tree tells content
from the rest. It is trained on a small labelled table: the blocks of the pages below, whose texts are given as numbers
of words and marked as content or not. No element or name decides alone; what they are worth is learned.

Character references are decoded, white space inside a block becomes one space, blocks are joined by two line feeds.
Scripts, styles, comments and tags never become text; an unfinished tag at the end is markup. Null html is empty and
gives an empty text, as does a page without content. Pages are read whole. Repeated rows are treated alike; other
columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyspark.sql.types as T
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import chunks, clear_name, in_arrow, without_outputs

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)|</[^>]*+(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: Names that say how a wrapper is laid out, not what it is.
_LAYOUT = re.compile(r"(?<![\w-])(?:has|no|with|without)[-_]+[\w-]+", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_COUNT = re.compile(r"([+-])(\d+)")

#: HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe noembed noframes".split())  # raw text: without an end tag to the page's end
SKIPPED = frozenset("noscript template svg title".split())  # without an end tag, the tag alone
KEPT = frozenset("math xmp".split())  # text alone, as content
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math object q rp rt ruby s samp small span strike strong sub sup svg time tt u var wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FURNITURE = frozenset("head nav header footer aside form button select option fieldset input label dialog menu".split())
MAIN = frozenset("article main".split())
#: Words in class, id or role that name page furniture, and those that name the article.
FURNITURE_NAMES = frozenset(
    """ad ads advert adverts advertisement advertising advertorial sponsor sponsored promo promotion banner side sidebar sidebars aside
    nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments reply replies respond disqus cookie cookies
    consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup social share sharing
    related recommended widget toolbar login search form pagination pager copyright legal skip contentinfo complementary dialog menubar
    disclaimer paywall""".split()
)
#: Names that begin like this count as well (commentlist, sidebarleft), but for commentaries.
FURNITURE_STEMS = ("comment", "advert", "sidebar", "cookie", "newsletter", "breadcrumb", "adsby")
MAIN_NAMES = frozenset("article main".split())

#: Words of a name that say nothing of what the element holds.
NEUTRAL_NAMES = frozenset(
    """area bar block blocks body bottom box btn button buttons card cell col column container content count desktop div el element entry global group holder hot icon icons id inline inner
    item items js large layer left link links list main message middle mobile module new outer page panel part placeholder post posts primary region right row secondary section separator
    site slot small stories tablet text title top unit view wrap wrapper zone user users reader readers visitor recent popular latest sticky fixed""".split()
)
#: The labelled pages: +n are n words of content, -n are n words of the rest.
PAGES = (
    # articles among the furniture of a site
    "<header><a>-2</a><h2>-3</h2></header><nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><article><h1>+8</h1><p>+60<p>+3<p>+110<p>+1<p>+25</article><aside><h3>-2</h3><p>-40<a>-6</a></aside><footer>-12 <a>-2</a></footer>",
    "<nav><a>-1</a><a>-1</a></nav><div class=ad>-9</div><article><h1>+6</h1><p>+1<p>+2<p>+1</article><footer>-14</footer>",
    "<nav><li><a>-4</a><li><a>-1</a></nav><article><p>+1</article><footer>-5</footer>",
    "<main><h1>+5</h1><p>+14<blockquote>+30</blockquote><p>+70<ul><li>+6<li>+2<li>+9</ul><table><tr><td>+1<td>+2<td>+4</table></main><aside>-80</aside>",
    # link bars within an article; links that belong to its text
    "<article><h1>+7</h1><ul><li><a>-1</a><li><a>-1</a><li><a>-2</a></ul><p>+45<p>+30<ul><li><a>-5</a><li><a>-7</a><li><a>-4</a></ul></article>",
    "<article><p>+90<div><a>-1</a></div><div><a>-2</a></div><div><a>-1</a></div><p>+40<p>+2</article>",
    "<article><p>+35<ul><li><a>-9</a><li><a>-12</a><li><a>-8</a><li><a>-15</a></ul></article><footer>-9</footer>",
    "<article><h2><a>+6</a></h2><p>+50<p><a>+8</a><p>+65<p>+20 <a>+9</a><p>+30<h3><a>+3</a></h3><p>+10</article>",
    "<article><p>+28<p><a>+2</a><p>+44<ol><li>+9 <a>+7</a><li>+12 <a>+6</a><li>+8 <a>+5</a></ol></article>",
    "<article><h1><a>+9</a></h1><p>+5 <a>+4</a><p>+80</article>",
    "<main><p>+22<p><a>-1</a> <a>-1</a> <a>-2</a><p><a>-3</a><p><a>-2</a></main>",
    "<article><p>+15<p><a>+5</a><p>+12<p>+9<p><a>+1</a><p>+30<p>+4</article>",
    "<article><h1>+3</h1><p><a>+4</a><p>+8<p><a>+3</a><p>+20<p>+2<p><a>+11</a></article><footer>-3</footer>",
    "<article><p><a>+2</a><p>+6</article>",
    "<article><p>+90<p><a>+6</a><p>+75<p><a>+20</a><p>+120<p><a>+1</a><p>+64</article>",
    "<article><p><a>+12</a></article>",
    "<article><ul><li><a>-2</a><li><a>-1</a></ul><p>+3<p>+7<p><a>-1</a><p><a>-1</a></article>",
    # what stands beside an article
    "<p>-12<div>-50</div><article><h1>+5</h1><p>+30<p>+60</article><div><h3>-4</h3><p>-35<p>-70<p>-2</div>",
    "<div>-1</div><h2>-5</h2><article><p>+1<p>+20</article><p>-100<p>-8 <a>-3</a><div>-25</div>",
    "<main><p>+40<p>+8</main><div><p>-60<p>-15</div><p>-5",
    # furniture within an article
    "<article><h1>+5</h1><p>+40<div class=ad>-6</div><p>+50<aside>-30</aside><p>+9<form><p>-8<input></form><section class=comments><h3>-2</h3><p>-60<p>-25<p>-4</section></article>",
    "<article><p>+70<div class=share-buttons><a>-1</a><a>-1</a></div><div class=newsletter-signup><p>-24</div><p>+33<div id=comment-list><p>-90<p>-12</div><footer>-7</footer></article>",
    "<article><p>+12<div class=advert><p>-2</div><p>+5<div class=cookie-notice>-18</div><p>+20<div class=related-posts><h4>-2</h4><p>-11<p>-13</div></article>",
    "<article><div class=banner>-3</div><p>+25<div role=alert>-1</div><p>+1<div class=sponsored>-120</div><p>+3</article><div class=comments><p>-100<p>-30</div>",
    # names of which only a part means furniture
    "<article><h1>+4</h1><div class=social-policy-report><p>+50<p>+4</div><section id=related-work><p>+80<p>+30<p>+2</section><p>+15</article><div class=related>-20</div>",
    "<article><p class=legal-history>+45<p>+6<div id=search-theory><h2>+3</h2><p>+28<p>+1</div><figure class=header-image><figcaption>+9</figcaption></figure></article>",
    "<div><h1>+6</h1><section class=notice-period><p>+40<p>+60</section><section class=advertising-history><p>+75<p>+22</section></div><div class=sidebar><p>-12</div>",
    # pages without an article
    "<div><a>-1</a></div><div><a>-2</a></div><div><h1>+6</h1><p>+80<p>+30<p>+4<p>+60<p>+1<p>+45</div><div><a>-3</a></div><div><a>-2</a></div><p>-4",
    "<ul><li><a>-1</a><li><a>-1</a><li><a>-3</a></ul><h1>+7</h1><p>+18 <a>+2</a><p>+40<p>+25 <a>+3</a><h2>+2</h2><p>+12<p>+30<p>+100<ul><li><a>-4</a><li><a>-6</a></ul><p>-3",
    "<p>-2<p><a>-1</a><p><a>-2</a><p>+200 <a>+6</a><p>+50<p>+10<p>+70<p><a>-2</a><p>-3<p><a>-1</a>",
    "<div>-2</div><div><a>-2</a></div><h3>-3</h3><div><a>-2</a></div><div>-5 <a>-2</a></div><p>+25 <a>+3</a>",
    "<table><tr><td><a>-2</a><td><a>-1</a></table><p>+30<p>+8<p>+7<p>+12<p>+10<p>+2<p>+40<p>-12 <a>-9</a><p><a>-15</a><p>-9 <a>-16</a>",
    "<nav><a>-1</a></nav><header><h1>-4</h1></header><p>+55<p>+3<p>+30<div class=ad><p>-40</div><p>+60<footer><p>-9</footer><div class=comments><p>-50<p>-8<p>-30</div>",
    "<div><a>-1</a> <a>-1</a></div><div><h1>+2</h1><p>+70<p>+12</div><div><a>-2</a></div>",
    "<h3>-2</h3><ul><li><a>-2</a><li><a>-1</a></ul><h1>+1</h1><p>+40<p>+30<h2>+1</h2><p>+50<p>+9<h3>-3</h3><ul><li><a>-4</a><li><a>-3</a></ul>",
    "<p>+25<p>+18<p>+31",
    "<h1>+5</h1><p>+12",
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    furniture: bool
    heading: bool
    named: tuple[tuple[int, float], ...] = ()
    share: float = 0.0


def _names(attributes: str) -> tuple[set[str], float]:
    """(the words of class, id and role; the share of furniture words in the name that has most of them).

    Words that say nothing don't count, nor do names of layout. A word that begins with a stem counts as furniture.
    """
    found: set[str] = set()
    share = 0.0
    for m in _NAMES.finditer(attributes):
        for name in _LAYOUT.sub(" ", m[1]).strip("\"'").split():
            words = [w.lower() for w in _PARTS.findall(name)]
            known = [w in FURNITURE_NAMES or (w.startswith(FURNITURE_STEMS) and not w.startswith("commentar")) for w in words]
            if any(known):
                share = max(share, sum(known) / sum(k or w not in NEUTRAL_NAMES for w, k in zip(words, known, strict=True)))
            found.update(words)
    return found, share


def blocks(page: str) -> tuple[list[Block], bool]:
    """(flat text blocks in page order, whether the page has an article)."""
    found: list[Block] = []
    stack: list[tuple[str, bool, bool, bool, tuple]] = []  # tag, article, furniture, link, wrappers with names of furniture (number, share): with those around
    wrappers, articles = 0, []  # articles: the wrappers around each
    parts: list[tuple[str, bool]] = []
    heading, at = False, 0

    def text(t: str) -> None:
        if t:
            parts.append((t, bool(stack) and stack[-1][3]))

    def close() -> None:
        """Ends the block at hand, which stands in the elements open now."""
        if not parts:
            return
        whole = html_lib.unescape("".join(p for p, _ in parts)).split()
        linked = len(html_lib.unescape(" ".join(p for p, inside in parts if inside)).split())
        parts.clear()
        if whole:
            _, main, furniture, _, named = stack[-1] if stack else ("", False, False, False, ())
            found.append(Block(" ".join(whole), len(whole), min(linked, len(whole)), main, furniture, heading, named))

    def leave(k: int) -> None:
        del stack[k:]

    while m := _TAG.search(page, at):
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text(" ")
            continue
        ends = bool(m[1] or m[4])
        if tag not in INLINE:
            close()
        if ends:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    leave(k)
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break
            heading = heading and tag not in HEADINGS
            continue
        attributes = m[3] or m[6] or ""
        if tag in RAW or tag in SKIPPED or tag in KEPT:
            if attributes.endswith("/") and tag in ("svg", "math"):
                continue
            over = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if over or tag in RAW or tag == "xmp":
                inner = page[at : over.start() if over else len(page)]
                at = over.end() if over else len(page)
                if tag == "math":
                    text(_TAG.sub("", inner))
                elif tag == "xmp":  # its text is literal
                    text(html_lib.escape(inner))
                    close()
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:  # a paragraph or item ends where the next block begins
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p" or stack[k][0] == tag == "li":
                    leave(k)
                    break
                if stack[k][0] not in INLINE:
                    break
        main, furniture, link, named = stack[-1][1:] if stack else (False, False, False, ())
        names, share = _names(attributes) if attributes and tag not in ("html", "body") else (set(), 0.0)
        is_main = tag in MAIN or bool(names & MAIN_NAMES and tag not in INLINE and not share)
        if tag in HEADINGS:
            heading = True
        if is_main and not furniture:
            articles.append(named)
        # The title's own wrapper inside an article is not page furniture.
        own = (tag in FURNITURE and not (tag == "header" and main)) or bool(attributes and _HIDDEN.search(attributes))
        if share and tag not in MAIN and not (main and names & {"header"} and len(names & FURNITURE_NAMES) == 1):
            wrappers += 1
            named = (*named, (wrappers, share))
        if tag == "label" or tag == "input":
            close()
        if not (attributes.endswith("/") and tag in INLINE):
            stack.append((tag, main or is_main, furniture or own, link or tag == "a", named))
    text(page[at:])
    close()
    return found, _judge(found, articles)


def _judge(found: list[Block], articles: list[tuple]) -> bool:
    """Settles the named share of each block; whether the page has an article outside of wrappers with such names.

    A name says nothing on a wrapper around the page's only articles, or, on a page without any, around over half of
    its words outside of links and furniture elements.
    """
    cleared: set[int] = set()
    if articles and all(articles):
        cleared = {w for around in articles for w, _ in around}
    elif not articles:
        words: Counter = Counter()
        for b in found:
            if not b.furniture:
                words.update(dict.fromkeys((0, *(w for w, _ in b.named)), b.words - b.linked))
        cleared = {w for w, n in words.items() if 2 * n > words[0]}
    for b in found:
        b.share = max((share for w, share in b.named if w not in cleared), default=0.0)
    return any(all(w in cleared or share < 1 for w, share in around) for around in articles)


FEATURES = ("words", "density", "words before", "density before", "words after", "density after", "in the article", "page has an article", "furniture element", "furniture name", "heading")


def features(found: list[Block], has_main: bool) -> np.ndarray:
    if not found:
        return np.zeros((0, len(FEATURES)))
    words = np.array([b.words for b in found], np.float64)
    density = np.array([b.linked for b in found]) / words
    around = lambda x, k: np.concatenate(([0.0], x[:-1])) if k < 0 else np.concatenate((x[1:], [0.0]))
    marks = np.array([[b.main, has_main, b.furniture, b.share, b.heading] for b in found], np.float64)
    return np.column_stack((words, density, around(words, -1), around(density, -1), around(words, 1), around(density, 1), marks))


def labelled(pages=PAGES) -> np.ndarray:
    """The labelled table: a row for each block of the pages, features and then 1 for content."""
    rows = []
    for page in pages:
        found, has_main = blocks(_COUNT.sub(lambda m: " " + ("y " if m[1] == "+" else "n ") * int(m[2]), page))
        rows.append(np.column_stack((features(found, has_main), [b.text[0] == "y" for b in found])))
    return np.concatenate(rows)


class Tree:
    """A CART tree by Gini impurity, grown until its leaves are pure or no split helps. Equal splits: the first feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.content, self.feature = bool(y.mean() > 0.5), None
        if depth == 0 or y.min() == y.max():
            return
        best = (_gini(y) * len(y) - 1e-9, None, None)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= cut
                worth = _gini(y[low]) * low.sum() + _gini(y[~low]) * (~low).sum()
                if worth < best[0] - 1e-12:
                    best = (worth, f, cut)
        if best[1] is None:
            return
        _, self.feature, self.cut = best
        low = x[:, self.feature] <= self.cut
        self.low, self.high = Tree(x[low], y[low], depth - 1), Tree(x[~low], y[~low], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.content)
        if self.feature is not None and len(x):
            low = x[:, self.feature] <= self.cut
            out[low], out[~low] = self.low.predict(x[low]), self.high.predict(x[~low])
        return out


def _gini(y: np.ndarray) -> float:
    p = y.mean()
    return 2 * p * (1 - p)


@cache
def trained(pages=PAGES) -> Tree:
    rows = labelled(pages)
    return Tree(rows[:, :-1], rows[:, -1])


def main_text(page: str, tree: Tree) -> str:
    found, has_main = blocks(page)
    content = tree.predict(features(found, has_main))
    return "\n\n".join(b.text for b, c in zip(found, content, strict=True) if c)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, labelled_pages=PAGES) -> DataFrame:
    """The columns in keep (default: all but the html) with text and n_chars, which replace columns of these names."""
    keep = without_outputs([c for c in pages.columns if c != html_col] if keep is None else keep, ("text", "n_chars"))
    held = clear_name(pages, "html")
    tree = trained(labelled_pages)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, held):
            told = [main_text(t.decode("utf-8", "replace"), tree) for t in texts]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(told, pa.string()), pa.array([len(t) for t in told], pa.int64())], [f.name for f in out])

    out = T.StructType([*[pages.schema[c] for c in keep], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select(*keep, F.col(html_col).alias(held)).transform(in_arrow, work, out)

"""Main text of web pages by maximum-scoring subsequence.

A page becomes a line of tags and runs of words. Words score by where they
stand (the elements around them), tags cost; the weights are log odds learnt
from labelled pages, those that mark their article themselves (one <article>,
<main> or itemprop="articleBody"). One linear scan finds the contiguous region
with the largest sum; the words in it that stand in side matter (menus, forms,
adverts, reader comments) are left out, and the rest is given back block by
block. Names of classes and forms make side matter only while they leave the
article, or the page, its words; elements that hold it are wrappers.

Edge cases: a null or empty page, and a page without words of positive score,
gives an empty text; broken or unclosed markup ends at the end of the page;
repeated rows give equal rows; without labelled pages the built-in prior of
each element stands alone; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import map_rows, smallest, texts_of

TRAIN_PAGES = 2000  # labelled pages that weights are fitted on at most
MOST = 3.0          # bound of a weight
LEFT = 0.1          # share of the words outside side matter below which its names are doubted

# Element names of HTML and common names of side matter.
RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|select|textarea|button|title"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label "
             "mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
SIDE = set("nav header footer aside form menu dialog fieldset head".split())
FORMS = set("form fieldset".split())  # of SIDE, those that may stand around a whole page
MAIN = set("article main".split())
SIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|header"
    r"|masthead|menu|modal|nav\w*|newsletter|notices?|pagination|popup|promo\w*|related|replies"
    r"|respond|share\w*|sharing|sidebar|signup|social|sponsor\w*|subscribe|toolbar|widget\w*)"
    r"(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*>|(?P<text>[^<]+|<)", re.S | re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
BODY = re.compile(r"itemprop\s*=\s*[\"']?articleBody|role\s*=\s*[\"']?main\b", re.I)


class Element:
    """An open tag with its place in the tree. ``wraps`` marks an element that
    looks like side matter by its names, or is a form, but holds the article."""

    __slots__ = ("tag", "names", "parent", "is_main", "soft", "hard", "wraps", "words",
                 "feats", "side", "main")

    def __init__(self, tag: str, names: str, parent: "Element | None", is_main: bool, plain: bool):
        self.tag, self.parent, self.is_main, self.wraps, self.words = tag, parent, is_main, False, 0
        self.names = None if plain else names.lower().split()
        self.hard = tag in SIDE and tag not in FORMS and not (tag == "header" and parent.main)
        self.soft = tag in FORMS or (bool(names) and not is_main and tag not in ("body", "html")
                                     and SIDE_NAMES.search(names) is not None)

    def up(self):
        at = self
        while at is not None:
            yield at
            at = at.parent

    def side_names(self) -> tuple:
        found = {re.sub(r"\d+", "", n) for n in self.names or () if SIDE_NAMES.search(n)}
        return (self.tag in FORMS, *sorted(found))

    def plainly_side(self) -> bool:
        """Named by a listed word alone ("comments"), not by one among others
        ("has-sidebar")."""
        return any(SIDE_NAMES.fullmatch(n) for n in self.names or ())

    def own(self) -> tuple:
        """Features; side names tell nothing of a wrapper, a body or an article."""
        if self.names is None:
            return ()
        names = self.names
        if self.wraps or self.is_main or self.tag in ("body", "html"):
            names = [n for n in names if not SIDE_NAMES.search(n)]
            if self.wraps and self.tag in FORMS:
                return ()
        return tuple(f"{self.tag}.{n}" for n in names) or (self.tag,)

    def settle(self) -> None:
        """Features, side and main from those of the parent."""
        up = self.parent
        self.feats = up.feats + self.own()
        self.side = up.side or self.hard or (self.soft and not self.wraps)
        self.main = up.main or self.is_main


def settle_all(elements: list[Element]) -> None:
    for e in elements[1:]:
        e.settle()


def find_wrappers(elements: list[Element]) -> None:
    """Names are no veto: where they leave hardly a word of the article, or of
    the page, the elements that hold it are wrappers and not side matter."""
    if not any(e.soft for e in elements):
        return
    total, free = {}, {}  # words below an element: outside hard side matter, and of these not side
    hard = {elements[0]: False}
    for e in elements[1:]:
        hard[e] = hard[e.parent] or e.hard

    def count() -> None:
        for e in elements:
            total[e] = 0 if hard[e] else e.words
            free[e] = 0 if e.side else e.words
        for e in reversed(elements[1:]):
            total[e.parent] += total[e]
            free[e.parent] += free[e]

    count()
    mains = [e for e in elements if e.is_main and total[e] and not SIDE_NAMES.search(" ".join(e.names))]
    if mains and not any(free[e] >= LEFT * total[e] for e in mains):
        for e in mains:
            for x in e.parent.up():
                x.wraps = x.soft or x.wraps
        settle_all(elements)
        count()
    root = elements[0]
    while free[root] < LEFT * total[root]:  # each turn marks an element more
        outer = [e for e in elements if e.soft and not e.wraps and not e.parent.side and total[e]
                 and (not free[root] or not e.plainly_side())]
        if not outer:
            break
        names = max(outer, key=lambda e: total[e]).side_names()
        for e in elements:
            if e.soft and e.side_names() == names:
                e.wraps = True
        settle_all(elements)
        count()


def walk(page: str) -> list[tuple]:
    """The page as (text, where, tag, side, main): a run of words has its text
    and the features of the elements around it, a tag its name and None."""
    root = Element("", "", None, False, True)
    root.feats, root.side, root.main = (), False, False
    found: list[tuple] = []
    stack, elements = [root], [root]
    for m in TOKEN.finditer(page):
        text = m["text"]
        top = stack[-1]
        if text is not None:
            found.append((text, top, None))
            top.words += len(text.split())
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        found.append((None, top, tag))
        if m["close"]:
            at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if at:
                del stack[at:]
            continue
        attrs = m["attrs"]
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in ("p", "li") and top.tag == tag:  # the end tag may be left out
            stack.pop()
            top = stack[-1]
        plain = tag in INLINE and "class" not in attrs and "id" not in attrs
        names = " ".join(x for t in NAMES.findall(attrs) for x in t if x) if attrs and not plain else ""
        is_main = not plain and (tag in MAIN or bool(attrs and BODY.search(attrs)))
        stack.append(Element(tag, names, top, is_main, plain))
        elements.append(stack[-1])
        stack[-1].settle()
    find_wrappers(elements)
    return [(text, e.feats, tag, e.side, e.main) for text, e, tag in found]


def prior(feature: str) -> float:
    """Weight of an element that no labelled page has."""
    tag, _, name = feature.partition(".")
    if tag in SIDE or (name and SIDE_NAMES.search(name)):
        return -1.0
    return 1.0 if tag in MAIN else 0.0


def fit(pages: list[str]) -> dict[str, float]:
    """Log odds of lying in the article: of words, by each element around
    them, and of tags ("<name")."""
    inside, outside = Counter(), Counter()
    for page in pages:
        for text, feats, tag, side, main in walk(page):
            to = inside if main and not side else outside
            if text is None:
                to["<" + tag] += 1
            else:
                n = len(text.split())
                for f in set(feats):
                    to[f] += n
                to[""] += n
    return {f: max(-MOST, min(MOST, math.log((inside[f] + 0.5) / (outside[f] + 0.5))))
            for f in inside | outside}


def scored(tokens: list[tuple], weights: dict[str, float]) -> list[float]:
    """Score of every token: words by the most telling elements around them
    (1 each where nothing is known), tags by their cost."""
    memo: dict[tuple, float] = {}
    out = []
    for text, feats, tag, side, main in tokens:
        if text is None:
            out.append(min(-0.05, 0.1 * weights.get("<" + tag, 0.0)))
            continue
        n = len(text.split())
        if n and feats not in memo:
            known = [weights.get(f, prior(f)) for f in feats]
            memo[feats] = max(-MOST, min(MOST, 0.5 + min(known, default=0) + max(known, default=0)))
        w = memo[feats] if n else 0.0
        if side:  # side matter never adds; inside an article it hardly parts it
            w = -0.02 if main else min(w, -1.0)
        out.append(n * w)
    return out


def best_region(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the contiguous run with the largest sum; the first of
    equals; empty without a positive score."""
    best, top, total, start = (0, 0), 0.0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > top:
            top, best = total, (start, i + 1)
    return best


def extract(page: str, weights: dict[str, float]) -> str:
    """The text of the best region: blocks joined by an empty line."""
    tokens = walk(page)
    start, end = best_region(scored(tokens, weights))
    blocks: list[str] = []
    parts: list[str] = []
    for text, _, tag, side, _ in tokens[start:end]:
        if text is not None:
            if not side:
                parts.append(text)
        elif tag == "br":
            parts.append(" ")
        elif tag not in INLINE:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n\n".join(b for b in clean if b)


def fit_pages(pages: DataFrame) -> dict[str, float]:
    """Weights from at most TRAIN_PAGES labelled pages, those whose markup
    names one article; those with the smallest hash of the row."""
    labelled = pages.where("html rlike '(?i)<(article|main)[ >]|itemprop=.?articleBody'")
    rows = smallest(labelled.select("html", F.xxhash64("page_id", "url", "html").alias("h")),
                    TRAIN_PAGES)
    return fit([r.html for r in rows.select("html").collect()])


def main_text(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """All columns of ``pages`` but ``html``, then ``text`` and ``n_chars``."""
    if weights is None:
        weights = fit_pages(pages)

    def run(part: pa.RecordBatch) -> dict:
        found = [extract(p, weights) for p in texts_of(part, "html")]
        return {"text": found, "n_chars": [len(t) for t in found]}

    return map_rows(pages, run, "text string, n_chars long", column="html")


def op6_html_extraction(pages: DataFrame) -> DataFrame:
    return main_text(pages.select("page_id", "url", "html"))

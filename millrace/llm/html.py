"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks of text wherever a block-level tag begins or ends. A block is described by its
number of words and its link density (share of words inside links), by the same of the blocks before and
behind it, and by its surroundings: how firmly a container says that it stands beside the article (by its
element, or by a name as of a menu, an advert, comments ...), how much of the page that container holds, and
whether the block is in an article or main element. A small decision tree, trained on the labelled table
below, tells main text from the rest. A name alone decides nothing: a wrapper of the whole page may have any.

Pages are read in time proportional to their length, however broken they are.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import rows, small_batches

FEATURES = ("words", "links", "words_before", "links_before", "words_behind", "links_behind", "beside", "share", "article")

#: Labelled blocks: words, link density in per cent, the same of the block before and of the block behind; how firmly a
#: container says that it is beside the article (0 not at all, 1 by a name that wrappers have too, 2 by a plain name, 3 by
#: its element), what share of the page's words it holds in per cent; 1 in an article; then 1 for main text.
LABELLED = """
6 100 0 0 3 100 3 6 0 0
3 100 6 100 5 100 3 6 0 0
1 100 4 100 8 0 3 6 0 0
8 0 1 100 9 0 3 6 0 0
30 0 8 0 60 0 3 6 0 0
120 2 60 0 80 0 3 6 0 0
45 0 30 5 3 0 3 6 1 0
9 0 80 0 70 0 3 6 1 0
2 0 200 0 12 0 3 6 1 0
70 0 3 0 20 0 3 6 1 0
14 60 90 0 20 50 3 6 1 0
7 0 150 0 0 0 3 6 0 0
12 10 90 0 0 0 3 6 0 0
200 0 90 0 2 0 3 6 0 0
4 0 0 0 5 0 3 6 0 0
9 0 8 0 40 0 0 0 1 1
8 0 20 0 35 0 0 0 1 1
40 0 9 0 80 0 0 0 1 1
120 3 40 0 90 0 0 0 1 1
1 0 90 0 120 0 0 0 1 1
1 0 60 0 7 0 0 0 1 1
2 0 110 0 1 0 0 0 1 1
3 0 9 0 4 0 0 0 1 1
25 20 60 0 40 5 0 0 1 1
300 1 8 0 9 0 0 0 1 1
15 35 70 0 70 0 0 0 1 1
5 0 5 0 0 0 0 0 1 1
60 0 1 0 12 0 0 0 1 1
5 100 100 0 6 100 0 0 1 0
6 100 5 100 7 100 0 0 1 0
8 90 6 100 40 0 0 0 1 0
12 80 12 75 3 0 0 0 1 0
2 100 70 0 8 0 0 0 1 0
40 0 9 0 70 0 0 0 0 1
90 4 40 0 60 2 0 0 0 1
150 0 10 0 12 0 0 0 0 1
60 10 3 0 90 0 0 0 0 1
35 0 80 0 6 0 0 0 0 1
20 0 50 0 70 0 0 0 0 1
16 5 45 0 55 0 0 0 0 1
6 0 45 0 120 0 0 0 0 1
4 0 90 0 60 0 0 0 0 1
8 0 3 100 70 0 0 0 0 1
7 0 5 0 40 0 0 0 0 1
3 0 60 0 50 0 0 0 0 1
42 0 42 0 0 0 0 0 0 1
90 2 60 0 0 0 0 0 0 1
25 0 30 0 0 0 0 0 0 1
60 0 0 0 0 0 0 0 0 1
8 0 9 0 5 0 0 0 1 1
12 0 20 0 6 0 0 0 1 1
9 0 0 0 5 0 0 0 1 1
7 0 30 0 0 0 0 0 1 1
5 0 40 0 5 0 0 0 1 1
4 0 5 0 6 0 0 0 1 1
11 0 100 0 2 0 0 0 1 1
30 0 20 0 5 100 0 0 1 1
8 0 9 0 4 100 0 0 1 1
15 10 40 0 5 100 0 0 1 1
2 0 60 0 3 100 0 0 1 1
80 2 40 0 6 100 0 0 0 1
45 0 30 0 3 100 0 0 0 1
7 0 80 0 5 0 0 0 0 0
9 0 30 0 6 0 0 0 0 0
5 0 4 0 6 0 0 0 0 0
4 0 3 100 5 0 0 0 0 0
7 0 2 0 3 100 0 0 0 0
3 0 90 0 4 100 0 0 0 0
6 0 60 0 0 0 0 0 0 0
9 0 7 0 5 0 0 0 0 0
4 100 5 100 3 100 0 0 0 0
10 90 4 100 60 0 0 0 0 0
14 70 12 80 11 90 0 0 0 0
40 85 14 70 20 90 0 0 0 0
2 100 40 0 50 0 0 0 0 0
5 60 4 50 6 70 0 0 0 0
8 50 60 0 4 60 0 0 0 0
6 0 30 0 8 0 2 3 0 0
25 0 9 0 30 0 2 12 0 0
40 0 6 0 35 0 2 30 0 0
80 0 5 0 60 0 2 45 1 0
30 0 25 0 0 0 2 70 0 0
60 2 40 0 50 0 2 80 0 0
12 0 90 0 70 0 2 2 1 0
9 0 0 0 12 0 1 4 0 0
14 0 60 0 40 0 1 3 1 0
5 100 0 0 60 0 1 2 0 0
20 5 8 0 90 0 1 10 0 0
35 0 60 0 6 0 1 20 0 0
50 0 5 0 30 0 1 35 1 0
8 0 0 0 60 0 1 90 0 1
60 0 8 0 45 0 1 90 0 1
45 3 60 0 50 0 1 100 0 1
9 0 12 0 0 0 1 100 0 1
120 0 9 0 8 0 1 75 0 1
30 0 4 0 9 0 1 100 1 1
40 4 30 0 30 0 1 85 1 1
6 100 5 100 5 100 1 90 0 0
4 100 60 0 8 0 1 100 0 0
30 0 20 0 60 0 3 70 0 0
90 0 60 0 20 0 3 80 1 0
"""

#: Elements whose content is no text of the page.
SILENT = frozenset("script style noscript template svg annotation annotation-xml textarea select button option iframe object canvas audio video head title".split())
#: Those whose content is no markup, and what ends it.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe")}
#: Elements that stand in a head; any other one, or text, ends a head whose end tag is left out.
HEAD = frozenset("base basefont bgsound head html link meta noscript script style template title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that run on within a block of text.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr"
    " math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics annotation annotation-xml".split()
)
#: Elements that a tag of the same group ends, if they are still open in the same container.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
HOLDERS = frozenset("html body div section article main nav aside header footer form ul ol dl table blockquote figure dialog details fieldset menu".split())
BESIDE = frozenset("nav aside footer menu dialog".split())
#: Words in class, id or role by which a container names itself as something beside the article.
PLAIN = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored cookie cookies consent popup popups nav navbar navigation menu menus breadcrumb breadcrumbs sidebar sidebars sidenav aside"
    " footer footers copyright comment comments replies reply respond disqus discussion share sharing social related recommended recommendations newsletter subscribe subscription signup login pagination pager contentinfo complementary".split()
)
#: Those that wrappers of articles have as well.
LOOSE = frozenset("header headers masthead banner banners promo promos promotion notice notices alert alerts modal modals overlay rail widget widgets foot legal search skip toolbar tags".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
QUOTED = re.compile(r"""=\s*(["'])""")
#: An attribute with its value, quoted or not.
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
#: Elements whose names count: those that hold others. Names of headings, paragraphs and list items say nothing of what they hold.
CONTAINERS = HOLDERS | {"form"}
#: Names of sections of an article that count in their ids, too: other ids are made from headings.
READERS = frozenset("comment comments reply replies respond disqus".split())
#: Elements whose text is prose wherever it stands, if a page has neither an article nor a main element.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption".split())
HEADINGS = frozenset("h2 h3 h4 h5 h6".split())
SPACES = re.compile(r"\s+")
WORDS = re.compile(r"\S+")
#: A named container is taken for a wrapper, whatever its name, if it holds an article, main or h1 element and more than this share of the page's words.
WRAPPER = 0.6


class Tree:
    """A binary decision tree for numbers, grown by Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1):
        self.root = self._grow(np.asarray(x, float), np.asarray(y, int), depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int):
        if depth == 0 or len(set(y.tolist())) < 2:
            return int(y.mean() >= 0.5) if len(y) else 0
        gini = lambda v: len(v) * 2 * v.mean() * (1 - v.mean()) if len(v) else 0.0
        best = (gini(y) - 1e-9, -1, 0.0)
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] < cut
                if min(left.sum(), (~left).sum()) >= least:
                    best = min(best, (gini(y[left]) + gini(y[~left]), f, float(cut)))
        _, f, cut = best
        if f < 0:
            return int(y.mean() >= 0.5)
        left = x[:, f] < cut
        return f, cut, self._grow(x[left], y[left], depth - 1, least), self._grow(x[~left], y[~left], depth - 1, least)

    def __call__(self, row) -> int:
        node = self.root
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] < node[1] else node[3]
        return node


@lru_cache(maxsize=1)
def default_tree() -> Tree:
    table = np.array([line.split() for line in LABELLED.split("\n") if line], float)
    return Tree(table[:, :-1], table[:, -1])


def tags(page: str) -> Iterator[tuple[int, int, bool, str, str]]:
    """Tags, comments and declarations in order: begin, end, whether an end tag, name in lower case ('' for comments), attributes.

    A caller may send the place from which to go on. Every search goes forward, and one that fails isn't made again.
    """
    place, last, unclosed = 0, len(page), set()
    while 0 <= (begin := page.find("<", place)) < last:
        m = NAME.match(page, begin)
        if m:
            at = m.end()
            while True:
                end = page.find(">", at) if ">" not in unclosed else -1
                if end < 0:
                    unclosed.add(">")
                    break
                quote = QUOTED.search(page, at, end)
                if not quote:
                    break
                shut = page.find(quote[1], quote.end()) if quote[1] not in unclosed else -1
                if shut < 0:
                    unclosed.add(quote[1])
                    break
                at = shut + 1
            stop = end + 1 if end >= 0 else last
            found = (begin, stop, bool(m[1]), m[2].lower() if end >= 0 else "", page[m.end() : max(end, m.end())] if end >= 0 else "")
        elif page.startswith(("<!", "<?"), begin):
            end = page.find("-->", begin + 4) + 3 if page.startswith("<!--", begin) else page.find(">", begin) + 1
            stop = end if end > 2 else last
            found = (begin, stop, False, "", "")
        else:
            place = begin + 1
            continue
        place = (yield found) or stop


def strength(tag: str, attributes: str, in_article: bool) -> int:
    """How firmly an element says that it stands beside the article."""
    if tag in BESIDE or tag == "header" and not in_article:
        return 3
    if not attributes or tag in ("html", "body"):
        return 2 * (tag == "form")
    names, ids = set(), set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and NO_DISPLAY.search(value):
            return 3
        if name in ("class", "role", "id"):
            (ids if name == "id" else names).update(w.lower() for w in PARTS.findall(value))
    if tag == "form":
        return 2
    if tag not in CONTAINERS:
        return 0
    names |= ids & READERS if in_article and tag == "section" else ids
    return 2 if names & PLAIN else int(not names.isdisjoint(LOOSE) and not (in_article and names & LOOSE <= {"header", "headers"}))


class Containers:
    """Containers that say they stand beside the article, in the order of their beginning. The first is the page."""

    def __init__(self):
        self.parent, self.strength, self.words, self.holds = [0], [0], [0], [False]

    def open(self, within: int, strength: int) -> int:
        self.parent.append(within)
        self.strength.append(strength)
        self.words.append(0)
        self.holds.append(False)
        return len(self.parent) - 1

    def told(self) -> list[tuple[int, int]]:
        """Of each: the greatest strength of it and those around it, and the share of the page that the outermost of that strength holds."""
        words, holds = self.words[:], self.holds[:]
        for i in range(len(words) - 1, 0, -1):
            words[self.parent[i]] += words[i]
            holds[self.parent[i]] |= holds[i]
        out = [(0, 0)]
        for i in range(1, len(words)):
            share = words[i] / (words[0] or 1)
            void = self.strength[i] < 3 and holds[i] and share > WRAPPER
            around = out[self.parent[i]]
            out.append(around if void or self.strength[i] <= around[0] else (self.strength[i], round(100 * share)))
        return out


def blocks(page: str) -> list[tuple[str, int, int, int, int, int, str]]:
    """The text blocks of a page in order: text, words, words in links, beside, share, article, innermost block element ('' for none)."""
    out: list[tuple[str, int, int, int, int, str]] = []
    stack: list[tuple[str, int, int, int, str]] = []  # tag, container, article, links around, block element
    still: Counter = Counter()  # open tags
    within = Containers()
    parts: list[str] = []
    linked = links = inside = article = at = 0
    block = ""

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = SPACES.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                words = len(WORDS.findall(text))
                within.words[inside] += words - min(linked, words)
                out.append((text, words, min(linked, words), inside, article, block))
            parts, linked = [], 0

    def shut(i: int) -> None:
        nonlocal inside, article, links, block
        still.subtract(s[0] for s in stack[i:])
        del stack[i:]
        inside, article, links, block = stack[-1][1:] if stack else (0, 0, 0, "")

    silent = around = None  # around: a head that goes on behind a silent element in it
    walk, go = tags(page), None
    while True:
        try:
            begin, stop, end, tag, attributes = walk.send(go)
        except StopIteration:
            break
        go = None
        text = page[at:begin]
        if silent == "head" and text.strip():
            silent = None
        if silent is None and text:
            parts.append(text)
            if links:
                linked += len(WORDS.findall(text))
        at = stop
        if not tag:
            continue
        whole = attributes.endswith("/")
        if not end and not whole and silent != "svg" and (raw := RAW.get(tag)):
            closing = raw.search(page, stop)
            go = closing.start() if closing else len(page)
        if silent == "head":
            if tag in ("body", "html", "br") if end else tag not in HEAD:
                silent = None
            elif not end and tag in SILENT and tag != "head" and not whole:
                silent, around = tag, "head"
                continue
        if silent is not None:
            if end and tag == silent:
                silent, around = around, None
            continue
        if tag in SILENT:
            if not end and not whole:
                if tag not in INLINE:
                    flush()
                silent = tag
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if end:
            for i in range(len(stack) - 1, -1, -1) if still[tag] else ():
                if stack[i][0] == tag:
                    shut(i)
                    break
                if tag in INLINE and stack[i][0] in HOLDERS:
                    break
            continue
        closes = ENDS.get(tag) or (("p",) if tag not in INLINE else ())
        for i in range(len(stack) - 1, -1, -1) if any(still[c] for c in closes) else ():
            if stack[i][0] in HOLDERS:
                break
            if stack[i][0] in closes:
                shut(i)
                break
        if whole and tag in INLINE:
            continue
        if tag in ("article", "main", "h1"):
            within.holds[inside] = True
        firm = strength(tag, attributes, bool(article))
        inside, article, links = within.open(inside, firm) if firm else inside, int(article or tag in ("article", "main")), links + (tag == "a")
        block = block if tag in INLINE else tag
        stack.append((tag, inside, article, links, block))
        still[tag] += 1
    if at < len(page) and (silent is None or silent == "head" and page[at:].strip()):
        parts.append(page[at:])
    flush()
    told = within.told()
    return [(text, words, in_links, *told[c], in_article, element) for text, words, in_links, c, in_article, element in out]


def main_text(page: str | None, tree: Tree | None = None) -> str:
    """The blocks that the tree takes for main text.

    Where a page has neither an article nor a main element, paragraphs, headings, lists and cells count as in one, and
    so does a page without block elements. Links that make up a list behind a heading of an article are its sources:
    they count as words."""
    tree, found = tree or default_tree(), blocks(page or "")
    marked = any(b[5] for b in found)
    bare = not any(b[6] not in ("", "html", "body") for b in found)
    density = []
    sources = False  # whether a list goes on that began behind a heading of the article
    for i, b in enumerate(found):
        sources = b[6] == "li" and bool(b[5]) and not b[3] and (sources or i > 0 and found[i - 1][6] in HEADINGS and not found[i - 1][2])
        density.append(100 * b[2] / b[1] if b[1] and not sources else 0)
    kept = []
    for i, (text, words, _, beside, share, article, element) in enumerate(found):
        before = (found[i - 1][1], density[i - 1]) if i else (0, 0)
        behind = (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0)
        if tree((words, density[i], *before, *behind, beside, share, article or int(not marked and (bare or element in PROSE)))):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """A row per page: page_id, url, text, n_chars. A null or empty page gives an empty text; repeated rows and null keys
    stay; an empty table gives none."""
    tree = default_tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "html", 4 << 20):
            texts = [main_text(h, tree) for (h,) in rows(b, "html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    ready = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    return ready.mapInArrow(run, "page_id long, url string, text string, n_chars long")

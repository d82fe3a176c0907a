"""Main text of web pages: flat text blocks, classified by a decision tree.

A page is cut into blocks at block-level tags. A block is described by its words and the
share of them inside links, by the same of the blocks before and after it, and by the
kind of element around it. A decision tree grown here from a small labelled table
says which blocks belong to the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# --- fixed values: element and attribute names ----------------------------------
#: Elements whose content never is text of the page.
SILENT = "script style template svg math iframe object textarea select noscript title canvas audio video".split()
#: Of these, the ones that are empty when their tag ends in "/>".
FOREIGN = "svg math".split()
#: Elements that begin and end a block.
BLOCK = (
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td"
    " tfoot th thead tr ul button"
).split()
#: Elements that hold page furniture.
FURNITURE = "nav footer aside form menu button dialog head".split()
#: Elements that hold the article.
ARTICLE = "article main".split()
#: Elements that may hold either; their class, id and role say which.
CONTAINER = "div section header ul ol dl table td blockquote figure center details fieldset".split()
#: Words in a name that make a header one of the article.
OF_ARTICLE = "article content entry post story title".split()
#: Words of class, id and role attributes that name page furniture.
NAMES = (
    "ad ads adv advert advertisement advertising alert announcement author-box banner breadcrumb breadcrumbs byline-links"
    " comment comments consent contentinfo complementary cookie cookies copyright dialog disclaimer disqus feedback footer"
    " form gdpr header login masthead menu modal nav navbar navigation newsletter notice notices notification pager"
    " pagination paywall popup promo promoted promotion recommended related reply replies respond search share sharing"
    " sidebar signup skip social sponsor sponsored subscribe subscription tags teaser toc toolbar widget widgets"
).split()

#: Words that turn a furniture word right after them, or at the end of a name they begin, into one of layout or topic.
LAYOUT = "has no not with without hide hides category cat tag".split()
#: Furniture words whose elements hold articles of their own beside the page's one.
SECONDARY = (
    "ad ads adv advert advertisement advertising comment comments complementary disqus feedback promo promoted promotion"
    " recommended related reply replies respond sponsor sponsored teaser"
).split()
#: The same of elements.
SECONDARY_ELEMENTS = "nav footer aside".split()

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:" + "|".join(FOREIGN) + r")(?=[\s/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"
    r"|<(" + "|".join(SILENT) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?", re.S)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_BLOCK, _FURNITURE, _ARTICLE, _NAMES = (frozenset(x) for x in (BLOCK, FURNITURE, ARTICLE, NAMES))
_LAYOUT, _SECONDARY, _SECONDARY_ELEMENTS = (frozenset(x) for x in (LAYOUT, SECONDARY, SECONDARY_ELEMENTS))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_HELD = frozenset(CONTAINER) | _FURNITURE | _ARTICLE


@dataclass
class Block:
    """A stretch of text without a block border, with the words in links and what is around it."""

    text: str
    words: int
    linked: int
    furniture: bool
    article: bool
    heading: bool


def _attributes(raw: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated attribute the first counts, as in browsers."""
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), double or single or bare)
    return found


def _furniture_words(attributes: dict[str, str], in_article: bool) -> set[str]:
    """The furniture words that class, id and role begin or end with, or are."""
    found: set[str] = set()
    for attribute in ("class", "id", "role"):
        for name in attributes.get(attribute, "").split():
            parts = [p.lower() for p in _WORDS.findall(name)]
            if not parts:
                continue
            if parts[-1] == "header" and (in_article or any(p in OF_ARTICLE for p in parts)):
                continue
            words = {parts[0], "-".join(parts)}
            if not (parts[0] in _LAYOUT or _LAYOUT.intersection(parts[-2:-1])):
                words.add(parts[-1])
            found |= words & _NAMES
    return found


def _hides(attributes: dict[str, str]) -> bool:
    hidden = attributes.get("hidden")
    return (
        (hidden is not None and not hidden.lower().startswith(("false", "until")))
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NO_DISPLAY.search(attributes.get("style", "")))
    )


class _Page:
    """Where in a page the reading stands."""

    def __init__(self):
        self.found: list[Block] = []
        self.held: list[tuple[str, tuple]] = []  # open element, and what held before it
        self.hidden = self.article = self.in_article = self.paragraph = self.heading = self.in_link = False
        self.around = -1  # the innermost open furniture element
        self.outer: list[int] = []  # of each furniture element the one around it
        self.secondary: list[bool] = []
        self.articles: list[tuple[int, bool]] = []  # where articles and mains are; True for an article
        self.places: list[int] = []  # and where the blocks are
        self._parts: list[str] = []
        self._links: list[str] = []

    def text(self, raw: str) -> None:
        if raw:
            self._parts.append(raw)
            if self.in_link:
                self._links.append(raw)

    def border(self) -> None:
        """A block ends here, and with it a paragraph."""
        if self._parts:
            text = " ".join(html.unescape("".join(self._parts)).split())
            if text:
                words = text.count(" ") + 1
                linked = len(html.unescape(" ".join(self._links)).split()) if self._links else 0
                furniture = self.hidden or self.paragraph
                self.places.append(self.around)
                self.found.append(Block(text, words, min(linked, words), furniture, self.article, self.heading))
            self._parts, self._links = [], []
        self.paragraph = self.heading = self.in_link = False

    def opens(self, name: str, raw: str) -> None:
        attributes = _attributes(raw) if raw else {}
        words, hidden = _furniture_words(attributes, self.article), _hides(attributes)
        element = name in _FURNITURE or (name == "header" and not self.article)
        self.heading = name in _HEADINGS
        if name not in _HELD:
            self.paragraph = element or bool(words) or hidden
        elif not raw.endswith("/"):
            self.held.append((name, (self.around, self.hidden, self.article, self.in_article)))
            self.hidden |= hidden
            if element or words:
                self.outer.append(self.around)
                self.secondary.append(name in _SECONDARY_ELEMENTS or bool(words & _SECONDARY))
                self.around = len(self.outer) - 1
            elif name in _ARTICLE and not self.hidden and not self.in_article:
                self.articles.append((self.around, name == "article"))
                self.in_article = name == "article"
            self.article |= name in _ARTICLE

    def closes(self, name: str) -> None:
        """The innermost open element of this name ends, and all that are open inside it."""
        for i in range(len(self.held) - 1, -1, -1):
            if self.held[i][0] == name:
                self.around, self.hidden, self.article, self.in_article = self.held[i][1]
                del self.held[i:]
                return

    def settle(self) -> None:
        """What holds the page's article is no furniture.

        Neither is what may hold other articles, such as comments, if no article is outside of it and
        its own are longer than what is left. Articles that are named furniture don't count.
        """
        holds = [False] * len(self.outer)
        for where, _ in self.articles:
            if where >= 0:
                holds[where] = True
        for i in range(len(holds) - 1, -1, -1):
            if holds[i] and self.outer[i] >= 0:
                holds[self.outer[i]] = True
        shut = self._shut(not h or s for h, s in zip(holds, self.secondary))
        if any(holds) and not any(own and (where < 0 or not shut[where]) for where, own in self.articles):
            freed, left, more = self._shut(not h for h in holds), 0, 0
            for block, where in zip(self.found, self.places):
                if block.article and not block.furniture:
                    if where < 0 or not shut[where]:
                        left += block.words
                    elif not freed[where]:
                        more += block.words
            shut = freed if more > left else shut
        for block, where in zip(self.found, self.places):
            block.furniture |= where >= 0 and shut[where]

    def _shut(self, stays: Iterable[bool]) -> list[bool]:
        """Whether each furniture element, or one around it, stays furniture."""
        shut: list[bool] = []
        for own, outer in zip(stays, self.outer):
            shut.append(own or (outer >= 0 and shut[outer]))
        return shut


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order. White space in a block is one space; character references are decoded."""
    state, at = _Page(), 0
    for match in _TAG.finditer(page):
        state.text(page[at : match.start()])
        at = match.end()
        name = (match.group(3) or "").lower()
        if name == "br":
            state.text(" ")
        elif name == "a":
            state.in_link = not match.group(2)
        elif name in _BLOCK or name in _HELD:
            state.border()
            if match.group(2):
                state.closes(name)
            else:
                state.opens(name, match.group(4))
    state.text(page[at:])
    state.border()
    state.settle()
    return state.found


FEATURES = (
    "words", "linked", "words_before", "linked_before", "words_after", "linked_after",
    "furniture", "article", "heading", "page_has_article",
)

#: Labelled blocks: the features in order (shares of linked words in percent), then 1 for main text.
LABELLED = """
  1 100   0   0   1 100 1 0 0 1 0
  2 100   1 100   3 100 1 0 0 1 0
  8   0   1 100  12   0 1 0 0 1 0
 40   0   9   0  35   0 1 0 0 1 0
 60   5  70   0  50  10 1 1 0 1 0
  4   0  50   0   0   0 1 0 0 1 0
  9  10  80   0   0   0 1 0 0 0 0
 25   0  30   0  22   0 1 0 0 0 0
  1 100   2 100   0   0 1 1 0 1 0
  5   0   0   0  90   0 1 0 1 1 0
  9   0   8   0  60   0 0 1 1 1 1
  6   0   1 100  45   0 0 1 1 1 1
  3   0   5   0   2   0 0 1 1 1 1
 60   0   9   0  80   0 0 1 0 1 1
 80   2  60   0  15   0 0 1 0 1 1
 15   0  80   0   4   0 0 1 0 1 1
  4   0  15   0   1   0 0 1 0 1 1
  1   0   4   0  33   0 0 1 0 1 1
  1   0   1   0   0   0 0 1 0 1 1
  2   0   1 100   9   0 0 1 0 1 1
 33   0   1   0   9   0 0 1 0 1 1
 12  60  33   0  20   0 0 1 0 1 1
 20 100  12  60  10   0 0 1 0 1 1
  2   0  70   0  90   0 0 1 1 1 1
150   0   2   0 120   8 0 1 0 1 1
  7   0 120   0   0   0 0 1 0 1 1
 10   0  60   0   5   0 0 0 0 1 0
 30   0   4   0  12   0 0 0 0 1 0
  2 100   3 100   2 100 0 0 0 1 0
  5   0   1 100   9   0 0 0 0 1 0
  3   0  40   0   2 100 0 0 1 1 0
 70   0   5   0  60   0 0 0 0 1 0
  1 100   0   0   1 100 0 0 0 0 0
  2 100   1 100   2 100 0 0 0 0 0
  3 100   2 100  40   0 0 0 0 0 0
  4  75   2 100   3 100 0 0 0 0 0
 12  90   3 100  11  95 0 0 0 0 0
 15  70  14  80  12  60 0 0 0 0 0
  3   0   2 100   2 100 0 0 0 0 0
  4   0   1 100   3 100 0 0 0 0 0
  6   0   2 100   0   0 0 0 0 0 0
  5  20   3  60   0   0 0 0 0 0 0
  2   0   0   0   1 100 0 0 0 0 0
  8   0   2 100   5  40 0 0 0 0 0
  5   0   0   0  60   0 0 0 1 0 1
  7   0   3 100  45   0 0 0 1 0 1
  4   0  60   0  70   0 0 0 1 0 1
  3   0  90   0   2 100 0 0 1 0 0
  2   0   3 100   2 100 0 0 1 0 0
 45   0   7   0  60   0 0 0 0 0 1
 60   5  45   0  80   0 0 0 0 0 1
 25   0   6   0  30   0 0 0 0 0 1
 90  12  30   0  20   4 0 0 0 0 1
 20   4  90  12   5   0 0 0 0 0 1
  6   0  60   0  55   0 0 0 0 0 1
  2   0  50   0  40   0 0 0 0 0 1
  9   0  25   0  31   0 0 0 0 0 1
 14   0  40   0   2 100 0 0 0 0 1
 18  30  40   0  60   0 0 0 0 0 1
 30  45  60   0  50   0 0 0 0 0 1
 12   0   0   0  15   0 0 0 0 0 1
 16   0  12   0   0   0 0 0 0 0 1
 11   0   0   0   0   0 0 0 0 0 1
 14   0   3 100  14 100 1 0 0 1 0
 14   0  40   0  14 100 1 1 0 1 0
 35   0   6   0   3 100 1 0 0 0 0
 60   0   6 100   5 100 1 0 0 1 0
  3   0   2 100   4 100 1 0 1 0 0
 22   0   8  50  30   0 1 0 0 1 0
  9   0   3 100  60   0 1 1 1 1 0
 45   0  50   0   3 100 0 1 0 1 1
  5   0  30   0   2 100 0 1 0 1 1
 14   0  60   0   4 100 0 1 0 1 1
  8   0   3 100   4 100 0 1 1 1 1
  6   0   2 100  12  60 0 1 0 1 1
 60   0   3 100   3 100 0 1 0 1 1
  3 100  20   0  25   0 0 1 0 1 1
  5 100   4 100   6 100 0 1 0 1 1
 40   0   3 100  50   0 0 0 0 0 1
 25   0   4 100   3 100 0 0 0 0 1
 70   0  60   0   3 100 0 0 0 0 1
 14   0   3 100   2 100 0 0 0 1 0
  9   0   2 100  60   0 0 0 1 0 1
"""


@dataclass(frozen=True)
class Tree:
    """A node: a leaf's answer, or a question whether a feature is at most a limit."""

    answer: bool
    feature: int = -1
    limit: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def says(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.answer)
        out, left = np.empty(len(rows), bool), rows[:, self.feature] <= self.limit
        out[left], out[~left] = self.low.says(rows[left]), self.high.says(rows[~left])
        return out


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 7) -> Tree:
    """Split where the Gini impurity falls most; limits lie halfway between values, earlier features win ties."""
    answer = bool(2 * labels.sum() >= len(labels))
    if depth == 0 or labels.min() == labels.max():
        return Tree(answer)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for limit in (values[1:] + values[:-1]) / 2:
            left = rows[:, feature] <= limit
            impurity = sum(
                len(part) * (1 - part.mean() ** 2 - (1 - part.mean()) ** 2) for part in (labels[left], labels[~left])
            )
            if best is None or impurity < best[0] - 1e-9:
                best = (impurity, feature, float(limit), left)
    if best is None:
        return Tree(answer)
    _, feature, limit, left = best
    return Tree(
        answer, feature, limit, grow(rows[left], labels[left], depth - 1), grow(rows[~left], labels[~left], depth - 1)
    )


@lru_cache
def article_tree() -> Tree:
    """Grown from the labelled table."""
    table = np.array([line.split() for line in LABELLED.strip().splitlines()], float)
    return grow(table[:, :-1], table[:, -1])


def features(found: list[Block]) -> np.ndarray:
    words = np.array([b.words for b in found], float)
    linked = 100 * np.array([b.linked for b in found]) / words
    before, after = (lambda x: np.r_[0, x[:-1]]), (lambda x: np.r_[x[1:], 0])
    flags = np.array([(b.furniture, b.article, b.heading) for b in found], float)
    return np.column_stack(
        [words, linked, before(words), before(linked), after(words), after(linked), flags,
         np.full(len(found), float(any(b.article and not b.furniture for b in found)))]
    )


def main_text(page: str, tree: Tree) -> str:
    """The article's blocks in page order, joined by an empty line; empty if there are none."""
    found = blocks(page)
    if not found:
        return ""
    return "\n\n".join(b.text for b, main in zip(found, tree.says(features(found))) if main)


def _texts(tree: Tree):
    def of(batches):
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch.column("html").to_pylist()]
            rest = [c for c in batch.schema.names if c != "html"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*rest, "text", "n_chars"],
            )

    return of


def extract_main_text(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """Per row: page_id, url, text (the article) and n_chars (its code points).

    Needs ``page_id``, ``url`` and ``html``; further columns are ignored. Inside a block
    white space is one space and character references are decoded; blocks are joined by two line
    feeds, in page order. Broken markup ends what it left open with the page.

    NULL and empty html give an empty text, as do pages without an article. Repeated rows
    get equal results. An empty table gives an empty result.
    """
    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(_texts(tree or article_tree()), ", ".join([*kinds, "text string", "n_chars long"]))

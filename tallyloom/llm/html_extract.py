"""Main text of web pages by flat text blocks and a decision tree.

A page is cut into blocks at block-level tags. Each block has its word count and link density, those of the blocks before and after it,
and whether it lies in an article, in a part that pages use for other things (menu, header, footer, advert, comments, form), or in a heading. A decision
tree trained on the small labelled table below says which blocks are main text.

Null or empty html gives an empty text and 0 characters, and so does a page without main text. Cut-off pages are read to their end. Pages of any size are
read whole, one page at a time. Repeated rows are extracted one by one; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import ragged
from tallyloom.llm.shared import prepare

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark picture q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select option button".split())
# Parts of a page that hold something else than its main text.
ASIDE = frozenset("nav footer aside form menu dialog fieldset".split())
ASIDE_NAMES = frozenset(
    "ad ads adbox advert advertisement adverts alert banner breadcrumb breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies "
    "disqus footer form header login masthead menu modal nav navbar navigation newsletter notice notification pager pagination popup promo promoted related replies "
    "reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget".split()
)
# A name like "content-with-sidebar" or "no-comments" says what is beside its holder, or is not: what follows these words is no hint.
BESIDE = frozenset("has have with without no hide hides".split())
SELF_CLOSING = frozenset("p li dt dd tr td th option".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HOLDERS = frozenset("div ul ol dl table article section main body html nav aside footer header form blockquote".split())


@dataclass
class Block:
    article: int
    aside: int
    heading: int
    # Start of the outermost element that sets this block aside by its names alone, or -1.
    named: int = -1
    pieces: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.pieces)).split())

    def linked_words(self) -> int:
        return len(entities.unescape(" ".join(self.linked)).split())


@dataclass
class Numbers:
    words: int
    linked: int
    article: int
    aside: int
    heading: int

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def hinted(name: str, attributes: str, article: int) -> bool:
    """Whether the names an element carries say that it is another part than main text."""
    if not attributes or name in HEADINGS or name in ("body", "html"):
        return False
    named = " ".join("".join(m) for m in NAMES.findall(attributes)).lower()
    # Compound names of the large holders ("comments-open") say what they have, not what they are.
    words = set(named.split() if name in ("article", "main", "section") else (w for n in named.split() for w in own_words(n)))
    return bool(words & ASIDE_NAMES - ({"header"} if article else set()))


def own_words(compound: str) -> list[str]:
    """Words of a compound name, up to one that says what is beside its holder."""
    words = re.split(r"[^a-z]+", compound)
    return words[: next((k for k, w in enumerate(words) if w in BESIDE), len(words))]


# A page whose text is set aside by names alone, but for this share of its words, is not described by these names.
LEAST_SHARE = 0.1


def blocks(page: str) -> list[Block]:
    """Blocks in page order, those without words left out. A name is no hint if its element turns out to hold the main text."""
    found, holders = cut(page, frozenset())
    if holders:
        # A main that is free now may show that an article in it is not.
        found, more = cut(page, holders)
        if more:
            holders |= more
            found, _ = cut(page, holders)
    # Names that leave nothing to read, like "form-guide" on the holder of a whole text, are none either; from the outermost inwards.
    for _ in range(4):
        misnamed = holder_of_all(found)
        if misnamed is None:
            break
        holders |= {misnamed}
        found, _ = cut(page, holders)
    return found


def holder_of_all(found: list[Block]) -> int | None:
    """The element that its names set aside although it holds nearly all words that are not set aside by tags."""
    if any(b.article and not b.aside and not b.heading for b in found):
        return None
    held: dict[int, int] = {}
    free = 0
    for b in found:
        n = len("".join(b.pieces).split())
        if b.named >= 0:
            held[b.named] = held.get(b.named, 0) + n
        elif not b.aside:
            free += max(0, n - len(" ".join(b.linked).split()))
    if not held or free >= LEAST_SHARE * (free + sum(held.values())):
        return None
    return max(held, key=lambda k: (held[k], -k))


@dataclass
class Open:
    """An open element: what it is in, and whether it is another part by its tag, inside or of its own."""

    name: str
    article: int
    aside: int
    by_tag: bool


class Stack:
    """Open elements, with the places of each name and of the holders, so that a tag is matched without a search."""

    def __init__(self):
        self.tags: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.holders: list[int] = []
        self.hints: list[tuple[int, int]] = []  # open elements set aside by their names only: depth and place
        self.links = self.parts = 0

    def push(self, tag: Open) -> None:
        self.places.setdefault(tag.name, []).append(len(self.tags))
        if tag.name in HOLDERS:
            self.holders.append(len(self.tags))
        self.links += tag.name == "a"
        self.parts += tag.by_tag
        self.tags.append(tag)

    def close(self, name: str) -> None:
        """Close the last open element of this name and all in it. One that closes itself, like a paragraph, is not looked for outside the element that holds it."""
        known = self.places.get(name)
        if not known or (name in SELF_CLOSING and self.holders and self.holders[-1] > known[-1]):
            return
        at = known[-1]
        while len(self.tags) > at:
            gone = self.tags.pop()
            self.places[gone.name].pop()
            self.links -= gone.name == "a"
            self.parts -= gone.by_tag
        while self.holders and self.holders[-1] >= at:
            self.holders.pop()
        while self.hints and self.hints[-1][0] >= at:
            self.hints.pop()

    @property
    def top(self) -> Open:
        return self.tags[-1] if self.tags else Open("", 0, 0, False)


def cut(page: str, holders: frozenset[int]) -> tuple[list[Block], frozenset[int]]:
    """Blocks, if the names of the elements that start at `holders` are no hints, and the elements whose names should be none.

    These are the elements round every <main>, or else those round the first <article> if no <main> or <article> has text outside of such elements. Later articles may be comments or
    related pages. Menus, footers and the like, which the tag says, stay what they are. The time is in proportion to the page, whatever is left unclosed.
    """
    found: list[Block] = []
    stack = Stack()
    round_main: set[int] = set()
    round_article: set[int] | None = None
    current: Block | None = None

    def put(text: str) -> None:
        nonlocal current
        if not text:
            return
        if current is None:
            top = stack.top
            named = stack.hints[0][1] if stack.hints and not stack.parts else -1
            current = Block(top.article, top.aside, int(any(t.name in HEADINGS for t in stack.tags[-4:])), named)
            found.append(current)
        current.pieces.append(text)
        if stack.links:
            current.linked.append(text)

    done, size = 0, len(page)
    while done < size:
        tag = TAG.search(page, done)
        if tag is None:
            put(page[done:])
            break
        put(page[done : tag.start()])
        done = tag.end()
        name = (tag.group(2) or tag.group(5) or "").lower()
        if not name:
            continue
        ending, attributes = tag.group(1) or tag.group(4), tag.group(3) or tag.group(6) or ""
        if name == "br":
            put(" ")
            continue
        if name not in INLINE:
            current = None
        if ending:
            stack.close(name)
            continue
        if name in RAW and not attributes.endswith("/"):
            end = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, done)
            done = end.end() if end else size
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in SELF_CLOSING:
            stack.close(name)
        top = stack.top
        if name in ("article", "main") and stack.hints and not stack.parts:
            if name == "main":
                # What is below a hint that was taken before was taken with it.
                for _, place in reversed(stack.hints):
                    if place in round_main:
                        break
                    round_main.add(place)
            elif round_article is None:
                round_article = {place for _, place in stack.hints}
        by_tag = name in ASIDE or (name == "header" and not top.article)
        other = by_tag
        if not other and tag.start() not in holders and hinted(name, attributes, top.article):
            stack.hints.append((len(stack.tags), tag.start()))
            other = True
        stack.push(Open(name, int(top.article or name in ("article", "main")), int(top.aside or other), by_tag))
    found = [b for b in found if "".join(b.pieces).strip()]
    if round_article and not round_main and not any(b.article and not b.aside and not b.heading for b in found):
        round_main = round_article
    return found, frozenset(round_main)


def features(page: list[Numbers]) -> list[list[float]]:
    nothing = Numbers(0, 0, 0, 0, 0)
    around = [nothing, *page, nothing]
    return [[b.words, b.density, p.words, p.density, n.words, n.density, b.article, b.aside, b.heading] for p, b, n in zip(around, page, around[2:])]


# The labelled table: pages as lists of blocks. (words, linked words, in an article, in another part, heading, main text)
LABELLED = [
    [(6, 6, 0, 1, 0, 0), (12, 0, 0, 1, 0, 0), (7, 0, 1, 0, 1, 1), (60, 0, 1, 0, 0, 1), (1, 0, 1, 0, 0, 1), (35, 2, 1, 0, 0, 1), (9, 0, 0, 1, 0, 0)],
    [(1, 1, 0, 1, 0, 0), (1, 1, 0, 1, 0, 0), (30, 0, 0, 1, 0, 0), (9, 0, 1, 0, 1, 1), (3, 0, 1, 0, 0, 1), (140, 5, 1, 0, 0, 1), (25, 0, 1, 1, 0, 0), (6, 1, 0, 1, 0, 0)],
    [(4, 4, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0), (8, 0, 0, 0, 1, 1), (80, 3, 0, 0, 0, 1), (45, 0, 0, 0, 0, 1), (50, 1, 0, 0, 0, 1), (5, 0, 0, 0, 0, 0), (4, 4, 0, 0, 0, 0)],
    [(2, 2, 0, 0, 0, 0), (6, 0, 0, 0, 1, 1), (24, 1, 0, 0, 0, 1), (200, 9, 0, 0, 0, 1), (12, 0, 0, 0, 0, 1), (65, 0, 0, 0, 0, 1), (10, 10, 0, 0, 0, 0), (7, 6, 0, 0, 0, 0)],
    [(5, 5, 0, 1, 0, 0), (2, 0, 1, 0, 1, 1), (4, 4, 1, 0, 0, 1), (18, 0, 1, 0, 0, 1), (90, 0, 0, 1, 0, 0), (40, 0, 0, 1, 0, 0), (3, 0, 0, 1, 1, 0)],
    [(8, 8, 0, 1, 0, 0), (70, 0, 0, 1, 0, 0), (120, 2, 0, 1, 0, 0), (5, 0, 0, 1, 1, 0), (11, 0, 1, 0, 1, 1), (9, 0, 1, 0, 0, 1), (15, 15, 1, 0, 0, 1), (2, 0, 1, 1, 0, 0)],
    [(3, 0, 0, 0, 0, 0), (2, 2, 0, 0, 0, 0), (1, 1, 0, 0, 0, 0), (30, 28, 0, 0, 0, 0), (33, 0, 0, 0, 0, 1), (28, 2, 0, 0, 0, 1), (6, 5, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0)],
    [(3, 2, 0, 0, 0, 0), (2, 0, 0, 0, 1, 1), (50, 0, 0, 0, 0, 1), (3, 0, 0, 0, 0, 1), (60, 0, 0, 0, 0, 1), (2, 0, 0, 0, 0, 0)],
    [(4, 4, 0, 1, 0, 0), (3, 0, 0, 0, 1, 1), (45, 2, 0, 0, 0, 1), (2, 0, 0, 0, 1, 1), (70, 0, 0, 0, 0, 1), (3, 0, 0, 1, 0, 0)],
    [(300, 0, 1, 0, 0, 1)],
    [(20, 0, 1, 0, 0, 1)],
    [(2, 2, 1, 0, 0, 1)],
    [(150, 4, 0, 0, 0, 1)],
    [(10, 10, 0, 1, 0, 0)],
    [(30, 0, 0, 1, 0, 0)],
    [(5, 0, 1, 0, 1, 1), (1, 0, 1, 0, 0, 1), (4, 0, 1, 0, 0, 1)],
    [(3, 0, 1, 0, 1, 1), (25, 25, 1, 0, 0, 1), (40, 0, 1, 1, 0, 0)],
    [(1, 0, 1, 0, 0, 1), (1, 0, 1, 0, 0, 1), (300, 0, 1, 0, 0, 1), (2, 2, 1, 1, 0, 0), (14, 0, 0, 1, 0, 0)],
    # Links in articles that are other parts: menus and related pages.
    [(1, 1, 1, 1, 0, 0), (1, 0, 1, 0, 1, 1), (60, 0, 1, 0, 0, 1), (4, 4, 1, 1, 0, 0), (3, 3, 1, 1, 0, 0)],
    [(5, 5, 1, 1, 0, 0), (2, 2, 1, 1, 0, 0), (8, 0, 1, 0, 1, 1), (90, 3, 1, 0, 0, 1), (3, 3, 1, 0, 0, 1), (30, 0, 1, 0, 0, 1), (6, 6, 1, 1, 0, 0), (12, 12, 1, 1, 0, 0), (2, 2, 1, 1, 0, 0)],
    # Texts that end the page.
    [(1, 1, 1, 1, 0, 0), (1, 0, 1, 0, 1, 1), (42, 0, 1, 0, 0, 1), (21, 0, 1, 0, 0, 1)],
    [(5, 5, 0, 0, 0, 0), (40, 0, 0, 0, 0, 1), (35, 0, 0, 0, 0, 1)],
    [(3, 3, 0, 1, 0, 0), (30, 0, 1, 0, 0, 1), (6, 0, 1, 0, 0, 1)],
    [(7, 0, 0, 0, 1, 1), (25, 0, 0, 0, 0, 1), (80, 2, 0, 0, 0, 1), (14, 0, 0, 0, 0, 1)],
    # Pages of plain divisions: a short line is text between texts, and is none between lists of links or at the page's end; a list of links inside a text is text.
    [(3, 3, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0), (6, 6, 0, 0, 0, 0), (5, 5, 0, 0, 0, 0), (42, 1, 0, 0, 0, 1), (4, 0, 0, 0, 0, 1), (55, 0, 0, 0, 0, 1), (6, 6, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0), (5, 5, 0, 0, 0, 0)],
    [(2, 2, 0, 0, 0, 0), (3, 0, 0, 0, 0, 0), (2, 2, 0, 0, 0, 0), (70, 2, 0, 0, 0, 1), (3, 0, 0, 0, 0, 1), (38, 0, 0, 0, 0, 1), (5, 0, 0, 0, 0, 1), (90, 3, 0, 0, 0, 1), (4, 4, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0), (7, 7, 0, 0, 0, 0)],
    [(8, 8, 0, 0, 0, 0), (5, 0, 0, 0, 0, 0), (8, 7, 0, 0, 0, 0), (26, 0, 0, 0, 0, 1), (9, 0, 0, 0, 0, 1), (31, 1, 0, 0, 0, 1), (12, 11, 0, 0, 0, 0), (9, 0, 0, 0, 0, 0), (10, 10, 0, 0, 0, 0)],
    [(4, 4, 0, 0, 0, 0), (4, 4, 0, 0, 0, 0), (120, 4, 0, 0, 0, 1), (6, 0, 0, 0, 0, 1), (64, 0, 0, 0, 0, 1), (80, 2, 0, 0, 0, 1), (3, 3, 0, 0, 0, 0), (4, 0, 0, 0, 0, 0), (3, 3, 0, 0, 0, 0), (6, 0, 0, 0, 0, 0)],
    [(5, 5, 0, 0, 0, 0), (7, 0, 0, 0, 0, 0), (5, 5, 0, 0, 0, 0), (48, 0, 0, 0, 0, 1), (7, 0, 0, 0, 0, 1), (52, 3, 0, 0, 0, 1), (40, 0, 0, 0, 0, 1), (9, 9, 0, 0, 0, 0), (7, 0, 0, 0, 0, 0), (6, 6, 0, 0, 0, 0)],
    [(6, 6, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0), (11, 11, 0, 0, 0, 0), (36, 2, 0, 0, 0, 1), (2, 0, 0, 0, 0, 1), (44, 0, 0, 0, 0, 1), (58, 1, 0, 0, 0, 1), (14, 13, 0, 0, 0, 0), (10, 0, 0, 0, 0, 0), (12, 12, 0, 0, 0, 0)],
]


@dataclass
class Tree:
    """A node: rows with feature at most `limit` go left, or a leaf that answers."""

    answer: bool = False
    feature: int = -1
    limit: float = 0.0
    left: Tree | None = None
    right: Tree | None = None

    def says(self, row: list[float]) -> bool:
        node = self
        while node.feature >= 0:
            node = node.left if row[node.feature] <= node.limit else node.right
        return node.answer


def train(spark: SparkSession, labelled: list[list[tuple[int, ...]]] = LABELLED) -> Tree:
    """The decision tree of Spark ML over the labelled table, as nodes that tasks can walk."""
    rows = [(Vectors.dense(x), float(block[5])) for page in labelled for x, block in zip(features([Numbers(*b[:5]) for b in page]), page)]
    model = DecisionTreeClassifier(maxDepth=6, maxBins=64, seed=1).fit(spark.createDataFrame(rows, ["features", "label"]).coalesce(1))

    def copy(node) -> Tree:
        if node.subtreeDepth() == 0:
            return Tree(answer=node.prediction() > 0.5)
        return Tree(feature=node.split().featureIndex(), limit=node.split().threshold(), left=copy(node.leftChild()), right=copy(node.rightChild()))

    return copy(model._java_obj.rootNode())


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    texts = [b.text() for b in found]
    numbers = [Numbers(len(t.split()), min(b.linked_words(), len(t.split())), b.article, b.aside, b.heading) for b, t in zip(found, texts)]
    return " ".join(t for t, x in zip(texts, features(numbers)) if t and tree.says(x))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = train(prepare(pages.sparkSession))
    pages = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.slices(batch, "html"):
                texts = [main_text(page, tree) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")

"""HTML extraction: text blocks classified by a decision tree over flat block features."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that part blocks, and elements whose content is never text.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style noscript template iframe textarea title svg math object embed audio video canvas select button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

# Where a block stands: 0 nowhere special, 1 in an article, 2 in furniture, 3 among comments.
PLAIN, ARTICLE, FURNITURE, COMMENTS = range(4)
FURNITURE_TAGS = frozenset("nav aside footer header form menu dialog fieldset search".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs consent cookie cookies copyright "
    "disclaimer footer header legal links login masthead menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo promotion recommended related search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription tags toc toolbar topbar widget widgets gdpr alert rail".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus discussion replies reply respond responses".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    """One flat block: its text, words, words inside links, and where it stands."""

    text: str
    words: int
    linked: int
    place: int

    @property
    def density(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _place_of(tag: str, attributes: str, inside: int) -> int:
    """Where the content of an element stands, given where the element stands."""
    if inside in (FURNITURE, COMMENTS) and not (tag in ("article", "main") and inside == FURNITURE):
        return inside
    if attributes:
        if _HIDDEN.search(attributes):
            return FURNITURE
        named = {w for m in _NAMES.finditer(attributes) for w in _PARTS.findall((m[1] or m[2] or m[3] or "").lower())}
        if tag not in ("body", "html", "main"):
            if named & COMMENT_WORDS:
                return COMMENTS
            if named & FURNITURE_WORDS and not (inside == ARTICLE and tag == "header"):
                return FURNITURE
    if tag in ("article", "main"):
        return ARTICLE
    if tag in FURNITURE_TAGS and not (inside == ARTICLE and tag == "header"):
        return FURNITURE
    return inside


def blocks_of(page: str) -> list[Block]:
    """Flat blocks in page order. White space inside a block is one space; empty ones are left out."""
    blocks: list[Block] = []
    pieces: list[tuple[bool, str]] = []
    open_elements: list[tuple[str, int]] = []
    linked = False
    place = PLAIN

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(s for _, s in pieces)).split())
        if text:
            in_links = sum(len(html.unescape(s).split()) for in_link, s in pieces if in_link)
            blocks.append(Block(text, text.count(" ") + 1, min(in_links, text.count(" ") + 1), place))
        pieces.clear()

    at, lowered = 0, None
    while m := _TOKEN.match(page, at):
        at = m.end()
        tag = m[2]
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                pieces.append((linked, m[0]))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                linked = False
                continue
            for k in range(len(open_elements) - 1, -1, -1):
                if open_elements[k][0] == tag:
                    flush()
                    place = open_elements[k][1]
                    del open_elements[k:]
                    break
            if tag in BLOCK:
                flush()
                linked = False
            continue
        if tag in RAW and not m[3].endswith("/"):
            lowered = page.lower() if lowered is None else lowered
            if len(lowered) != len(page):  # letters whose lower case is longer; ASCII is enough for tags
                lowered = page.encode().lower().decode()
            close = lowered.find("</" + tag, at)
            end = page.find(">", close) if close >= 0 else -1
            at = end + 1 if end >= 0 else len(page)
            if tag in BLOCK:
                flush()
            else:
                pieces.append((linked, " "))
            continue
        if tag == "a":
            linked = True
        elif tag == "br":
            pieces.append((linked, " "))
        if tag in BLOCK:
            flush()
            linked = False
            if open_elements and open_elements[-1][0] in ("p", "li") and (open_elements[-1][0] == "p" or tag == "li"):
                place = open_elements.pop()[1]
        if tag not in VOID and (tag in BLOCK or m[3]):
            inner = _place_of(tag, m[3], place)
            if tag in BLOCK or inner != place:
                flush() if inner != place else None
                open_elements.append((tag, place))
                place = inner
    flush()
    return blocks


FEATURES = ("place", "words", "density", "words_before", "density_before", "words_after", "density_after")


def features_of(blocks: list[Block]) -> np.ndarray:
    """A row per block: where it stands, words and link density of it and of its neighbours."""
    n = len(blocks)
    out = np.zeros((n, len(FEATURES)))
    if n:
        own = np.array([(b.words, b.density) for b in blocks], dtype=float)
        out[:, 0] = [b.place for b in blocks]
        out[:, 1:3] = own
        out[1:, 3:5] = own[:-1]
        out[:-1, 5:7] = own[1:]
    return out


# Labelled pages, written for this table: a page is a list of (place, words, linked words, label).
LABELLED: tuple[tuple[tuple[int, int, int, int], ...], ...] = (
    ((2, 1, 1, 0), (2, 1, 1, 0), (2, 2, 2, 0), (2, 9, 0, 0), (1, 12, 0, 1), (1, 80, 0, 1), (1, 1, 0, 1), (1, 45, 0, 1), (2, 9, 0, 0)),
    ((2, 1, 1, 0), (2, 14, 0, 0), (1, 6, 0, 1), (1, 1, 0, 1), (1, 3, 0, 1), (1, 2, 0, 1), (2, 12, 0, 0)),
    ((0, 1, 1, 0), (0, 1, 1, 0), (0, 1, 1, 0), (0, 8, 0, 1), (0, 60, 2, 1), (0, 90, 0, 1), (0, 40, 3, 1), (0, 5, 5, 0), (0, 4, 4, 0)),
    ((0, 2, 2, 0), (0, 3, 3, 0), (0, 7, 0, 1), (0, 120, 4, 1), (0, 4, 0, 1), (0, 70, 0, 1), (3, 20, 0, 0), (3, 35, 1, 0), (3, 2, 2, 0)),
    ((2, 30, 1, 0), (2, 2, 2, 0), (1, 9, 0, 1), (1, 55, 20, 1), (1, 15, 2, 1), (1, 200, 3, 1), (2, 60, 0, 0), (2, 6, 6, 0)),
    ((2, 45, 2, 0), (0, 10, 0, 1), (0, 33, 0, 1), (0, 1, 0, 1), (0, 25, 1, 1), (0, 48, 0, 1), (0, 3, 3, 0), (0, 3, 3, 0), (2, 25, 0, 0)),
    ((1, 5, 0, 1), (1, 20, 0, 1), (1, 18, 18, 1), (1, 30, 5, 1), (1, 64, 0, 1), (3, 80, 0, 0), (3, 120, 0, 0), (3, 10, 1, 0)),
    ((2, 3, 3, 0), (2, 3, 3, 0), (1, 4, 0, 1), (1, 150, 0, 1), (1, 2, 2, 1), (1, 3, 1, 1), (1, 75, 0, 1), (2, 100, 0, 0)),
    ((0, 4, 4, 0), (0, 5, 5, 0), (0, 3, 3, 0), (0, 6, 6, 0), (0, 11, 0, 1), (0, 22, 0, 1), (0, 16, 0, 1), (0, 2, 2, 0)),
    ((1, 1, 0, 1), (1, 7, 0, 1), (3, 1, 0, 0), (3, 14, 0, 0), (2, 1, 0, 0), (2, 150, 10, 0), (1, 9, 0, 1), (1, 40, 0, 1)),
)


@dataclass
class Tree:
    """A node of a classification tree; a leaf has only its share of main text."""

    share: float
    feature: int = -1
    cut: float = 0.0
    low: Tree | None = None
    high: Tree | None = None


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 5, least: int = 2) -> Tree:
    """Splits that lower Gini impurity most; ties go to the first feature and the lowest cut."""
    share = float(y.mean())
    best = (1e-9, -1, 0.0)
    impurity = share * (1 - share) * len(y)
    if depth and 0 < share < 1:
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[:-1] + values[1:]) / 2:
                low = x[:, f] <= cut
                n = int(low.sum())
                if least <= n <= len(y) - least:
                    a, b = y[low].mean(), y[~low].mean()
                    gain = impurity - a * (1 - a) * n - b * (1 - b) * (len(y) - n)
                    if gain > best[0] + 1e-12:
                        best = (gain, f, float(cut))
    if best[1] < 0:
        return Tree(share)
    low = x[:, best[1]] <= best[2]
    return Tree(
        share, best[1], best[2], fit_tree(x[low], y[low], depth - 1, least), fit_tree(x[~low], y[~low], depth - 1, least)
    )


def predict(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Whether each row is main text."""
    if tree.feature < 0 or not len(x):
        return np.full(len(x), tree.share >= 0.5)
    out = np.zeros(len(x), bool)
    low = x[:, tree.feature] <= tree.cut
    out[low] = predict(tree.low, x[low])
    out[~low] = predict(tree.high, x[~low])
    return out


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages."""
    pages = [[Block("", w, k, p) for p, w, k, _ in page] for page in LABELLED]
    x = np.vstack([features_of(page) for page in pages])
    return x, np.array([label for page in LABELLED for *_, label in page], dtype=float)


@dataclass
class Extractor:
    """The fitted tree; a page's text is its main blocks, one per line."""

    tree: Tree = field(default_factory=lambda: fit_tree(*labelled_table()))

    def extract(self, page: str) -> str:
        blocks = blocks_of(page)
        keep = predict(self.tree, features_of(blocks))
        return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract_pages(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars; one row per input row.

    The whole html counts; a null or empty one has an empty text and 0 characters. Repeated rows,
    null ids and null urls are kept as they are; an empty table gives no rows; further columns
    are not read.
    """
    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    fitted = extractor or Extractor()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [fitted.extract(x.as_py()) for x in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    found = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("html")).mapInArrow(
        run, f"page_id {kind['page_id']}, url {kind['url']}, text string"
    )
    return found.withColumn("n_chars", F.length("text").cast("long"))

"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, and one linear
scan finds the contiguous run with the greatest sum: the content region. The weights are log-odds
of lying inside the main text, learned from labelled pages: a bounded sample of pages whose own
markup names their main text by ``article`` or ``main``. These marks are labels only; a page is
scanned whole, and without regard to its own marks.

An element that calls itself menu, header, footer, sidebar, notice, advert, form or comments, by its
kind, its role or its names, turns its words and tags into pieces of another kind (``word@nav``),
which have weights of their own. Where these are negative, the element is no text, and the scan
passes over it: an advert does not part an article in two. Headings keep their text whatever their
names, and forms and named elements that hold most of the page's words are wrappers of it and count
as unnamed, except threads of comments. Only what a browser does not show as text (scripts, styles,
form controls, hidden elements, ...) is left out beforehand. The text is that of the blocks of the
region; a block that it cuts through is completed.

Defined cases: null, empty and text-free pages give an empty text; unclosed and stray tags are
tolerated; equal scores choose the earliest, longest region; pages are independent, so repeated
rows need no rule; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oddrow.llm.common import map_batches
from oddrow.llm.samples import sample_ids

MAX_LABELLED = 2_000
#: Tags that the main text has more often than the rest of a page cost this, unseen tags more.
LEAST_TAG, UNSEEN_TAG = 0.05, 0.1
LEAST_WORD = 0.25
#: What large weights approach, never reaching it, so that they stay apart.
MOST_WORD, MOST_LINKED, MOST_TAG = 4.0, 3.0, 4.0
#: Weight of words in a kind of element that no labelled page has.
UNSEEN_BESIDE = -4.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # Quotes open a value only after an equals sign.
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+)*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?", re.DOTALL
)
_WHITE = re.compile(r"\s+")
# Elements by what they are for in HTML.
RAW_TEXT = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source",
    "track", "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
    "script", "style", "template", "noscript", "svg", "canvas", "object", "audio", "video",
    "button", "select", "option", "input", "textarea", "map", "iframe",
    "math", "mi", "mn", "mo", "mrow", "msup", "msub", "msubsup", "mfrac", "msqrt", "mroot",
    "mtext", "mover", "munder", "munderover", "semantics", "annotation",
}
NO_CONTENT = RAW_TEXT | {
    "head", "noscript", "template", "svg", "canvas", "object", "audio", "video",
    "button", "select", "option", "input", "map",
}
BESIDE_KINDS = {"nav", "aside", "footer", "menu", "dialog"}
CLOSES_PARAGRAPH = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}
SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
LANDMARKS = {"article", "main"}
NO_CONTENT_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert",
    "alertdialog", "menu", "menubar", "toolbar",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# A class or id names an element beside the main text if all its words are of these lists and one
# is of the first two. Ids made of one topic alone may be anchors of a chapter ("discussion").
_PARTS = re.compile(
    r"ads?|adv|advert\w*|sponsor\w*|promo\w*|gdpr|popup|modal|overlay|nav|navbar|breadcrumbs?|"
    r"sidebar|aside|widget\w*|footer|masthead|topbar|toolbar|siteheader|pageheader|newsletter|"
    r"signup|pagination|pager"
)
_TOPICS = re.compile(
    r"banner|cookies?|consent|notice|notification|alert|navigation|menus?|side|foot|related|"
    r"recommend\w*|share|sharing|social|subscribe|subscription|login|search|tags|hidden|discussion"
)
_THREADS = re.compile(
    r"comments?|commentlist|respond|replies|disqus\w*|feedbacks?|reviews?|guestbook"
)
_PLACES = re.compile(
    r"site|page|main|primary|secondary|global|top|bottom|left|right|post|entry|google|list|area|"
    r"box|bar|block|container|wrap|wrapper|inner|outer|links?|items?|buttons?|btn|icons?|form|"
    r"panel|section|slot|unit|text|title|row|group|posts|articles|stories|thread|policy|media|\d+|"
    r"users?|readers?|visitors?|customers?"
)
_KNOWN = re.compile("|".join(p.pattern for p in (_PARTS, _TOPICS, _THREADS, _PLACES)))
_HEADERS = {"site-header", "page-header"}


class Piece(NamedTuple):
    """A tag (``words`` is 0) or a run of text, and the block and elements it stands in."""

    kind: str
    words: int
    block: int
    path: tuple[int, ...]


class Page(NamedTuple):
    pieces: list[Piece]
    texts: list[tuple[int, str, tuple[int, ...]]]  # block, text and elements, white space too
    landmarks: set[int]
    beside: dict[int, str]  # what the elements call themselves that are beside the main text

    def side(self, path: tuple[int, ...]) -> str | None:
        """The outermost element beside the main text."""
        if self.beside:
            for element in path:
                if element in self.beside:
                    return self.beside[element]
        return None



class Says(NamedTuple):
    """What an element says about itself: the name of its kind, and whether that settles it."""

    kind: str
    sure: bool


@lru_cache(maxsize=10_000)
def _named(value: str, is_id: bool, inside_landmark: bool) -> Says | None:
    """What a class or id says about its element."""
    found = None
    for token in value.lower().replace("_", "-").split():
        words = [w for w in token.split("-") if w]
        parts, topics, threads = (
            any(p.fullmatch(w) for w in words) for p in (_PARTS, _TOPICS, _THREADS)
        )
        if token in _HEADERS or (not inside_landmark and token in ("header", "top")):
            found = Says("header", False)
        elif not all(_KNOWN.fullmatch(w) for w in words):
            continue
        elif threads:
            return Says("thread", True)
        elif parts or (topics and (len(words) > 1 or not is_id)):
            found = Says("part" if parts else "topic", False)
    return found


def _unseen(name: str, attributes: str) -> bool:
    """Whether a browser shows no text for an element."""
    if name in NO_CONTENT:
        return True
    if not attributes or name in ("html", "body"):
        return False
    for match in _ATTRIBUTE.finditer(attributes):
        key, value = match[1].lower(), (match[2] or match[3] or match[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _says(name: str, attributes: str, inside_landmark: bool) -> Says | None:
    """What an element says by its kind, its role and its names, if that is beside the text.

    Forms and names only make it likely: such an element may as well wrap the whole page.
    """
    if name in BESIDE_KINDS or (name == "header" and not inside_landmark):
        return Says(name, True)
    found = Says("form", False) if name == "form" else None
    if not attributes or name in ("html", "body") or name in LANDMARKS:
        return found
    for match in _ATTRIBUTE.finditer(attributes):
        key, value = match[1].lower(), match[2] or match[3] or match[4] or ""
        if key == "role" and value.lower() in NO_CONTENT_ROLES:
            return Says("role", True)
        if key == "role" and value.lower() == "form":
            found = Says("form", False)
        if key in ("class", "id") and name not in HEADINGS:
            said = _named(value, key == "id", inside_landmark)
            if said is not None and said.sure:
                return said
            found = said or found
    return found


class _Likely(NamedTuple):
    """An element that is likely beside the main text, with what stands before and in it."""

    around: tuple[int, ...]
    words_before: int
    words: int = 0
    last: int = 0  # the last element in it


class _Reader:
    """Walks through a page once, keeping the open elements."""

    def __init__(self) -> None:
        self.words = 0
        self.sure: dict[int, str] = {}
        self.likely: dict[int, _Likely] = {}
        self.kinds: dict[int, str] = {}  # of the likely ones
        self.names: list[str] = []
        self.open: list[int] = []
        self.skipped: int | None = None  # depth of the element that is being left out
        self.pieces: list[Piece] = []
        self.texts: list[tuple[int, str, tuple[int, ...]]] = []
        self.landmarks: set[int] = set()
        self.block = 0

    def end_block(self) -> None:
        if self.texts and self.texts[-1][0] == self.block:
            self.block += 1

    def text(self, raw: str) -> None:
        if self.skipped is not None or not raw:
            return
        plain = html.unescape(raw) if "&" in raw else raw
        count = len(plain.split())
        path = tuple(self.open)
        if count:
            self.words += count
            linked = any(self.names[e] == "a" for e in self.open)
            self.pieces.append(Piece("linked" if linked else "word", count, self.block, path))
        self.texts.append((self.block, plain, path))

    def tag(self, name: str, path: Iterable[int]) -> None:
        if self.skipped is None and name not in LANDMARKS:
            self.pieces.append(Piece(f"<{name}>", 0, self.block, tuple(path)))

    def start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.texts.append((self.block, " ", tuple(self.open)))
        elif name not in INLINE and self.skipped is None:
            self.end_block()
        if name in CLOSES_PARAGRAPH:
            self._close_implied({"p"}, {"table", "td", "th", "button", "article", "section"})
        if name in SIBLINGS:
            self._close_implied(SIBLINGS[name], {"ul", "ol", "dl", "table", "select"})
        if name in VOID:
            self.tag(name, self.open)
            return
        if self.skipped is None:
            if _unseen(name, attributes):
                self.skipped = len(self.open)
            else:
                self._note(_says(name, attributes, not self.landmarks.isdisjoint(self.open)))
                self.tag(name, [*self.open, len(self.names)])
        self.names.append(name)
        self.open.append(len(self.names) - 1)
        if self.skipped is None and name in LANDMARKS:
            self.landmarks.add(len(self.names) - 1)

    def _note(self, said: Says | None) -> None:
        """Keep what the element that is about to open says about itself."""
        number = len(self.names)
        if said is not None and said.sure:
            self.sure[number] = said.kind
        elif said is not None:
            self.likely[number] = _Likely(tuple(self.open), self.words)
            self.kinds[number] = said.kind

    def end(self, name: str) -> None:
        if name not in INLINE and self.skipped is None:
            self.end_block()
        for depth in range(len(self.open) - 1, -1, -1):
            if self.names[self.open[depth]] == name:
                path = self.open[: depth + 1]
                self._cut(depth)
                self.tag(name, path)
                return

    def _close_implied(self, names: set[str], barriers: set[str]) -> None:
        for depth in range(len(self.open) - 1, -1, -1):
            name = self.names[self.open[depth]]
            if name in names:
                self._cut(depth)
                return
            if name in barriers:
                return

    def _cut(self, depth: int) -> None:
        if self.likely:
            for number in self.open[depth:]:
                if number in self.likely:
                    one = self.likely[number]
                    self.likely[number] = one._replace(
                        words=self.words - one.words_before, last=len(self.names) - 1
                    )
        del self.open[depth:]
        if self.skipped is not None and len(self.open) <= self.skipped:
            self.skipped = None

    def finish(self) -> Page:
        self.end_block()
        self._cut(0)
        # One that holds most of the page's words wraps the main text, unless a marked text
        # stands next to it.
        likely = {
            number: self.kinds[number]
            for number, one in self.likely.items()
            if 2 * one.words <= self.words
            or any(not number < m <= one.last and m not in one.around for m in self.landmarks)
        }
        return Page(self.pieces, self.texts, self.landmarks, self.sure | likely)


def read_page(source: str | None) -> Page:
    """Pieces and texts of a page, and its elements beside the main text."""
    return _read(source or "", _Reader())


def _read(source: str, reader: _Reader) -> Page:
    at = 0
    while (match := _TOKEN.search(source, at)) is not None:
        reader.text(source[at : match.start()])
        at = match.end()
        name = (match[2] or "").lower()
        if not name:
            continue
        if match[1]:
            reader.end(name)
            continue
        attributes = match[3] or ""
        reader.start(name, attributes)
        if name in RAW_TEXT:
            closing = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
            at = closing.end() if closing else len(source)
            reader.end(name)
        elif attributes.rstrip().endswith("/") and name in ("svg", "object"):
            reader.end(name)
    reader.text(source[at:])
    return reader.finish()


# ------------------------------------------------------------------------- weights


def _label_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, inside, outside): pieces of pages that mark their main text themselves.

    What an element beside the main text holds counts under the kind of that element; its words
    count as words, too, and so do the tags of elements that only their names tell apart.
    """
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for source in batch.column(0).to_pylist():
            page = read_page(source)
            if not page.landmarks:
                continue
            for piece in page.pieces:
                outside = page.landmarks.isdisjoint(piece.path)
                side = page.side(piece.path)
                kinds = {piece.kind}
                if side is not None:
                    kinds = {f"word@{side}"} if piece.words else set()
                    if piece.words or side not in BESIDE_KINDS:
                        kinds.add(piece.kind)
                for kind in kinds:
                    counts.setdefault(kind, [0, 0])[outside] += piece.words or 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.string()),
                pa.array([c[0] for c in counts.values()], pa.int64()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
            ],
            names=["kind", "inside", "outside"],
        )


def _bent(value: float, most: float, least: float) -> float:
    """``value``, at least ``least``, bent so that it stays below ``most``."""
    return max(least, value / (1 + max(0.0, value) / most))


def weights_from(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Log-odds of the kinds: words held positive, tags and linked words negative; words of an
    element with a name may be either."""
    plain = [c for kind, c in counts.items() if not kind.startswith("word@")]
    inside = sum(c[0] for c in plain) + 1
    outside = sum(c[1] for c in plain) + 1
    made = {}
    for kind in {"word", "linked", *counts}:
        a, b = counts.get(kind, (0, 0))
        odds = math.log((a + 1) / inside) - math.log((b + 1) / outside)
        if kind == "word":
            made[kind] = _bent(odds, MOST_WORD, LEAST_WORD)
        elif kind == "linked":
            made[kind] = -_bent(-odds, MOST_LINKED, LEAST_WORD)
        elif kind.startswith("word@"):
            made[kind] = odds
        else:
            made[kind] = -_bent(-odds, MOST_TAG, LEAST_TAG)
    return made


def train(pages: DataFrame) -> dict[str, float]:
    """Weights from the labelled pages of a bounded sample."""
    ids = F.broadcast(sample_ids(pages, MAX_LABELLED, "page_id"))
    chosen = pages.select("page_id", "html").join(ids, "page_id").select("html")
    counts = map_batches(chosen, _label_counts, "kind string, inside long, outside long")
    named = F.col("kind").isin("word", "linked", *(f"<{t}>" for t in _tags()))
    known = counts.filter(named | F.col("kind").startswith("word@"))
    total = known.groupBy("kind").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    return weights_from({r["kind"]: (r["a"], r["b"]) for r in total.collect()})


def _tags() -> set[str]:
    """Names whose weights are learned; any other tag costs the least."""
    more = {"html", "body", "center", "dd", "dl", "dt", "figcaption", "figure", "li", "td", "th"}
    return INLINE | VOID | CLOSES_PARAGRAPH | more | {"tr", "tbody", "thead", "caption", "br"}


# ------------------------------------------------------------------------- extraction


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) of the run with the greatest sum; empty if no score is positive."""
    best, found = 0.0, (0, 0)
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, found = total, (start, i + 1)
    return found


def _side_weight(side: str, weights: dict[str, float]) -> float:
    return weights.get(f"word@{side}", UNSEEN_BESIDE)


def extract(source: str | None, weights: dict[str, float]) -> str:
    """Main text of one page, blocks joined by an empty line."""
    page = read_page(source)
    beside = {e: side for e, side in page.beside.items() if _side_weight(side, weights) < 0}
    page = page._replace(beside=beside)
    pieces = [p for p in page.pieces if page.side(p.path) is None]
    scores = [weights.get(p.kind, -UNSEEN_TAG) * (p.words or 1) for p in pieces]
    start, end = best_run(scores)
    # Blocks that the run cuts through are completed.
    chosen = {p.block for p in pieces[start:end] if p.words}
    parts: dict[int, list[str]] = {}
    for block, text, path in page.texts:
        if block in chosen and page.side(path) is None:
            parts.setdefault(block, []).append(text)
    joined = (_WHITE.sub(" ", "".join(parts[block])).strip() for block in sorted(parts))
    return "\n\n".join(text for text in joined if text)


def main_text(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(page_id, url, text) of every page."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(source, weights) for source in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    return map_batches(
        pages.select("page_id", "url", "html"), run, "page_id long, url string, text string"
    )

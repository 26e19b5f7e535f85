"""Main text of web pages as the maximum-scoring run of words and tags (operator 5).

A page is a row of words and tags. Words score by the block they stand in, by
whether they are a link, and by the names of the elements around them and their
classes, ids and roles; tags by their name. All scores are log odds of being
inside the content, counted on pages that mark their content themselves. What
is known of names beforehand, of menus, adverts, forms and the like, is a first
guess that counts give way to. One linear scan finds the run with the largest
sum: words are positive but for those of such parts, tags are negative. Blocks
in the run that score against it, with content on both sides, are holes and left
out. Nothing is left out by name but scripts, styles and what is not shown.

A page is read in time linear in its length, whatever is open or broken in it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackmart.llm.common import arrow_map, rows_of, small_batches

NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
SIGN = re.compile("[\"'>]")
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?",
                       re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template svg iframe textarea select title object canvas".split())

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
INLINE = frozenset("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
#: Names of elements, and parts of class, id and role names, that are a guess against their content.
ASIDE = frozenset("nav footer aside form button menu dialog fieldset head header".split())
CUES = ASIDE | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "navbar navigation breadcrumb breadcrumbs sidebar side masthead cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe subscription signup login search share sharing "
    "social related recommended recommendations comment comments respond disqus reply replies widget "
    "toolbar pagination pager copyright disclaimer alert contentinfo complementary toc skip".split())
#: Beginnings of names that speak of something beside the element.
LINKED = frozenset("has with without no not".split())
MARKED = ("article", "main")
#: Elements whose names say nothing: a page has one of each, or they mark what is looked for.
PLAIN = frozenset(("html", "body", *MARKED))
#: Counts (inside, outside) that a name begins with; unknown names begin as (1, 4).
PRIOR_TAG = {**dict.fromkeys(INLINE | {"p", "h1", "h2", "h3", "li", "blockquote", "pre"}, (4, 4))}
PRIOR_WORD = (6, 1)
PRIOR_LINK = (2, 4)
#: The guess against a name, and the words counted under it that halve the guess.
GUESS, HALVES = -4.0, 20
#: Around a word as many elements count; one word scores so much at most.
DEEP, MOST = 16, 3.0
#: What a tag inside a part that scores against the content costs, and what all words in a row
#: that score so cost together, so that content goes on after such a part.
APART_TAG, APART = -0.02, -1.0
#: A block whose words score less on average is a hole in the run.
HOLE = -1.0
#: Pages that the scores are fitted on.
FIT_PAGES = 10_000

#: An element: its name, and the parts of its class, id and role names.
Element = tuple[str, tuple[str, ...]]
#: A piece of a page: kind (word, link or tag with a name), the elements around it, nearest first,
#: words, text, whether a block ends here, whether the page marks it as content.
Piece = tuple[str, tuple[Element, ...], int, str, bool, bool]


def _names(attrs: str) -> tuple[tuple[str, ...], bool]:
    """Parts of the names in the attributes of a tag, and whether the element is not shown."""
    parts, hidden = [], False
    for key, value in ATTRIBUTE.findall(attrs) if attrs else ():
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif key == "style":
            hidden = hidden or bool(
                re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif key != "aria-hidden":
            for one in value.split():  # what an element has or lacks is not what it is
                found = [part.lower() for part in NAME_PART.findall(one)]
                parts += found if not found or found[0] not in LINKED else found[:1]
    return tuple(sorted(set(parts)))[:DEEP], hidden


class Signs:
    """Finds where tags end; what is not found is not looked for again."""

    def __init__(self, page: str):
        self.page = page
        self.lost: set[str] = set()

    def find(self, what: str, at: int) -> int:
        if what in self.lost:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.lost.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """Where the tag that begins at ``at`` has its last sign, quotes closed; or -1."""
        if self.find(">", at) < 0:
            return -1
        while (sign := SIGN.search(self.page, at)) is not None:
            if sign[0] == ">":
                return sign.start()
            close = self.find(sign[0], sign.end())
            if close < 0:  # a lone quote
                return self.find(">", sign.end())
            at = close + 1
        self.lost.add(">")  # behind quotes to the end of the page
        return -1

    def raw_end(self, name: str, at: int) -> int:
        """Where an element without markup ends, or the page does."""
        if f"</{name}" in self.lost:
            return len(self.page)
        found = re.compile(rf"</{name}\s*>", re.I).search(self.page, at)
        if found is None:
            self.lost.add(f"</{name}")
        return len(self.page) if found is None else found.end()


class _Open:
    """The elements that are open."""

    def __init__(self) -> None:
        # Of each: name, the nearest block at or below it, the elements around its content, hidden.
        self.stack: list[tuple[str, int, tuple[Element, ...], bool]] = []
        self.counts: Counter = Counter()
        self.hidden = self.marks = 0

    @property
    def around(self) -> tuple[Element, ...]:
        return self.stack[-1][2] if self.stack else ()

    @property
    def marked(self) -> bool:
        return self.marks > 0

    def block(self) -> int:
        return self.stack[-1][1] if self.stack else -1

    def block_name(self) -> str:
        return self.stack[self.block()][0] if self.block() >= 0 else "body"

    def push(self, name: str, attrs: str) -> None:
        names, hidden = _names(attrs)
        around, element = self.around, (name, names)
        if self.marked:  # the header of marked content is not that of the page
            element = ("content-" * (name == "header") + name,
                       tuple(part for part in names if part != "header"))
        if name not in PLAIN and name not in INLINE and name != "p" and element not in around or names:
            around = (element, *around[:DEEP - 1]) if element not in around else around
        block = len(self.stack) if name in BLOCKS else self.block()
        self.stack.append((name, block, around, hidden))
        self.counts[name] += 1
        self.marks += name in MARKED
        self.hidden += hidden

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            name, _, _, hidden = self.stack.pop()
            self.counts[name] -= 1
            self.marks -= name in MARKED
            self.hidden -= hidden

    def close(self, name: str) -> None:
        if self.counts[name]:
            size = len(self.stack) - 1
            while self.stack[size][0] != name:
                size -= 1
            self.pop_to(size)

    def begin_block(self, name: str) -> None:
        """A block ends an open paragraph, an item or cell its like."""
        at = self.block()
        if at >= 0 and self.stack[at][0] in ("p", name) and self.stack[at][0] in (
                "p", "li", "td", "tr", "dd", "dt"):
            self.pop_to(at)


def pieces(page: str) -> list[Piece]:
    """The words and tags of a page in order, entities decoded; what is not shown is left out."""
    out: list[Piece] = []
    open_, signs = _Open(), Signs(page)
    last = 0

    def text(raw: str) -> None:
        raw = unescape(raw) if "&" in raw else raw
        if raw and not open_.hidden:
            kind = f"{'link' if open_.counts['a'] else 'word'}:{open_.block_name()}"
            out.append((kind, open_.around, len(raw.split()), raw, False, open_.marked))

    at = page.find("<")
    while at >= 0:
        name, attrs, end = None, "", -1
        if page.startswith("<!--", at):
            close = signs.find("-->", at + 4)
            end = len(page) if close < 0 else close + 3
        elif page[at + 1:at + 2] in ("!", "?"):
            close = signs.find(">", at)
            end = len(page) if close < 0 else close + 1
        elif found := NAME.match(page, at + 1):
            close = signs.tag_end(found.end())
            if close >= 0:
                name, attrs, end = found[2].lower(), page[found.end():close], close + 1
        if end < 0:  # a lone sign is text
            at = page.find("<", at + 1)
            continue
        if at > last:
            text(page[last:at])
        if name in RAW and not found[1] and not attrs.endswith("/"):
            end, name = signs.raw_end(name, end), None
        last = end
        at = page.find("<", end)
        if name is None:
            continue
        breaks = name in BLOCKS or name not in INLINE and name not in VOID
        inside, around = open_.marked, open_.around  # the end of a part belongs to it
        if found[1]:
            open_.close(name)
            inside = inside and open_.marked
        else:
            if breaks:
                open_.begin_block(name)
            if name not in VOID and not attrs.rstrip().endswith("/"):
                open_.push(name, attrs)
                around = open_.around
        known = name if name in BLOCKS or name in INLINE or name in VOID else "other"
        out.append((f"tag:{known}", around, 0, " " if name == "br" else "", breaks, inside))
    if last < len(page):
        text(page[last:])
    return out


class RegionModel:
    """Scores of words and tags. ``counts`` are (inside, outside) by kind of piece, and of words
    by ``name:``, an element around them, and ``part:``, a part of its names."""

    def __init__(self, counts: dict[str, tuple[int, int]], use_names: bool = True):
        self.counts, self.use_names = counts, use_names
        inside, outside = counts.get("words", (0, 0))
        self.share = (inside + 6) / (inside + outside + 8)
        self.known: dict[object, float] = {}

    def _kind(self, kind: str) -> float:
        sort, name = kind.split(":")
        prior = (PRIOR_TAG.get(name, (1, 4)) if sort == "tag"
                 else PRIOR_WORD if sort == "word" else PRIOR_LINK)
        inside, outside = self.counts.get(kind, (0, 0))
        odds = math.log((inside + prior[0]) / (outside + prior[1]))
        return min(max(odds, -6.0), -0.05) if sort == "tag" else min(max(odds, -MOST), MOST)

    def _name(self, feature: str, guessed: bool) -> float:
        """How much an element's name or part raises the odds of what it holds."""
        inside, outside = self.counts.get(feature, (0, 0))
        odds = math.log((inside + 4 * self.share) / (outside + 4 * (1 - self.share)))
        guess = GUESS * HALVES / (HALVES + inside + outside) if guessed else 0.0
        return min(max(odds - math.log(self.share / (1 - self.share)) + guess, GUESS), -GUESS)

    def _element(self, element: Element) -> float:
        name, parts = element
        own = 0.0 if name in PLAIN else self._name(f"name:{name}", name in ASIDE)
        named = [0.0, *(self._name(f"part:{part}", part in CUES) for part in parts)]
        return own + min(named) + max(named)

    def around(self, elements: tuple[Element, ...]) -> float:
        """What the elements around a piece say about it."""
        if not self.use_names or not elements:
            return 0.0
        if elements not in self.known:
            total = 0.0
            for element in elements:
                if element not in self.known:
                    self.known[element] = self._element(element)
                total += self.known[element]
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[elements] = total
        return self.known[elements]

    def score(self, piece: Piece) -> float:
        """Of one word, or of a tag."""
        kind, elements = piece[:2]
        if kind not in self.known:
            self.known[kind] = self._kind(kind)
        around = self.around(elements)
        if kind[0] == "t":
            return self.known[kind] if around > HOLE else APART_TAG
        return min(max(self.known[kind] + around, -MOST), MOST)

    def scores(self, row: list[Piece]) -> list[float]:
        """Of every piece; words in a row that score against the content cost ``APART`` at most."""
        out = [self.score(piece) * (piece[2] if piece[0][0] != "t" else 1) for piece in row]
        words = [i for i, piece in enumerate(row) if piece[0][0] != "t" and piece[2]]
        for against, group in groupby(words, lambda i: out[i] < 0):
            if against:
                run = list(group)
                total = sum(out[i] for i in run)
                for i in run if total < APART else ():
                    out[i] *= APART / total
        return out

    def region(self, scores: list[float]) -> tuple[int, int]:
        """First and last + 1 of the run with the largest sum; of equal ones the first, and of
        those the shortest. An empty run where no sum is above zero."""
        best, best_at, total, start = 0.0, (0, 0), 0.0, 0
        for i, score in enumerate(scores):
            if total <= 0:
                total, start = 0.0, i
            total += score
            if total > best + 1e-9:
                best, best_at = total, (start, i + 1)
        return best_at

    def text(self, row: list[Piece]) -> str:
        """The text of the best run less its holes, a line for each block."""
        first, last = self.region(self.scores(row))
        blocks: list[tuple[str, float]] = []  # text, mean score of its words
        parts, total, words = [], 0.0, 0
        for piece in [*row[first:last], ("tag:p", (), 0, "", True, False)]:
            if piece[4]:
                line = " ".join("".join(parts).split())
                if line:
                    blocks.append((line, total / max(words, 1)))
                parts, total, words = [], 0.0, 0
            if piece[3]:
                parts.append(piece[3])
                total += self.score(piece) * piece[2] if piece[2] else 0.0
                words += piece[2]
        content = [i for i, (_, mean) in enumerate(blocks) if mean >= HOLE]
        if not content:
            return "\n".join(line for line, _ in blocks)
        return "\n".join(line for i, (line, mean) in enumerate(blocks)
                         if mean >= HOLE or not content[0] < i < content[-1])


class Extractor:
    """The model, and for pages of which names leave nothing the same without names."""

    def __init__(self, counts: dict[str, tuple[int, int]]):
        self.models = RegionModel(counts), RegionModel(counts, use_names=False)

    def extract(self, page: str | None) -> str:
        row = pieces(page or "")
        return next(filter(None, (model.text(row) for model in self.models)), "")


def class_counts(page: str | None) -> Counter:
    """(feature, inside) counts of a page that marks its content exactly once; else nothing."""
    row = pieces(page or "")
    marks = sum(1 for piece in row if piece[0] in ("tag:article", "tag:main"))
    if not any(piece[5] for piece in row) or marks > 2:
        return Counter()
    found: Counter = Counter()
    for kind, around, words, _, _, inside in row:
        if kind[0] == "t":
            found[kind, inside] += 1
        elif words:
            features = {kind, "words"}
            for name, parts in around:
                features.add(f"name:{name}")
                features.update(f"part:{part}" for part in parts)
            for feature in features:
                found[feature, inside] += words
    return found


#: Names that are not seen on so many pages of the sample say nothing and are not kept.
LEAST_PAGES, MOST_NAMES = 2, 20_000


def fit_regions(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, tuple[int, int]]:
    """Counts from pages that mark their content with one article or main element.

    ``fit_pages`` ids at most, chosen by their hash, are looked at, and of the
    names on them at most ``MOST_NAMES``, the most common ones, are kept. Pages
    without such marks leave the scores as they begin.
    """
    order = F.xxhash64("page_id")
    ids = pages.select("page_id").filter("page_id is not null").distinct()
    chosen = ids.orderBy(order, "page_id").limit(fit_pages)
    pages = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        total: Counter = Counter()
        seen: Counter = Counter()
        for (page,) in rows_of(batches, "html"):
            found = class_counts(page)
            total.update(found)
            seen.update({kind for kind, _ in found})
        for kind, n in seen.items():
            yield kind, total[kind, True], total[kind, False], n

    counted = arrow_map(pages.select("html"), count,
                        "kind string, inside long, outside long, pages long")
    sums = counted.groupBy("kind").agg(
        F.sum("inside").alias("inside"), F.sum("outside").alias("outside"),
        F.sum("pages").alias("pages"))
    kept = sums.filter((F.col("pages") >= LEAST_PAGES) | ~F.col("kind").rlike("^(name|part):"))
    rows = kept.orderBy(F.desc("pages"), "kind").limit(MOST_NAMES).collect()
    return {row["kind"]: (row["inside"], row["outside"]) for row in rows}


def extract_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty html, or one without words in its content, gives an empty
    text. Pages are taken whole, however long or broken: an element that is not
    closed ends with the page, a quote that is not closed is a sign like others.
    Character references are decoded, a run of white space in a block is one
    space, a line break element counts as white space. Other columns of
    ``pages`` are ignored; repeated rows are extracted alike. Empty in, empty
    out.
    """
    spark = pages.sparkSession
    small_batches(spark)
    counts = spark.sparkContext.broadcast(fit_regions(pages))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        fitted = Extractor(counts.value)
        for page_id, url, page in rows_of(batches, "page_id", "url", "html"):
            text = fitted.extract(page)
            yield page_id, url, text, len(text)

    return arrow_map(pages.select("page_id", "url", "html"), rows,
                     "page_id long, url string, text string, n_chars long")

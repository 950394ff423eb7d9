"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page is a row of tokens. Words score above zero, tags below; one linear scan finds the
stretch with the largest sum, and the blocks in it are the text. Weights are log odds of a
token being inside the main content, counted over all tokens of a bounded number of
labelled pages:

* Names of elements that hold blocks, and words of their class, id and role, are found to
  be *aside* if labelled pages have more words outside than inside under them. A name is
  counted only where no other aside name explains the words (a ``ul`` in a ``nav``).
* Elements under an aside name are left out, and weigh on the scan as two light tags, however
  long they are. A word in a link weighs below zero as far as the labelled pages say so; all
  other words have one weight above zero.
* A tag's weight comes from its places outside aside elements.

The tags of the labelled element itself never lie inside the main content, so a stretch
does not cross them, and on a page that has one, words outside it weigh below zero. Inside the best stretch, elements whose own words sum below zero are
left out too (a list of links between paragraphs). What a browser does not show (scripts, styles,
elements marked hidden) is no token at all.

``PRIOR`` words outside are counted in advance for the elements that HTML defines as beside
the main content, and for a few exact class words; labelled pages outweigh them.

Labels: by default the content of a page's ``article`` element. Pages without one are not
learned from, and are extracted like all others.

Defined results: NULL and empty html give the empty text. Markup that is cut off or wrong
is read as far as it goes; a ``<`` that starts no whole tag is text. Time is linear in the
page's length. ``br`` is white space in a block. Equal sums: the first stretch. An empty
table gives no rows; without labelled pages the weights are ``WORD`` and ``TAG``, and those
of the counts in advance.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import as_bytes

LABELLED = 500  # pages that the weights are counted on
SEEN_ON = 5  # labelled pages that a class word must be on
PRIOR = 5  # words outside
WORD, TAG = 1.0, -2.0
HEAVIEST, LIGHTEST = -12.0, -0.05  # bounds of a tag's weight
EDGE = -1e9  # weight of the labelled element's tags
LABEL = "article"

# Element names of HTML by their role.
HIDDEN = set(
    "head title script style noscript template svg math textarea select button iframe object canvas audio video".split()
)
TEXT_BLOCKS = set(
    "address blockquote caption center dd dt figcaption h1 h2 h3 h4 h5 h6 hr legend li p pre summary td th tr".split()
)
HOLDERS = set(
    "article aside body details dialog div dl fieldset figure footer form header html main menu nav ol section table "
    "tbody tfoot thead ul".split()
)
BLOCKS = TEXT_BLOCKS | HOLDERS
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title".split())
# Elements beside the main content by their definition, and class words counted in advance.
BESIDE = set(
    "aside dialog fieldset footer form header menu nav "
    ".ad .ads .advert .advertisement .banner .comments .cookie .cookie-notice .menu .navigation .newsletter .notice "
    ".promo .sidebar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^<>]*>"
    r"|<(/?)([a-zA-Z][^\s<>/]*+)((?:[^<>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)>"
    r"|<?[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'<>]++)))?")


def attributes(source: str) -> dict[str, str]:
    return {name.lower(): a or b or c for name, a, b, c in ATTRIBUTE.findall(source)}


def is_unseen(found: dict[str, str]) -> bool:
    return (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in re.sub(r"\s", "", found.get("style", "").lower())
    )


class Page:
    """The tokens of a page, and the elements that they stand in.

    ``tokens`` has (tag, text, element): tags as ``p``, ``/p``, texts with an empty tag.
    ``elements`` has (parent, names): the name of the element and its class words, or ``a``
    for a link. Element 0 is the page. ``ends`` are first and last token of each element.
    """

    def __init__(self, page: str):
        self.tokens: list[tuple[str, str, int]] = []
        self.elements: list[tuple[int, tuple[str, ...]]] = [(0, ())]
        self.ends: list[list[int]] = [[0, -1]]
        self._stack: list[tuple[str, int]] = [("", 0)]
        self._open: Counter[str] = Counter()
        place, skipped, depth = 0, "", 0
        while match := TOKEN.match(page, place):
            place = match.end()
            if match[2] is None:
                if not skipped and not match[0].startswith(("<!", "<?")):
                    self._add("", match[0])
                continue
            name, closing, empty = match[2].lower(), bool(match[1]), match[3].endswith("/")
            if not closing and name in RAW:  # no tags inside
                end = re.compile(f"</{name}", re.I).search(page, place)
                place = end.start() if end else len(page)
            if skipped == "head" and name == "body":  # an end tag is missing
                skipped = ""
            if skipped:
                if name == skipped:
                    depth += -1 if closing else 1
                if depth == 0:
                    skipped = ""
            elif closing:
                self._add(f"/{name}")
                self._close(name)
            else:
                found = attributes(match[3]) if match[3] else {}
                if name in HIDDEN or is_unseen(found):
                    if name not in VOID and not (empty and name in HIDDEN):
                        skipped, depth = name, 1
                else:
                    self._enter(name, found)
                    self._add(name)
        self._close("")
        self.ends[0][1] = len(self.tokens)

    def _add(self, tag: str, text: str = "") -> None:
        self.tokens.append((tag, text, self._stack[-1][1]))

    def _enter(self, name: str, found: dict[str, str]) -> None:
        if name in (LABEL, "main", "body"):  # what is still open before it was not closed
            self._close("")
        elif name == "a" or name in TEXT_BLOCKS:
            self._leave_link()
        if name in HOLDERS:
            words = " ".join(found.get(a, "") for a in ("class", "id", "role")).lower().split()
            names = ("",) if name == "header" and self._open[LABEL] else (name,)
            names += tuple(f".{w}" for w in dict.fromkeys(words))
        elif name == "a" and "href" in found:
            names = ("a",)
        else:
            return
        self.elements.append((self._stack[-1][1], names))
        self.ends.append([len(self.tokens), -1])
        self._stack.append((name, len(self.elements) - 1))
        self._open[name] += 1

    def _leave_link(self) -> None:
        if self._stack[-1][0] == "a":
            self._close("a")

    def _close(self, name: str) -> None:
        """End an element and those still open in it; without a name, all."""
        if name in TEXT_BLOCKS:
            self._leave_link()
        if name and not self._open[name]:
            return
        while len(self._stack) > 1:
            ended, element = self._stack.pop()
            self._open[ended] -= 1
            self.ends[element][1] = len(self.tokens)
            if ended == name:
                break


class Weights:
    """Weights of plain words, of names that make words aside, and of tags."""

    def __init__(
        self,
        word: float = WORD,
        names: dict[str, float] | None = None,
        tags: dict[str, float] | None = None,
    ):
        self.word, self.tags = word, tags or {}
        self.names = dict.fromkeys(BESIDE, -WORD) if names is None else names

    def of_tag(self, tag: str) -> float:
        found = self.tags.get(tag)
        if found is None:
            found = TAG if tag.lstrip("/") in BLOCKS else LIGHTEST
        return found

    def aside(self, page: Page) -> list[float]:
        """Per element the weight of its words: below zero, or 0 for plain ones."""
        found = [0.0] * len(page.elements)
        for i, (parent, names) in enumerate(page.elements[1:], 1):
            found[i] = min(found[parent], *(self.names.get(n, 0.0) for n in names))
        return found


def _sides(page: Page) -> list[bool]:
    """Per token whether it lies inside the label."""
    depth, inside = 0, []
    for tag, _, _ in page.tokens:
        depth -= tag == f"/{LABEL}" and depth > 0
        inside.append(depth > 0)
        depth += tag == LABEL
    return inside


def _below(pages: list[Page], sides: list[list[bool]], known: dict[str, float]) -> dict[str, tuple[float, float, int]]:
    """Per name: words inside and outside under it that no other known name explains, and pages."""
    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    on: Counter[str] = Counter()
    for page, side in zip(pages, sides):
        explained = Weights(names=known).aside(page)
        words = [[0, 0] for _ in page.elements]
        for (tag, text, element), within in zip(page.tokens, side):
            if not tag:
                words[element][within] += len(text.split())
        seen = set()
        for i in range(len(words) - 1, 0, -1):  # elements stand behind their parents
            parent, names = page.elements[i]
            own_known = any(known.get(n, 0.0) < 0 for n in names)
            for name in filter(None, names):
                seen.add(name)
                if name == "a" or known.get(name, 0.0) < 0 or not (own_known or explained[parent] < 0):
                    outside[name] += words[i][0]
                    inside[name] += words[i][1]
            words[parent][0] += words[i][0]
            words[parent][1] += words[i][1]
        on.update(seen)
    return {n: (inside[n], outside[n], on[n]) for n in on}


def _odds(counts: dict[str, tuple[float, float, int]]) -> dict[str, float]:
    """Names with more words outside than inside, and their weight."""
    found = {}
    for name in counts.keys() | BESIDE:
        inside, outside, pages = counts.get(name, (0, 0, 0))
        if name in BESIDE:
            outside += PRIOR
        elif pages < SEEN_ON:
            continue
        odds = math.log((inside + 0.5) / (outside + 0.5))
        if odds < 0:
            found[name] = max(odds, -WORD)
    return found


def fit(labelled: list[str]) -> Weights:
    """Weights from pages whose main content is their ``article`` element."""
    pages = [Page(p) for p in labelled]
    sides = [_sides(p) for p in pages]
    if not any(map(any, sides)):
        return Weights()
    # class words and elements beside the main content explain words first, other names what is left
    first = {n: c for n, c in _below(pages, sides, {}).items() if n[0] == "." or n in BESIDE}
    known = _odds(first)
    rest = {n: c for n, c in _below(pages, sides, known).items() if n[0] != "." and n not in BESIDE | {"body", "html"}}
    names = known | {n: w for n, w in _odds(rest).items() if n not in BESIDE}

    inside: Counter[str] = Counter()
    outside: Counter[str] = Counter()
    weights = Weights(names=names)
    for page, side in zip(pages, sides):
        aside = weights.aside(page)
        for (tag, text, element), within in zip(page.tokens, side):
            if aside[element] == 0:
                (inside if within else outside)[tag or " word"] += 1 if tag else len(text.split())
    n_in, n_out = sum(inside.values()), sum(outside.values())
    odds = {
        t: math.log((inside[t] + 0.5) / (n_in + 1)) - math.log((outside[t] + 0.5) / (n_out + 1))
        for t in inside.keys() | outside.keys()
    }
    word = math.log((inside[" word"] + 0.5) / (outside[" word"] + 0.5))
    tags = {t: min(max(x, HEAVIEST), LIGHTEST) for t, x in odds.items() if t != " word"}
    tags |= {LABEL: EDGE, f"/{LABEL}": EDGE}
    return Weights(min(max(word, WORD / 2), WORD), names, tags)


def _best(scores: list[float]) -> tuple[int, int]:
    """The stretch with the largest sum above zero, the first of equal ones."""
    best = total = 0.0
    start, stretch = 0, (0, 0)
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, stretch = total, (start, i + 1)
    return stretch


def main_text(source: str, weights: Weights) -> str:
    """The blocks of the best stretch, in page order, with an empty line between them."""
    page = Page(source)
    aside = weights.aside(page)
    out = [False] * len(aside)  # elements that are left out
    for i, (parent, names) in enumerate(page.elements[1:], 1):
        out[i] = out[parent] or (names != ("a",) and any(weights.names.get(n, 0.0) < 0 for n in names))
    scores = []
    sums = [0.0] * len(aside)
    for tag, text, element in page.tokens:
        if tag.lstrip("/") == LABEL:
            scores.append(weights.of_tag(tag))
        elif out[element]:
            scores.append(LIGHTEST if tag and not out[page.elements[element][0]] else 0.0)
        elif tag:
            scores.append(LIGHTEST if aside[element] else weights.of_tag(tag))
        else:
            scores.append((aside[element] or weights.word) * len(text.split()))
            sums[element] += scores[-1]
    if LABEL in weights.tags and any(tag == LABEL for tag, _, _ in page.tokens):
        scores = [s if inside else min(s, -s) for s, inside in zip(scores, _sides(page))]
    first, last = _best(scores)

    for i in range(len(sums) - 1, 0, -1):
        sums[page.elements[i][0]] += sums[i]
    for i, (parent, names) in enumerate(page.elements[1:], 1):
        start, end = page.ends[i]
        lost = names != ("a",) and sums[i] < 0 and start >= first and end <= last
        out[i] = out[i] or out[parent] or lost

    blocks: list[list[str]] = [[]]
    for tag, text, element in page.tokens[first:last]:
        if tag == "br":
            blocks[-1].append(" ")
        elif tag:
            if tag.lstrip("/") in BLOCKS and blocks[-1]:
                blocks.append([])
        elif not out[element]:
            blocks[-1].append(html.unescape(text))
    texts = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(filter(None, texts))


def labelled_pages(pages: DataFrame, most: int = LABELLED) -> list[str]:
    """A bounded number of pages that have a label, those with the smallest hash first."""
    marked = pages.filter(F.col("html").rlike("(?i)<article[ >]") & (F.length("html") < 200_000))
    hashes = marked.select(F.xxhash64("html").alias("h")).distinct().orderBy("h").limit(most)
    limit = hashes.agg(F.max("h")).first()[0]
    if limit is None:
        return []
    few = marked.select("html", F.xxhash64("html").alias("h")).filter(F.col("h") <= limit)
    return [r[0] for r in few.groupBy("h").agg(F.first("html")).select("first(html)").collect()]


def extract(pages: DataFrame, weights: Weights | None = None) -> DataFrame:
    """``pages`` with the column ``text``; extra columns stay."""
    found = weights or fit(labelled_pages(pages))
    sent = pages.sparkSession.sparkContext.broadcast(found)
    kept = pages.drop("html", "text") if "text" in pages.columns else pages.drop("html")
    schema = StructType([*kept.schema, StructField("text", StringType())])
    source = pages.select(*kept.columns, "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = sent.value
        for batch in batches:
            texts = [main_text(p.decode(), weights) for p in as_bytes(batch.column(batch.num_columns - 1))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)

"""Main text of web pages by a maximum-scoring run of words and tags.

A page is cut into text and tags. Elements that are never main text (see :data:`OUT` and
:data:`OUT_NAMES`) are passed over with all they hold. Each word of the rest has a positive
score, each tag a negative one; one linear scan finds the contiguous run of the highest
total, and its blocks are the text.

Scores are log ratios of how often a kind of token (word, or tag by name) stands inside
and outside the main text of labelled pages: pages that mark it with one ``article`` or
``main`` element. Counts come from a bounded sample of pages. Tags that such pages have
inside cost little; those that occur around the main text cost much.

Defined results: null or empty pages, and pages without words outside passed-over elements,
have an empty text. Character references are decoded, white space within a block is one
space, blocks are joined by a line end; ``br`` is white space. Tags may be unclosed: a
passed-over element without an end reaches to the end of the page. Without labelled pages
every tag costs :data:`USUAL`. Other columns stay.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.llm.common import map_text

#: Pages that scores are estimated on at most, in expectation; tag names that get a score.
SAMPLE_PAGES = 5_000
TAG_NAMES = 300
#: Score of a tag that labelled pages do not have, and least and greatest cost of the others;
#: bounds of a word's score.
USUAL, LEAST, MOST = -0.05, -0.05, -400.0
WORD = (0.25, 1.0)
#: Log ratios of tags outside the main text are multiplied by this.
AROUND = 40.0

OUT = frozenset(
    "head script style noscript template iframe svg math object canvas nav aside footer form button select textarea "
    "menu dialog audio video map".split()
)
#: Names (in class, id or role) of what is no main text.
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar comment comments "
    "disqus cookie cookies consent notice notices notification alert newsletter subscribe subscription share sharing "
    "social related recommended menu nav navbar navigation breadcrumb breadcrumbs footer masthead popup modal overlay "
    "login signup search complementary contentinfo".split()
)
_NOT_FIRST = frozenset("with has no without".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 header hr "
    "html li main ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*)>"
    r"|<[/!?][^<>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_MAIN = frozenset(("article", "main"))


class Token(NamedTuple):
    """A tag (``name`` with a leading / for an end) or, without a name, a stretch of text."""

    name: str
    text: str


def _is_out(name: str, attributes: str, in_main: bool) -> bool:
    if name in OUT or name == "header" and not in_main:
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for found in _NAMED.findall(attributes):
        for word in "".join(found).lower().split():
            parts = re.split(r"[-_]+", word)
            if parts[0] in OUT_NAMES or len(parts) == 2 and parts[1] in OUT_NAMES and parts[0] not in _NOT_FIRST:
                return True
    return False


def tokens(page: str) -> list[Token]:
    """Text and tags of a page in order, without passed-over elements."""
    made: list[Token] = []
    at, skipping, depth, mains = 0, "", 0, 0

    def text(until: int) -> None:
        if until > at and not skipping:
            made.append(Token("", html.unescape(page[at:until])))

    for m in _TOKEN.finditer(page):
        text(m.start())
        at = m.end()
        name, attributes = (m[3] or "").lower(), m[4] or ""
        if not name:
            continue
        if skipping:
            implied = skipping in ("p", "li") and not m[2] and name in BLOCKS
            if name == skipping and not implied:
                depth += -1 if m[2] else not attributes.endswith("/")
            if depth and not implied:
                continue
            skipping = ""
            if not implied:
                continue
        if name in _MAIN:
            mains += -1 if m[2] else 1
        if m[2]:
            made.append(Token("/" + name, ""))
        elif name not in VOID and not attributes.endswith("/") and _is_out(name, attributes, mains > 0):
            skipping, depth = name, 1
        else:
            made.append(Token(name, ""))
    text(len(page))
    return made


def count_kinds(page: str) -> Counter:
    """(kind, inside) counts of a labelled page; empty for others. Words have the kind ``""``."""
    found = tokens(page)
    opens = [i for i, t in enumerate(found) if t.name in _MAIN]
    if len(opens) != 1:
        return Counter()
    name = found[opens[0]].name
    closes = [i for i, t in enumerate(found) if t.name == "/" + name and i > opens[0]]
    last = closes[0] if closes else len(found)
    kinds: Counter = Counter()
    for i, t in enumerate(found):
        inside = opens[0] < i < last
        if t.name:
            kinds[t.name, inside] += 1
        elif words := len(t.text.split()):
            kinds["", inside] += words
    return kinds


class Scores(NamedTuple):
    word: float
    tags: dict[str, float]


def estimate(counts: dict[tuple[str, bool], int]) -> Scores:
    """Log ratios of the kinds' shares inside and outside."""
    inside = sum(n for (_, i), n in counts.items() if i) + 1.0
    outside = sum(n for (_, i), n in counts.items() if not i) + 1.0

    def ratio(kind: str) -> float:
        return math.log((counts.get((kind, True), 0) + 0.5) / inside) - math.log((counts.get((kind, False), 0) + 0.5) / outside)

    tags = {}
    for kind in {k for k, _ in counts if k}:
        value = ratio(kind)
        tags[kind] = max(min(value * AROUND, LEAST), MOST) if value < 0 else LEAST
    return Scores(min(max(ratio(""), WORD[0]), WORD[1]) if counts else WORD[1], tags)


def best_run(values: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest positive sum (the first of those): (start, stop)."""
    best, start, stop, total, since = 0.0, 0, 0, 0.0, 0
    for i, value in enumerate(values):
        if total <= 0:
            total, since = 0.0, i
        total += value
        if total > best + 1e-9:
            best, start, stop = total, since, i + 1
    return start, stop


def main_text(page: str, scores: Scores) -> str:
    found = tokens(page)
    values = [scores.tags.get(t.name, USUAL) if t.name else scores.word * len(t.text.split()) for t in found]
    start, stop = best_run(values)
    blocks: list[list[str]] = [[]]
    for t in found[start:stop]:
        if not t.name:
            blocks[-1].append(t.text)
        elif t.name.lstrip("/") in BLOCKS:
            blocks.append([])
        elif t.name == "br":
            blocks[-1].append(" ")
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def train(pages: DataFrame, column: str = "html") -> Scores:
    """Scores from a bounded sample of pages, chosen by a hash of the page itself."""
    known = pages.select(F.col(column).alias("html")).where(F.col("html").isNotNull())
    count = known.count()
    if count > SAMPLE_PAGES:
        known = known.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(SAMPLE_PAGES / count * (1 << 30)))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        total: Counter = Counter()
        for page in batch.column(0).to_pylist():
            total.update(count_kinds(page))
        kinds = [pa.array([k for k, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_())]
        return pa.RecordBatch.from_arrays([*kinds, pa.array(total.values(), pa.int64())], ["kind", "inside", "n"])

    counts = map_text(known, work, "kind string, inside boolean, n long", "html")
    kinds = counts.groupBy("kind").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
        F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside"),
    )
    top = kinds.orderBy((F.col("inside") + F.col("outside")).desc(), "kind").limit(TAG_NAMES).collect()
    return estimate({(r["kind"], i): n for r in top for i, n in ((True, r["inside"]), (False, r["outside"])) if n})


def extract(pages: DataFrame, scores: Scores, column: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of ``column``. A column named as ``text`` is replaced."""
    names = [name for name in pages.columns if name != text]
    word, tags = scores

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Scores(word, tags)
        made = [main_text(page or "", own) for page in batch.column(column).to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, pa.string())], [*names, text])

    kept = pages.select(*[F.col(f"`{name}`") for name in names])
    return map_text(kept, work, StructType([*kept.schema.fields, StructField(text, StringType())]), column)

"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are compared in lower case with runs of white space as one space. An item
of n characters may be off by k = :data:`ERRORS` * n edits. Cut into k + 1 pieces, at
least one piece of it stands unchanged in any text that holds the item with k edits or
fewer. An automaton over all pieces finds their exact hits in one pass over the text;
around each hit, Myers' bit-parallel edit distance decides, a column of the distance
matrix in a few operations on integers of n bits.

The benchmark travels with the tasks, in blocks of at most :data:`BLOCK_CHARS`; a larger
one takes further passes, so that its size bounds time and not memory.

Defined results: a null or empty text has no matches; items shorter than
:data:`LEAST_CHARS` are no passages and match nothing; equal items each match; of
overlapping finds of an item the closest is given (the first of those). Positions are
code points of the original text, ends exclusive. Rows keep their columns.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import fresh, map_text

ERRORS = 0.08
LEAST_CHARS = 20
BLOCK_CHARS = 2_000_000

MATCH = StructType(
    [
        StructField("item_id", LongType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("distance", IntegerType()),
    ]
)
_MATCHES = pa.list_(
    pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("distance", pa.int32())])
)


def plain(text: str) -> str:
    return " ".join(text.lower().split())


def budget(item: str) -> int:
    return int(len(item) * ERRORS)


def pieces(item: str) -> list[tuple[int, str]]:
    """(place, piece): one more of them than there may be edits, of even length."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def closest(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the stretch of ``text`` that is closest to ``item``, the first of those."""
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    everything, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    plus, minus, distance = everything, 0, len(item)
    best = (distance, 0)
    for at, c in enumerate(text, 1):
        same = masks.get(c, 0)
        across = (((same & plus) + plus) ^ plus) | same
        down = same | minus
        up = minus | (everything & ~(across | plus))
        low = plus & across
        distance += bool(up & top) - bool(low & top)
        up, low = up << 1, low << 1
        plus = (low | ~(down | up)) & everything
        minus = up & down & everything
        if distance < best[0]:
            best = (distance, at)
    return best


class Item(NamedTuple):
    id: int | None
    text: str


class Finder:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        self.pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, item in enumerate(items):
            for at, piece in pieces(item.text):
                self.pieces[piece].append((number, at))
        self.automaton = ahocorasick.Automaton()
        for piece in self.pieces:
            self.automaton.add_word(piece, piece)
        if self.pieces:
            self.automaton.make_automaton()

    def stretches(self, text: str) -> list[tuple[int, int, int]]:
        """(item, start, stop) of the stretches in which a piece hit puts an item."""
        starts: dict[int, set[int]] = defaultdict(set)
        for last, piece in self.automaton.iter(text):
            for number, at in self.pieces[piece]:
                starts[number].add(last + 1 - len(piece) - at)
        found = []
        for number, places in sorted(starts.items()):
            item = self.items[number].text
            slack = budget(item)
            for place in sorted(places):
                start, stop = max(place - slack, 0), min(place + len(item) + slack, len(text))
                if found and found[-1][0] == number and start < found[-1][2]:
                    found[-1] = (number, found[-1][1], stop)
                else:
                    found.append((number, start, stop))
        return found

    def find(self, text: str) -> list[dict]:
        if not self.pieces or not text:
            return []
        flat = plain(text)
        found = []
        for number, start, stop in self.stretches(flat):
            item = self.items[number]
            distance, end = closest(item.text, flat[start:stop])
            if distance <= budget(item.text):
                _, back = closest(item.text[::-1], flat[start : start + end][::-1])
                found.append((item.id, start + end - back, start + end, distance))
        if not found:
            return []
        place = _places(text, flat)
        return [
            {"item_id": id, "start": place[a], "end": place[b - 1] + 1 if b > a else place[a], "distance": d}
            for id, a, b, d in sorted(found, key=lambda m: (m[1], m[2], str(m[0])))
        ]


def _places(text: str, flat: str) -> list[int]:
    """Where each character of the plain text stands in the original."""
    places: list[int] = []
    for word in re.finditer(r"\S+", text):
        if places:
            places.append(word.start() - 1)
        for i, c in enumerate(word.group()):
            places.extend([word.start() + i] * len(c.lower()))
    return [*places, len(text)] if len(places) == len(flat) else [min(i, len(text)) for i in range(len(flat) + 1)]


def _blocks(items: DataFrame, id: str, text: str) -> Iterator[list[Item]]:
    """The items, one block after the other, each within the bound on its size."""
    flat = F.trim(F.regexp_replace(F.lower(F.col(text)), r"\s+", " "))
    known = items.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    known = known.where(F.length(flat) >= LEAST_CHARS)
    total = known.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_CHARS))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(count))
    for number in range(count):
        rows = known.where(block == number).orderBy("id", "text").collect()
        found = [Item(row["id"], plain(row["text"])) for row in rows]
        yield [item for item in found if len(item.text) >= LEAST_CHARS]


def mark(docs: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text", matches: str = "matches") -> DataFrame:
    """``docs`` with ``matches``, the items found in each text. A column of that name is replaced."""
    names = [name for name in docs.columns if name != matches]
    marked = docs.select(*[F.col(f"`{name}`") for name in names])
    schema = StructType([*marked.schema.fields, StructField(matches, ArrayType(MATCH))])
    for number, block in enumerate(_blocks(items, id, "text")):
        marked = _pass(marked, block, names, schema, text, matches, more=number > 0)
    return marked


def _pass(marked: DataFrame, block: list[Item], names: list[str], schema: StructType, text: str, matches: str, more: bool):
    finders: list[Finder] = []  # one for each task

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not finders:
            finders.append(Finder(block))
        made = [finders[0].find(body or "") for body in batch.column(text).to_pylist()]
        if more:
            made = [old + new for old, new in zip(batch.column(matches).to_pylist(), made, strict=True)]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(made, _MATCHES)], [*names, matches])

    return map_text(marked, work, schema, text)


def clean(docs: DataFrame, items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """``docs`` without those that hold an item."""
    name = fresh(docs, "matches")
    return mark(docs, items, id, text, name).where(F.size(name) == 0).drop(name)

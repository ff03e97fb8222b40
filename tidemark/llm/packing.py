"""Best-fit packing by patterns: token pieces into sequences of at most ``size`` tokens.

1. Every document is tokenised; longer ones are cut into full pieces at the end, so that
   the first may be shorter.
2. Spark counts the pieces of each length: a histogram of at most ``size`` rows.
3. On that histogram, patterns of few pieces that fill a sequence exactly are enumerated
   (one, two, and three from a grid of lengths) and their repeat counts fitted to it by
   non-negative least squares, one coordinate at a time. Counts are rounded down.
4. The residual histogram is packed best fit, longest first, whole groups of equal
   sequences at once. Work and plan depend on ``size``, not on the number of pieces.
5. Each piece gets a rank within its length, from its place in a range sort, and looks
   up the plan's slot for that rank. A length that a third of all pieces have is spread
   over as many tasks as its share asks for.

Defined results: a null or empty text is the final id alone; pieces of repeated rows are
each packed; no rows, no sequences; ids may be null and order last. Only the columns
named are returned.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import map_text, written

SIZE = 2048
FINAL_ID = 0
#: Step of the lengths that patterns of three are made of, and passes of the fit.
GRID = 16
PASSES = 4


class Vocabulary(NamedTuple):
    """Files of one byte-level vocabulary: as a tokenizer, and as ranks for a faster encoder
    that gives the same ids. Texts that hold a special token's string go to the tokenizer."""

    json: str
    ranks: str
    pattern: str


def public_vocabulary() -> Vocabulary:
    import public_tokenizers

    return Vocabulary(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


class Encoder:
    """Ids of texts, as the vocabulary's tokenizer gives them without added special tokens."""

    def __init__(self, vocabulary: Vocabulary):
        import tiktoken

        with open(vocabulary.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        with open(vocabulary.json, encoding="utf-8") as file:
            self.special = [token["content"] for token in json.load(file)["added_tokens"]]
        self.vocabulary = vocabulary
        self.exact = None

    def encode(self, text: str) -> list[int]:
        if not any(token in text for token in self.special):
            return self.fast.encode_ordinary(text)
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.vocabulary.json)
        return self.exact.encode(text, add_special_tokens=False).ids


def token_pieces(
    docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE, id: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece; ``ids`` adds the tokens."""

    encoders: list[Encoder] = []  # one for each task

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not encoders:
            encoders.append(Encoder(vocabulary))
        rows: list[tuple] = []
        for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = np.array([*encoders[0].encode(body or ""), FINAL_ID], dtype="<u4")
            first = (len(tokens) - 1) % size + 1
            starts = [0, *range(first, len(tokens), size)]
            for piece, (start, stop) in enumerate(zip(starts, [*starts[1:], len(tokens)], strict=True)):
                part = tokens[start:stop]
                rows.append((key, piece, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32) if ids else None))
        key, piece, start, length, crc, part = zip(*rows, strict=True) if rows else ((),) * 6
        columns = [pa.array(key, batch.column(0).type), pa.array(piece, pa.int32())]
        columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
        names = [id, "piece", "start", "length", "ids_crc32"]
        if ids:
            columns.append(pa.array(part, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select(F.col(f"`{id}`"), F.col(f"`{text}`").alias("text"))
    kind = kept.schema[0].dataType.simpleString()
    schema = f"`{id}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return map_text(kept, work, schema)


class Group(NamedTuple):
    """``count`` equal sequences; ``parts`` are (length, copies) in the order they lie in."""

    parts: tuple[tuple[int, int], ...]
    count: int


def patterns(size: int = SIZE, grid: int = GRID) -> list[tuple[int, ...]]:
    """Length patterns of one to three pieces that fill a sequence, longest piece first."""
    found: list[tuple[int, ...]] = [(size,)]
    found += [(size - short, short) for short in range(1, size // 2 + 1)]
    steps = range(grid, size, grid)
    found += [(a, b, size - a - b) for a in steps for b in steps if a >= b >= size - a - b > 0]
    return found


def fit_counts(shapes: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared difference of the pieces that the
    patterns use and those there are, by coordinate descent."""
    counts = np.zeros(len(shapes))
    left = histogram.astype(float)
    uses = [(np.array(sorted(set(s))), np.array([s.count(v) for v in sorted(set(s))], dtype=float)) for s in shapes]
    for _ in range(PASSES):
        moved = 0.0
        for p, (at, times) in enumerate(uses):
            step = max(float(times @ left[at] / (times @ times)), -counts[p])
            if step:
                counts[p] += step
                left[at] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return counts


def best_fit(histogram: np.ndarray, size: int = SIZE) -> list[Group]:
    """Best fit, longest first, over a histogram: equal open sequences move as one group."""
    full: list[Group] = []
    open_at: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = defaultdict(list)
    free = np.zeros(size + 1, dtype=bool)

    def put(parts: tuple[tuple[int, int], ...], count: int, space: int) -> None:
        if space:
            open_at[space].append((parts, count))
            free[space] = True
        else:
            full.append(Group(parts, count))

    for length in range(size, 0, -1):
        left = int(histogram[length])
        while left:
            fitting = np.flatnonzero(free[length:])
            if not len(fitting):
                break
            space = length + int(fitting[0])
            parts, count = open_at[space].pop()
            free[space] = bool(open_at[space])
            copies = space // length
            filled = min(count, left // copies)
            if filled:
                put((*parts, (length, copies)), filled, space - copies * length)
                left -= filled * copies
            if count > filled and left:
                put((*parts, (length, left)), 1, space - left * length)
                filled, left = filled + 1, 0
            if count > filled:
                put(parts, count - filled, space)
        copies = size // length
        if left >= copies:
            put(((length, copies),), left // copies, size - copies * length)
        if left % copies:
            put(((length, left % copies),), 1, size - left % copies * length)
    return full + [Group(parts, count) for groups in open_at.values() for parts, count in groups]


def pack_histogram(histogram: np.ndarray, size: int = SIZE) -> list[Group]:
    """Groups that use each length exactly as often as the histogram has it."""
    left = histogram.astype(np.int64).copy()
    groups: list[Group] = []
    shapes = patterns(size)
    for shape, count in zip(shapes, fit_counts(shapes, left), strict=True):
        parts = tuple((v, shape.count(v)) for v in sorted(set(shape), reverse=True))
        whole = min(int(count + 1e-6), *(int(left[v]) // n for v, n in parts))
        if whole > 0:
            groups.append(Group(parts, whole))
            for v, n in parts:
                left[v] -= whole * n
    return groups + best_fit(left, size)


def slots(groups: list[Group]) -> np.ndarray:
    """(length, first rank, copies, first sequence, offset) rows, in order of length and rank."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for parts, count in groups:
        offset = 0
        for length, copies in parts:
            rows.append((length, used[length], copies, sequence, offset))
            used[length] += count * copies
            offset += length * copies
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def place(lengths: np.ndarray, ranks: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces with these lengths and ranks."""
    keys = table[:, 0] << 48 | table[:, 1]
    row = table[np.searchsorted(keys, lengths << 48 | ranks, side="right") - 1]
    nth = ranks - row[:, 1]
    return row[:, 3] + nth // row[:, 2], row[:, 4] + nth % row[:, 2] * lengths


def pack(pieces: DataFrame, size: int = SIZE, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` (with a column ``length`` of 1 to ``size``) with ``sequence_id`` and ``offset``.

    Besides the histogram, the driver sees one row for each partition of the range sort and
    length in it: their number is that of the partitions plus ``size`` at most, as a range
    sort puts a length into neighbouring partitions.
    """
    sort = [F.col("length").desc(), *[F.col(f"`{name}`").asc_nulls_last() for name in order]]
    ranged = pieces.repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = written(ranged.withColumn("place", F.monotonically_increasing_id()), "pieces")
    part = F.shiftright("place", 33).alias("part")
    runs = placed.groupBy("length", part).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    known = runs.orderBy("first", F.col("length").desc()).collect()
    histogram = np.zeros(size + 1, dtype=np.int64)
    for r in known:
        histogram[r["length"]] += r["n"]
    firsts = np.array([r["first"] for r in known], dtype=np.int64)
    bases = np.array([r["before"] for r in known], dtype=np.int64)
    sent = placed.sparkSession.sparkContext.broadcast((firsts, bases, slots(pack_histogram(histogram, size))))
    names = pieces.columns

    def run(batches):
        firsts, bases, table = sent.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            places = batch.column("place").to_numpy()
            run_of = np.searchsorted(firsts, places, side="right") - 1
            ranks = bases[run_of] + places - firsts[run_of]
            sequence, offset = place(lengths, ranks, table)
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    added = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return placed.mapInArrow(run, StructType([*pieces.schema.fields, *added]))


def pack_documents(
    docs: DataFrame, vocabulary: Vocabulary, size: int = SIZE, id: str = "doc_id", text: str = "text", ids: bool = False
) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    pieces = written(token_pieces(docs, vocabulary, size, id, text, ids), "tokens")
    return pack(pieces, size, (id, "piece"))

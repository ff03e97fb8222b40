"""Document fingerprints by I-Match with randomised lexicons.

The lexicon holds terms whose normalised inverse document frequency, ln(N/df) / ln N, lies
in :data:`BAND`: neither the words of many documents nor rare ones. Document frequencies are
those of 64-bit term hashes, counted over all documents. Tasks get the lexicon as a table of
2^:data:`BITS` bits, one for each value of a term's first bits: its size is fixed, and the share
of terms outside the band that it takes for terms within is at most that of bits set, the number
of terms in the band over 2^:data:`BITS`.

The lexicon and :data:`SUBSETS` random subsets of it, of each of the densities 2^-d, d in
:data:`DEPTHS`, are fixed for all documents. A fingerprint has a value for each: a document's
distinct terms that are in the subset, sorted, are hashed together. Values are 16-bit, and 0
means that the document has no term in the subset. Dense subsets tell small changes, sparse
ones find what large changes leave. The likeness of two fingerprints is the share of equal
values among the :data:`COMPARED` sparsest subsets in which either has a term.

Defined results: a document without terms in the band uses all its terms; one without
words has the fingerprint of the empty set, as like as can be to another such and unlike all
others; equal texts have equal fingerprints. The next document is that of the next larger id
(ties: by the text's hash; after the last the first; alone: itself); rows with the same id and
text are one document and each give the same row; a null id comes last.
"""

from __future__ import annotations

import hashlib
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tidemark.llm.common import BATCH_ROWS, map_text, slices, written
from tidemark.llm.words import FOLD, Words, find_words, mix

#: Terms that a task counts before it passes them on.
TASK_TERMS = 1 << 18
BAND = (0.2, 0.7)
#: First bits of a term's hash that the table of the lexicon goes by: 16 MB, however large the corpus.
BITS = 27
#: Random subsets of each density, and the densities' negative logarithms, from sparse to dense.
SUBSETS = 16
DEPTHS = (12, 10, 8, 6, 4, 2)
#: Values of a fingerprint: the last is that of the whole lexicon.
VALUES = SUBSETS * len(DEPTHS) + 1
COMPARED = 16


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) of the distinct terms of each text, sorted."""
    owner = words.owners()
    order = np.lexsort((words.hashes, owner))
    owner, terms = owner[order], words.hashes[order]
    first = np.ones(len(terms), dtype=bool)
    first[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    return owner[first], terms[first]


def _places(terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of each term in the table of the lexicon."""
    place = terms >> np.uint64(64 - BITS)
    return (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)


def _within(terms: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Whether each of ``terms`` is in the lexicon, by its table ``kept``."""
    word, bit = _places(terms)
    return (kept[word] >> bit) & np.uint64(1) == 1


def _summed(terms: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    both, place = np.unique(np.concatenate(terms), return_inverse=True)
    return both, np.bincount(place, weights=np.concatenate(counts), minlength=len(both)).astype(np.int64)


def lexicon(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The table of the lexicon.

    Frequencies are summed in the map tasks, which hold :data:`TASK_TERMS` terms or so at a time,
    and then by a grouping. Bits are put together by another: the driver gets the table's words
    that are not zero, 2^(:data:`BITS` - 6) at most.
    """

    def counted(terms: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "n"])

    def run(batches):
        terms, counts, size, total = [], [], 0, 0
        for batch in batches:
            own, n = np.unique(_terms(find_words(batch.column(0), FOLD))[1], return_counts=True)
            terms.append(own)
            counts.append(n)
            size += len(own)
            total += batch.num_rows
            if size >= TASK_TERMS:
                both, n = _summed(terms, counts)
                if len(both) * 2 >= TASK_TERMS:
                    yield counted(both, n)
                    terms, counts, size = [], [], 0
                else:
                    terms, counts, size = [both], [n], len(both)
        if terms:
            yield counted(*_summed(terms, counts))
        # Without a term: the number of documents.
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["term", "n"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    counts = docs.select(F.col(f"`{text}`")).mapInArrow(run, "term long, n long")
    counts = written(counts.groupBy("term").agg(F.sum("n").alias("n")), "frequencies")
    total = max((counts.where("term is null").first() or {"n": 1})["n"], 1)
    least, most = (total ** (1 - share) for share in reversed(BAND))
    within = counts.where(F.col("term").isNotNull() & (F.col("n") >= math.floor(least)) & (F.col("n") <= math.ceil(most)))
    place = F.shiftrightunsigned("term", 64 - BITS)
    word, bit = F.shiftright(place, 6), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(term, {64 - BITS}) & 63 AS INT))")
    words = within.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (BITS - 6), dtype=np.uint64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return table


def values(texts: pa.Array, kept: np.ndarray) -> np.ndarray:
    """The fingerprints of the texts: one row of :data:`VALUES` numbers for each."""
    made = np.zeros((len(texts), VALUES), dtype=np.uint16)
    owner, terms = _terms(find_words(texts, FOLD))
    chosen = _within(terms, kept)
    some = np.bincount(owner[chosen], minlength=len(texts)) > 0
    use = chosen | ~some[owner]
    owner, terms = owner[use], terms[use]
    _hash_sets(made[:, -1], owner, terms)
    for subset in range(SUBSETS):
        with np.errstate(over="ignore"):
            drawn = mix(terms + np.uint64(0x9E3779B97F4A7C15 * (subset + 1) % 2**64))
        # A subset's terms are those whose draw begins with so many zeros; denser ones hold sparser ones.
        in_owner, in_drawn = owner, drawn
        for depth, at in sorted((depth, at) for at, depth in enumerate(DEPTHS)):
            inside = in_drawn >> np.uint64(64 - depth) == 0
            in_owner, in_drawn = in_owner[inside], in_drawn[inside]
            _hash_sets(made[:, at * SUBSETS + subset], in_owner, in_drawn)
    return made


def _hash_sets(made: np.ndarray, owner: np.ndarray, terms: np.ndarray) -> None:
    """Put a hash of the terms of each text, which are sorted and distinct, into ``made``."""
    if not len(terms):
        return
    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
    # The sum of the sorted terms, scrambled one by one, is their set's hash, taken for all texts at once.
    with np.errstate(over="ignore"):
        total = mix(np.add.reduceat(mix(terms), firsts))
    made[owner[firsts]] = np.maximum(total >> np.uint64(48), np.uint64(1)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How like the fingerprints in the rows of ``a`` are to those of ``b``."""
    either = (a > 0) | (b > 0)
    counted = either & (np.cumsum(either, axis=1) <= COMPARED)
    n = counted.sum(axis=1)
    return np.where(n > 0, ((a == b) & counted).sum(axis=1) / np.maximum(n, 1), 1.0)


def fingerprints(docs: DataFrame, kept: np.ndarray, columns: dict[str, str]) -> DataFrame:
    """``docs`` with a fingerprint (big-endian 16-bit numbers) for each of the text columns
    ``columns``, under the name given for it; the texts themselves are left out."""
    texts = list(columns)
    names = [name for name in docs.columns if name not in texts]
    sent = docs.sparkSession.sparkContext.broadcast(kept)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [_packed(values(batch.column(text), sent.value)) for text in texts]
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + made, [*names, *columns.values()])

    fields = [docs.schema[n] for n in names] + [StructField(name, BinaryType()) for name in columns.values()]
    return map_text(docs.select(*names, *texts), work, StructType(fields), texts[0])


def _packed(rows: np.ndarray) -> pa.Array:
    data, width = rows.astype(">u2").tobytes(), 2 * VALUES
    return pa.array([data[i : i + width] for i in range(0, len(data), width)], pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=">u2").reshape(-1, VALUES)


def edit(text: str, after: str) -> str:
    """The last quarter of ``text`` replaced by as much of the beginning of ``after``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


class Document(NamedTuple):
    id: int | None
    text: str
    copies: int


_ROW = (
    "part long, first boolean, last boolean, id long, copies long, n_chars long, edited_sha256 string, "
    "fingerprint binary, edited_fingerprint binary, near_edited double, near_next double, text string"
)
_ROW_NAMES = [field.split()[0] for field in _ROW.split(", ")]


def _rows(part: int, first: bool, docs: list[Document], after: Document | None, kept: np.ndarray) -> pa.RecordBatch:
    """A row for each of ``docs``, each followed by the next and the last by ``after``; without
    it the last row stays open. A partition's first and last rows keep their texts."""
    known = [*docs, after] if after else docs
    prints = values(pa.array([d.text for d in known], pa.large_string()), kept)
    edited = [edit(d.text, n.text) for d, n in zip(known, known[1:], strict=False)]
    edited_prints = values(pa.array(edited, pa.large_string()), kept)
    count, done = len(docs), len(edited)
    none = [None] * (count - done)
    ends = [after is None and i == count - 1 for i in range(count)]
    heads = [first and i == 0 for i in range(count)]
    columns = [
        pa.array([part] * count, pa.int64()),
        pa.array(heads, pa.bool_()),
        pa.array(ends, pa.bool_()),
        pa.array([d.id for d in docs], pa.int64()),
        pa.array([d.copies for d in docs], pa.int64()),
        pa.array([len(d.text) for d in docs], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited] + none, pa.string()),
        _packed(prints[:count]),
        pa.array(_packed(edited_prints).to_pylist() + none, pa.binary()),
        pa.array(likeness(prints[:done], edited_prints).tolist() + none, pa.float64()),
        pa.array(likeness(prints[:done], prints[1:]).tolist() + none, pa.float64()),
        pa.array([d.text if h or e else None for d, h, e in zip(docs, heads, ends, strict=True)], pa.string()),
    ]
    return pa.RecordBatch.from_arrays(columns, _ROW_NAMES)


def compare_edits(docs: DataFrame, kept: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next): how a document's fingerprint compares with that of its edited text, in which
    the next document's beginning replaces the last quarter, and with the next document's.

    Texts are shuffled once, into ranges of ids. A task streams its sorted rows, keeping one
    document back until the next is known. What the last document of each partition lacks, the
    first of the next one, is joined to it afterwards: two rows a partition.
    """
    session = docs.sparkSession
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(body).alias("version"), body.alias("text"))
    sort = [F.col("id").asc_nulls_last(), F.col("version").asc()]
    ranged = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    sent = session.sparkContext.broadcast(kept)

    def run(batches):
        part, first, held = TaskContext.get().partitionId(), True, None
        for batch in batches:
            for piece in slices(batch, "text"):
                ready: list[Document] = []
                for key, version, text in zip(*(piece.column(i).to_pylist() for i in range(3)), strict=True):
                    if held and (held[0].id, held[1]) == (key, version):
                        held = (held[0]._replace(copies=held[0].copies + 1), version)
                        continue
                    if held:
                        ready.append(held[0])
                    held = (Document(key, text, 1), version)
                if ready:
                    yield _rows(part, first, ready, held[0], sent.value)
                    first = False
        if held:
            yield _rows(part, first, [held[0]], None, sent.value)

    made = written(ranged.mapInArrow(run, _ROW), "ranges")
    heads = made.where("first").select("part", F.col("text").alias("head"))
    parts, order = heads.select("part"), Window.orderBy("part")  # one number for each partition
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = parts.select(F.col("part").alias("of"), F.coalesce(F.lead("part").over(order), F.first("part").over(whole)).alias("part"))
    lent = after.join(heads, "part").select(F.col("of").alias("part"), "head")
    quarter = F.floor(F.length("text") / 4).cast("int")
    ends = made.where("last").join(lent, "part").withColumn("quarter", quarter)
    ends = ends.withColumn("edited", F.expr("concat(substring(text, 1, length(text) - quarter), substring(head, 1, quarter))"))
    ends = ends.withColumn("edited_sha256", F.sha2("edited", 256))
    ends = ends.drop("edited_fingerprint", "near_edited", "near_next", "text", "quarter")
    ends = fingerprints(ends, kept, {"edited": "edited_fingerprint", "head": "next_fingerprint"})
    both = made.where("not last").drop("text").unionByName(_compared(ends))
    return both.select(
        F.col("id").alias(id),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def _compared(ends: DataFrame) -> DataFrame:
    """Rows with three fingerprints, and how like the first is to the others in place of the last."""
    names = [name for name in ends.columns if name != "next_fingerprint"]

    def run(batches):
        for batch in batches:
            own = _unpacked(batch.column("fingerprint"))
            near = [likeness(own, _unpacked(batch.column(name))) for name in ("edited_fingerprint", "next_fingerprint")]
            columns = [batch.column(name) for name in names] + [pa.array(n) for n in near]
            yield pa.RecordBatch.from_arrays(columns, [*names, "near_edited", "near_next"])

    fields = [*ends.select(*names).schema.fields, *(StructField(name, DoubleType()) for name in ("near_edited", "near_next"))]
    return ends.mapInArrow(run, StructType(fields))

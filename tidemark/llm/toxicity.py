"""Toxic spans by a conditional random field; documents scored by its marginals.

Only documents are labelled, so tokens are labelled from them first: over all labelled
documents outside the held-out fold, words and word beginnings (4 and 5 bytes) are counted
by the number of toxic and of other documents they occur in. Candidates occur in
:data:`LEAST_DOCS` toxic documents or more, at :data:`LIFT` times the rate of the others.
Each toxic document then counts for those of its candidates alone that are at least half
as frequent as its most frequent one, so that words that merely stand in copies of a toxic
document drop out; what is left with :data:`LEAST_DOCS` or more labels the tokens of toxic
documents. The chain is fitted on the bounded sample of :mod:`tidemark.llm.labelled`, in shards whose weights are averaged, with
the token, its beginnings and both neighbours as features, hashed to 2^:data:`BITS` places.

Forward-backward gives each token's probability of being toxic. A document's score is the
largest of them; runs of tokens of 0.5 or more are its spans, in code points of the text.

Defined results: a null or empty text, or one without letters and digits, scores 0 and has
no spans; without labels, or without toxic ones, nothing is found. Rows keep their columns
but for those of the names given; repeated rows score alike.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from tidemark.llm import crf, labelled
from tidemark.llm.common import map_text, written
from tidemark.llm.words import FOLD, NO_LETTER, Words, code_points, find_words, mix

BITS = 20
BEGINNINGS = (4, 5)
LEAST_DOCS = 5
LIFT = 30.0
THRESHOLD = 0.5
PASSES, RATE, SHRINK = 25, 0.4, 1e-3
_SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _own(words: Words) -> list[np.ndarray]:
    """Places of each token's word and beginnings."""
    return [_places(words.hashes), *(_places(words.prefixes(n)) for n in BEGINNINGS)]


def _features(words: Words) -> list[np.ndarray]:
    """Places of each token's features: its own, and its neighbours' words."""
    owner, none = words.owners(), np.uint64(0)
    before, after = np.full(len(owner), none), np.full(len(owner), none)
    if len(owner):
        same = owner[1:] == owner[:-1]
        before[1:] = np.where(same, mix(words.hashes[:-1] + np.uint64(11)), none)
        after[:-1] = np.where(same, mix(words.hashes[1:] + np.uint64(13)), none)
    return [*_own(words), _places(before), _places(after)]


def find_tokens(texts: pa.Array) -> Words:
    return find_words(texts, FOLD, NO_LETTER)


def _by_text(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the distinct words and beginnings of each text."""
    words = find_tokens(batch.column("text"))
    owner = np.tile(words.owners(), 1 + len(BEGINNINGS))
    pairs = np.unique(owner.astype(np.int64) << BITS | np.concatenate(_own(words)))
    return pairs >> BITS, pairs & ((1 << BITS) - 1)


def _candidates(rows: DataFrame) -> np.ndarray:
    """Per place the toxic documents it occurs in, 0 if it is as common in others."""

    def run(batches):
        seen = np.zeros((2, 1 << BITS), dtype=np.int64)
        for batch in batches:
            of, place = _by_text(batch)
            label = batch.column("label").to_numpy()[of]
            for kind in (0, 1):
                seen[kind] += np.bincount(place[label == kind], minlength=1 << BITS)
        at = np.flatnonzero(seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[1][at])], ["at", "toxic"])
        at = np.flatnonzero(seen[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(-seen[0][at])], ["at", "toxic"])

    counts = rows.select("text", "label").mapInArrow(run, "at long, toxic long")
    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    none, some = total.get(0, 0) + 1, total.get(1, 0) + 1
    summed = counts.groupBy("at").agg(
        F.sum(F.greatest("toxic", F.lit(0))).alias("toxic"), F.sum(F.greatest(-F.col("toxic"), F.lit(0))).alias("others")
    )
    rate = F.col("toxic") / some / ((F.col("others") + 0.5) / none)
    strength = np.zeros(1 << BITS, dtype=np.int64)
    for r in summed.where((F.col("toxic") >= LEAST_DOCS) & (rate >= LIFT)).select("at", "toxic").collect():
        strength[r["at"]] = r["toxic"]
    return strength


def token_labels(rows: DataFrame) -> np.ndarray:
    """Whether a place stands for words that make documents toxic.

    ``rows`` has texts and labels. Counts are summed in the map tasks; the driver gets the
    places that pass, 2^:data:`BITS` at most.
    """
    sent = rows.sparkSession.sparkContext.broadcast(_candidates(rows))

    def run(batches):
        seen = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            of, place = _by_text(batch)
            strength = sent.value[place]
            most = np.zeros(batch.num_rows, dtype=np.int64)
            np.maximum.at(most, of, strength)
            np.add.at(seen, place[(strength > 0) & (2 * strength >= most[of])], 1)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["at", "n"])

    credit = rows.where("label = 1").select("text").mapInArrow(run, "at long, n long")
    found = credit.groupBy("at").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_DOCS).select("at").collect()
    marked = np.zeros(1 << BITS, dtype=bool)
    marked[[r["at"] for r in found]] = True
    return marked


class Model(NamedTuple):
    weights: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def tag(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        """Scores and toxic spans of the texts."""
        words = find_tokens(texts)
        emissions = sum(self.weights[at] for at in _features(words)).astype(float)
        chance, _, _ = crf.Lattice(words.bounds).marginals(emissions, crf.Chain(self.start, self.moves))
        scores = np.zeros(len(texts))
        np.maximum.at(scores, words.owners(), chance)
        spans: list[list[dict]] = [[] for _ in range(len(texts))]
        toxic = np.flatnonzero(chance >= THRESHOLD)
        if len(toxic):
            owner, points = words.owners(), code_points(words)
            base = points[words.offsets]
            ends = np.flatnonzero((np.diff(toxic) > 1) | (np.diff(owner[toxic]) > 0))
            for first, last in zip(np.append(0, ends + 1), np.append(ends, len(toxic) - 1), strict=True):
                a, b = toxic[first], toxic[last]
                spans[owner[a]].append(
                    {
                        "start": int(points[words.starts[a]] - base[owner[a]]),
                        "end": int(points[words.ends[b]] - base[owner[a]]),
                        "score": float(chance[a : b + 1].max()),
                    }
                )
        return scores, spans


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text") -> Model:
    """A model of 2^:data:`BITS` weights at most."""
    known = written(labelled.rows(docs, labels, label, id, text), "labelled")
    sent = docs.sparkSession.sparkContext.broadcast(token_labels(known))

    def fit_shard(texts: list[str], marks: np.ndarray):
        words = find_tokens(pa.array(texts, pa.large_string()))
        toxic = sum(sent.value[at].astype(int) for at in _own(words)) > 0
        tags = (toxic & (marks[words.owners()] == 1)).astype(np.int64)
        weights, chain = crf.fit(np.array(_features(words)), words.bounds, tags, 1 << BITS, PASSES, RATE, SHRINK)
        at = np.flatnonzero(np.abs(weights) > 1e-3)
        yield from zip(at.tolist(), weights[at].tolist(), strict=True)
        yield from zip(range(-6, 0), [*chain.start, *chain.moves.reshape(-1)], strict=True)

    at, value = labelled.fit_shards(labelled.share(known, known.count()), fit_shard)
    weights, chain = np.zeros(1 << BITS, dtype=np.float32), np.zeros(6)
    weights[at[at >= 0]] = value[at >= 0]
    chain[at[at < 0] + 6] = value[at < 0]
    return Model(weights, chain[:2], chain[2:].reshape(2, 2))


def score(docs: DataFrame, model: Model | None, text: str = "text", scored: str = "score", spans: str = "spans") -> DataFrame:
    """``docs`` with each document's score and toxic spans."""
    names = [name for name in docs.columns if name not in (scored, spans)]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, found = Model(*sent.value).tag(batch.column(text))
        made = [pa.array(scores), pa.array(found, _SPANS)]
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + made, [*names, scored, spans])

    kept = docs.select(*[F.col(f"`{name}`") for name in names])
    added = [StructField(scored, DoubleType()), StructField(spans, ArrayType(_SPAN))]
    return map_text(kept, work, StructType([*kept.schema.fields, *added]), text)

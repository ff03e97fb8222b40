"""Quality classifier: logistic regression on hashed n-grams, fitted by FTRL-proximal.

Features are single words, pairs of neighbouring words, and the same of runs of
punctuation, hashed to 2^:data:`BITS` places. A pair is hashed by its difference, so all
repetitions of a word share one place. A document is a sparse vector of counts over the
square root of their number; its score is the logistic function of a sparse dot product.

Fitting takes the bounded sample of :mod:`tidemark.llm.labelled`, in shards of which each
makes :data:`EPOCHS` passes; their weights are averaged. Per coordinate, the
follow-the-regularised-leader update keeps a weight at 0 until its gradients exceed ``L1``.

Defined results: an empty or null text has no features and the score of the intercept;
without any labels every score is 0.5; labels of one kind alone pull all scores to it.
Rows keep their columns, but for one of the score's name; repeated rows score alike.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm import labelled
from tidemark.llm.common import map_text
from tidemark.llm.words import Words, find_words, mix

BITS = 18
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.1, 0.1
THRESHOLD = 0.3

_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_NO_WORD = _SIGNS.copy()
_NO_WORD[:33] = True
_NO_SIGN = ~_SIGNS


class Features(NamedTuple):
    """Sparse rows: those of row i are places ``bounds[i]`` to ``bounds[i + 1]``."""

    places: np.ndarray
    values: np.ndarray
    bounds: np.ndarray


def _grams(words: Words, kind: int) -> tuple[np.ndarray, np.ndarray]:
    owner = words.owners()
    with np.errstate(over="ignore"):
        single = mix(words.hashes ^ np.uint64(2 * kind))
        steps = words.hashes[1:] - words.hashes[:-1]
        pair = mix(steps * np.uint64(0x9E3779B97F4A7C15) + np.uint64(2 * kind + 1))
    inside = owner[1:] == owner[:-1]
    return np.concatenate([single, pair[inside]]), np.concatenate([owner, owner[1:][inside]])


def features(texts: pa.Array) -> Features:
    found = [_grams(find_words(texts, separators=apart), k) for k, apart in enumerate((_NO_WORD, _NO_SIGN))]
    hashes, owner = (np.concatenate(x) for x in zip(*found, strict=True))
    keys = owner.astype(np.uint64) << np.uint64(BITS) | hashes >> np.uint64(64 - BITS)
    keys, counts = np.unique(keys, return_counts=True)
    owner = (keys >> np.uint64(BITS)).astype(np.int64)
    total = np.bincount(owner, weights=counts, minlength=len(texts))
    return Features(
        (keys & np.uint64((1 << BITS) - 1)).astype(np.int64),
        counts / np.sqrt(total)[owner],
        np.searchsorted(owner, np.arange(len(texts) + 1)),
    )


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def fit(x: Features, labels: np.ndarray) -> tuple[np.ndarray, float]:
    """FTRL-proximal over the rows in their order; weights and intercept."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0
    for _ in range(EPOCHS):
        for i, label in enumerate(labels):
            row = slice(x.bounds[i], x.bounds[i + 1])
            at, value = x.places[row], x.values[row]
            w, w0 = _weights(z[at], n[at]), -z0 / ((BETA + np.sqrt(n0)) / ALPHA)
            error = _logistic(value @ w + w0) - label
            step = error * value
            z[at] += step - (np.sqrt(n[at] + step**2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += step**2
            z0 += error - (np.sqrt(n0 + error**2) - np.sqrt(n0)) / ALPHA * w0
            n0 += error**2
    return _weights(z, n), -z0 / ((BETA + np.sqrt(n0)) / ALPHA)


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Model(NamedTuple):
    weights: np.ndarray
    intercept: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        x = features(texts)
        rows = len(x.bounds) - 1
        owner = np.repeat(np.arange(rows), np.diff(x.bounds))
        # Added up row by row, so that no score depends on the rows beside it.
        return _logistic(np.bincount(owner, weights=self.weights[x.places] * x.values, minlength=rows) + self.intercept)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id: str = "doc_id", text: str = "text") -> Model:
    """A model of ``label``, of at most 2^:data:`BITS` weights."""

    def fit_shard(texts: list[str], marks: np.ndarray):
        weights, intercept = fit(features(pa.array(texts, pa.large_string())), marks)
        at = np.flatnonzero(weights)
        yield from zip(at.tolist(), weights[at].tolist(), strict=True)
        yield -1, float(intercept)

    at, value = labelled.fit_shards(labelled.rows(docs, labels, label, id, text, labelled.SAMPLE_ROWS), fit_shard)
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[at[at >= 0]] = value[at >= 0]
    intercept = float(value[at < 0].sum())
    return Model(weights, intercept)


def score(docs: DataFrame, model: Model, text: str = "text", scored: str = "score") -> DataFrame:
    """``docs`` with the column ``scored``. The model is a few MB at most, by its fixed size."""
    names = [name for name in docs.columns if name != scored]
    sent = docs.sparkSession.sparkContext.broadcast(tuple(model))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = Model(*sent.value).scores(batch.column(text))
        return pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [pa.array(made)], [*names, scored])

    kept = docs.select(*[f"`{name}`" for name in names])
    return map_text(kept, work, StructType([*kept.schema.fields, StructField(scored, DoubleType())]), text)

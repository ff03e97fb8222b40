"""Labelled rows for fitting: a bounded sample without held-out rows, dealt out to shards."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_ROWS

#: Labelled rows that a model is fitted on at most, in expectation.
SAMPLE_ROWS = 16_000
#: Models fitted side by side and averaged; each sees its share of the sample.
SHARDS = 6
FOLDS = 5


def held_out(id: str | Column) -> Column:
    """Whether a row is kept from fitting: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id).cast("string") if isinstance(id, str) else id.cast("string")) % FOLDS == 0, F.lit(False))


def rows(docs: DataFrame, labels: DataFrame, label: str, id: str = "doc_id", text: str = "text", most: int = 0) -> DataFrame:
    """(key, text, label) of all labelled rows outside the held-out fold, or about ``most`` of them.

    Which rows are taken depends on a hash of their id, so the choice is the same in every
    run. Labels other than 0 and 1, labels without a row and rows without an id are passed
    over; of several labels of one id the largest counts.
    """
    known = labels.select(F.col(id).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out("key"))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    if most:
        known = share(known, known.count(), most)
    else:  # labels grow with the corpus: one join for all sizes
        known = known.hint("merge")
    texts = docs.select(F.col(id).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return texts.join(known, "key")


def share(known: DataFrame, count: int, most: int = SAMPLE_ROWS) -> DataFrame:
    """About ``most`` of the ``count`` rows of ``known``, chosen by a hash of their key."""
    return known.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(min(1.0, most / max(count, 1)) * (1 << 30)))


def fit_shards(
    taken: DataFrame, fit: Callable[[list[str], np.ndarray], Iterable[tuple[int, float]]]
) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the models that ``fit`` makes of each shard, averaged.

    A shard's rows are in order of key and text, however they arrive. The result has as
    many rows as a model has weights, whatever the number of documents.
    """
    taken.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    shard = F.pmod(F.xxhash64("key", F.lit("shard")), F.lit(SHARDS)).cast("int")
    dealt = taken.select(shard.alias("shard"), "key", "text", "label").repartition(SHARDS, "shard")
    dealt = dealt.sortWithinPartitions("shard", F.xxhash64("key"), "key", "text")

    def made(texts: list[str], labels: list[int]) -> pa.RecordBatch:
        pairs = list(fit(texts, np.array(labels)))
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in pairs], pa.int64()), pa.array([v for _, v in pairs], pa.float64())], ["at", "value"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, texts, labels = None, [], []
        for batch in batches:
            for shard, text, label in zip(*(batch.column(k).to_pylist() for k in ("shard", "text", "label")), strict=True):
                if shard != current and texts:
                    yield made(texts, labels)
                    texts, labels = [], []
                current = shard
                texts.append(text)
                labels.append(label)
        if texts:
            yield made(texts, labels)

    models = dealt.mapInArrow(run, "at long, value double")
    total = models.groupBy("at").agg(F.sum("value").alias("value"), F.count("*").alias("n")).toArrow()
    at, value, n = (total.column(name).to_numpy() for name in ("at", "value", "n"))
    return at, value / max(n.max(initial=1), 1)

"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes what the one before it kept and returns the columns of its input, but for
the last, which returns the pieces of the documents and their places in sequences. Rows of
an empty input give an empty output; extra columns pass through to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, line_dedup, near_dups, packing, quality
from tidemark.llm.common import fresh, written
from tidemark.sources.tables import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    model = quality.train(docs, read_table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    return quality.score(docs, model, scored=score).where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of lines that stand elsewhere before; ``n_chars`` follows."""
    return _with_length(docs, line_dedup.dedup_lines(docs, removed=fresh(docs, "removed")))


def _with_length(docs: DataFrame, done: DataFrame) -> DataFrame:
    """``done`` with ``n_chars`` of the new texts, without its last column, the number of what was removed."""
    removed = done.columns[-1]
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        done = done.withColumn("n_chars", F.when(F.col(removed) > 0, length).otherwise(F.col("n_chars")))
    return done.drop(removed)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near_dups.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' tokens, packed into sequences."""
    return packing.pack_documents(docs, packing.public_vocabulary())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_dups", keep_one),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Embedding vectors as whole numbers, the form in which the vector operators are exact."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A component c becomes floor(SCALE * c).
SCALE = 256


def usable(vector: str | Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    entries = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(entries.isNotNull() & finite, F.lit(False))


def integers(vector: str | Column) -> Column:
    entries = F.col(vector) if isinstance(vector, str) else vector
    return F.transform(entries, lambda c: F.floor(c.cast("double") * SCALE))


def integer_rows(df: DataFrame, id: str, vector: str) -> DataFrame:
    """(id long, x array<long>) of the rows with a usable vector. Shorter vectors
    are filled up with zeros to the longest one's length, or to one entry."""
    rows = df.where(usable(f"`{vector}`")).select(F.col(f"`{id}`").cast("long").alias("id"), integers(f"`{vector}`").alias("x"))
    width = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 0)
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    return rows.select("id", padded.alias("x"))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """An Arrow column of lists of one length as a matrix of int64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), np.int64)
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), -1)

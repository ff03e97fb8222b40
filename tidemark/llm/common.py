"""What the operators share: tables cut from their lineage, rows held apart from work columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch

#: Bytes of text that a Python worker handles at once; its arrays take some forty times that.
SLICE_BYTES = 1 << 20
#: Rows per Arrow batch sent to a Python worker.
BATCH_ROWS = 1024


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the cluster's shared folder: computed once, without lineage."""
    path = scratch(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held(df: DataFrame) -> Column:
    """The whole row as one value, so that no work column can clash with its names."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns])


def released(df: DataFrame, row: str, changed: dict[str, Column] | None = None) -> list[Column]:
    """The columns of a held row, some of them replaced."""
    changed = changed or {}
    names = df.schema[row].dataType.names
    return [changed.get(name, F.col(f"{row}.`{name}`")).alias(name) for name in names]


def once(value: Column) -> Column:
    """Generates ``value`` itself. The optimiser does not move work into lambdas across a
    generator, so that what is made here is computed once for a row and not once per element."""
    return F.explode(F.array(value))


def map_text(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | list[pa.RecordBatch]],
    schema: StructType | str,
    text: str = "text",
) -> DataFrame:
    """``work`` over slices of at most :data:`SLICE_BYTES` of the column ``text`` (or one row)."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                made = work(part)
                yield from made if isinstance(made, list) else [made]

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch cut into runs of rows of about :data:`SLICE_BYTES`."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if batch.num_rows > start:
        yield batch.slice(start)

"""Whitening of embeddings by spectrum slicing.

The leading eigenvalues of the covariance are found one by one. The inertia of a shifted
matrix V - s, read off its LDL' factors, counts the eigenvalues above s; bisection by such
counts isolates the j-th eigenvalue, Rayleigh quotient iteration from inside the interval
converges to it cubically, and counts just below and above the result certify that it is the
j-th. Counts of one eigenvalue are used again for the next. Eigenvalues that lie closer together
than rounding can tell apart get orthogonal vectors out of their common space.

Spark does what grows with the rows: distinct vectors, their sums, the covariance (rows centred
before they are multiplied, one matrix per task, added up by cells) and the projections. To the
driver come the sums and the covariance, whose size is the square of the vectors' length and
does not depend on the number of rows.

Defined results: vectors that are null or hold a null or non-finite entry take no part; shorter
ones count as filled up with zeros; repeated and equal vectors count once in the fit, and each
row gets its own result. Components whose eigenvalue is not above rounding do not exist, so a
table of one distinct vector, like an empty one, gives no rows. A deviation that a long cannot
hold is null in ``deviation`` and stands whole in ``deviation_exact``. A null id stays null.
Other columns of the table pass through :func:`whiten` and may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import BATCH_ROWS, fresh, held, released, written
from tidemark.llm.vectors import integer_rows, integers, matrix, usable

COMPONENTS = 4
_LONG = 1 << 63


# --- eigenvalues ----------------------------------------------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """The number of eigenvalues above ``shift``: positive pivots of LDL' with Bunch-Kaufman pivoting."""
    m = matrix - shift * np.eye(len(matrix))
    size, k, positive = len(m), 0, 0
    alpha = (1 + 17**0.5) / 8

    def swap(i: int, j: int) -> None:
        if i != j:
            m[[i, j]] = m[[j, i]]
            m[:, [i, j]] = m[:, [j, i]]

    while k < size:
        wide = 1
        below = np.abs(m[k + 1 :, k])
        most = below.max(initial=0.0)
        if max(abs(m[k, k]), most) == 0:
            k += 1
            continue
        if abs(m[k, k]) < alpha * most:
            r = k + 1 + int(below.argmax())
            row = np.abs(m[r, k:])
            row[r - k] = 0
            other = row.max()
            if abs(m[k, k]) * other < alpha * most**2:
                if abs(m[r, r]) >= alpha * other:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    wide = 2
        block, rest = m[k : k + wide, k : k + wide], m[k + wide :, k : k + wide].copy()
        positive += int((np.linalg.eigvalsh(block) > 0).sum()) if wide == 2 else int(block[0, 0] > 0)
        m[k + wide :, k + wide :] -= rest @ np.linalg.solve(block, rest.T)
        k += wide
    return positive


class Slices:
    """Counts of eigenvalues above shifts, kept for all components."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        reach = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
        # Every eigenvalue lies within the discs of the rows.
        low, high = float((np.diag(matrix) - reach).min()), float((np.diag(matrix) + reach).max())
        self.scale = max(abs(low), abs(high))
        self.rounding = 8 * len(matrix) * np.finfo(float).eps * self.scale
        self.counts = {low - self.rounding: len(matrix), high + self.rounding: 0}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def around(self, number: int) -> tuple[float, float]:
        """The nearest known shifts that have the eigenvalue of this number between them."""
        low = max(s for s, n in self.counts.items() if n >= number)
        high = min(s for s, n in self.counts.items() if n < number)
        return low, high

    def alone(self, number: int) -> bool:
        low, high = self.around(number)
        return self.counts[low] - self.counts[high] == 1

    def halve(self, number: int) -> bool:
        """Whether the interval could be halved: it is wider than rounding."""
        low, high = self.around(number)
        if high - low <= self.rounding:
            return False
        self.above((low + high) / 2)
        return True


def _apart(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for other in found:
            x = x - (other @ x) * other
    return x / np.linalg.norm(x)


def _solved(matrix: np.ndarray, shift: float, x: np.ndarray, rounding: float) -> np.ndarray:
    for move in (0.0, rounding, -2 * rounding):
        try:
            y = np.linalg.solve(matrix - (shift + move) * np.eye(len(x)), x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all() and y.any():
            return y
    raise ArithmeticError("no inverse near an eigenvalue")


def rayleigh(slices: Slices, number: int, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """(eigenvalue, unit vector) from the middle of the interval of this number."""
    matrix = slices.matrix
    low, high = slices.around(number)
    x = _apart(np.cos(np.arange(1, len(matrix) + 1) * (1.0 + number)), found)
    for _ in range(2):  # towards the nearest eigenvalue, before the shift begins to move
        x = _apart(_solved(matrix, (low + high) / 2, x, slices.rounding), found)
    value = float(x @ matrix @ x)
    for _ in range(20):
        if np.linalg.norm(matrix @ x - value * x) <= slices.rounding / 8:
            break
        x = _apart(_solved(matrix, value, x, slices.rounding), found)
        value = float(x @ matrix @ x)
    return value, x


def leading(matrix: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``most`` positive eigenvalues, falling, and unit vectors as rows; their numbers are certified."""
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    slices = Slices(matrix)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    for number in range(1, min(most, len(matrix)) + 1):
        if slices.above(slices.rounding) < number:
            break
        while not slices.alone(number) and slices.halve(number):
            pass
        while True:
            value, x = rayleigh(slices, number, vectors)
            error = max(slices.rounding, 2 * float(np.linalg.norm(matrix @ x - value * x)))
            if error <= 4 * slices.rounding and slices.above(value - error) >= number > slices.above(value + error):
                break
            if not slices.halve(number):
                raise ArithmeticError(f"eigenvalue {number} could not be certified")
        values.append(value)
        vectors.append(x * np.sign(x[np.abs(x).argmax()]))
    return np.array(values), np.array(vectors).reshape(len(values), len(matrix))


# --- fit and projection ---------------------------------------------------------------


class Model(NamedTuple):
    """``sums`` of ``n`` different vectors; components as rows; ``error`` as measured on the fit list."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    error: float


def _cells(batches: Iterator[np.ndarray], mean: np.ndarray) -> np.ndarray:
    total = np.zeros((len(mean), len(mean)))
    for x in batches:
        centred = x - mean
        total += centred.T @ centred
    return total


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """Of the vectors ``x``, centred by exact sums, with divisor ``n``. A task gives a row per matrix row."""
    mean = np.array([s / n for s in sums])

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _cells((matrix(b.column("x")) for b in batches if b.num_rows), mean)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(range(len(mean)), pa.int32()), pa.array(total.tolist())], ["i", "row"])

    rows = vectors.mapInArrow(part, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "c"))
    made = np.zeros((len(sums), len(sums)))
    for r in rows.groupBy("i", "j").agg(F.sum("c").alias("c")).toLocalIterator():
        made[r.i, r.j] = r.c
    return (made + made.T) / (2 * n)


def whitened(x: np.ndarray, model: Model) -> np.ndarray:
    """Centred rows projected on the components, by the root of their eigenvalues."""
    mean = np.array([s / model.n for s in model.sums])
    return (x - mean) @ (model.vectors / np.sqrt(model.values)[:, None]).T


def deviations(x: np.ndarray, model: Model) -> list[int]:
    """Per row the sum of (n x - S)^2 over the dimensions, exactly."""
    n, sums = model.n, np.array(model.sums, object)
    whole = x.astype(object) if len(x) and _overflows(x, model) else x
    own = sums if whole.dtype == object else sums.astype(np.int64)
    squares, mixed = (whole * whole).sum(axis=1), (whole * own).sum(axis=1)
    constant = sum(s * s for s in model.sums)
    return [n * n * int(a) - 2 * n * int(b) + constant for a, b in zip(squares, mixed)]


def _overflows(x: np.ndarray, model: Model) -> bool:
    most, total = int(max(x.max(), -x.min())), max(abs(s) for s in model.sums)
    return x.shape[1] * most * max(most, total) >= _LONG


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Model:
    """Sums, covariance and its leading components, of each distinct vector once."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    own = df.select(F.lit(0).alias("id"), F.col(f"`{vector}`").alias("x"))
    distinct = written(integer_rows(own, "id", "x").select("x").distinct(), "distinct")
    n = distinct.count()

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for batch in batches:
            if batch.num_rows:
                total = total + matrix(batch.column("x")).sum(axis=0)
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "s"])

    found = distinct.mapInArrow(part, "i int, s long").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    sums = [int(r.s) for r in found.orderBy("i").collect()]  # a row per dimension
    if not n:
        return Model(0, [], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    cov = covariance(distinct, n, sums)
    values, vectors = leading(cov, components)
    model = Model(n, sums, vectors, values, float(np.trace(cov)), 0.0)
    return model._replace(error=identity_error(distinct, model))


def identity_error(vectors: DataFrame, model: Model) -> float:
    """The largest entry of the whitened vectors' covariance, less the identity. One row comes to the driver."""
    if not len(model.values):
        return 0.0

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = whitened(matrix(batch.column("x")), model)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in z.T.copy()], names)

    names = [f"z{i}" for i in range(len(model.values))]
    z = vectors.mapInArrow(part, ", ".join(f"{name} double" for name in names))
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    found = z.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(found, pairs))


def whiten(df: DataFrame, model: Model, vector: str = "embedding", name: str = "whitened", deviation: str | None = None) -> DataFrame:
    """Rows of ``df`` with a usable vector, with ``name``: array<double>, an entry per component.

    ``deviation`` names a column for the exact distance from the mean, a decimal."""
    names = [name] + [deviation] * bool(deviation)
    rows = df.where(usable(f"`{vector}`")).select(held(df).alias("row"), integers(f"`{vector}`").alias("x"))
    width = len(model.sums)
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    rows = rows.select("row", padded.alias("x"))
    kinds = ["array<double>", "decimal(38,0)"][: len(names)]
    schema = StructType.fromDDL("z array<double>, d decimal(38,0)" if deviation else "z array<double>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("x"))
            columns = [batch.column("row"), pa.array(list(whitened(x, model)), pa.list_(pa.float64()))]
            if deviation:
                columns.append(pa.array([_decimal(v) for v in deviations(x, model)], pa.decimal128(38)))
            yield pa.RecordBatch.from_arrays(columns, ["row", "z", "d"][: len(columns)])

    made = rows.mapInArrow(run, StructType([rows.schema["row"], *schema.fields]))
    values = [F.col(own).cast(kind).alias(fresh(df, out)) for own, kind, out in zip(("z", "d"), kinds, names)]
    return made.select(*released(made, "row"), *values)


def _decimal(value: int):
    from decimal import Context, Decimal

    return Context(prec=60).create_decimal(Decimal(value))


def by_component(df: DataFrame, model: Model, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_exact): a row per row and component."""
    rows = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    done = whiten(rows, model, "vector", "z", "d").select("id", "d", F.posexplode("z").alias("at", "value"))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if len(model.values) else F.array().cast("array<double>")
    return done.select(
        F.col("id").alias(id),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("d").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(model.error)).alias("identity_error"),
        F.col("d").alias("deviation_exact"),
    )

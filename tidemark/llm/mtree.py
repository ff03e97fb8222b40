"""Exact top-k inner products by best-first search in an M-tree.

An M-tree needs a metric. Every vector x gets one more coordinate, sqrt(M - |x|^2), with M no
less than any squared length, and a query q gets 0 there. Then |q - x|^2 = |q|^2 + M - 2 q.x,
so that the nearest vectors are those of the highest inner products.

The tree: its top node holds :data:`CELLS` routing objects, each vector belongs to the nearest.
The vectors of a cell, in order of their distance to its routing object, are cut into subtrees
of at most :data:`TREE` vectors; such a subtree is one row of the index. Within it, nodes are
pages of at most :data:`PAGE` entries. Each node has a routing object, a covering radius and
its distance to the parent's routing object; each entry of a leaf has its distance to the
leaf's. A node or entry is left out without computing a distance where the triangle inequality
over the stored distances shows that it is farther than the k-th best; nodes are visited in
order of their least possible distance, as long as that does not exceed the k-th best.

Queries go over the index in blocks of about :data:`BLOCK`, one job for each; a task keeps the
best of its subtrees for each query of the block. Each query starts with the k-th best score
among a sample of the vectors, which only spares work. Bounds are floating point with a margin
(:func:`margin`); scores are exact integers, and everything that may score as high is scored.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor
do rows without an id; shorter vectors count as filled up with zeros. Rows that agree in id and
vector are one row. A query takes no row of its own id. Equal scores rank by smaller id. Of rows
with equal vectors and more than k + 1 ids only the smallest k + 1 can be among any query's
first k, and only these are kept. With fewer than k other rows, all are returned; an empty table
gives no rows. Other columns of the table are not read. A score that no long can hold is an error.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_ROWS, written
from tidemark.llm.vectors import integer_rows, matrix
from tidemark.session import scratch

TOP = 5
#: Rows whose id is divisible by this are the queries.
EVERY = 50
#: Entries of a node, and vectors of a subtree, at most.
PAGE = 256
TREE = 4096
#: Routing objects of the top node, and vectors, in expectation, that they and the first bounds come from.
CELLS = 64
SAMPLE = 2048
#: Queries of one pass over the index, in expectation.
BLOCK = 2048
#: Subtrees that a worker holds at once.
HELD = 8

INDEX = (
    "cell int, kind string, vectors binary, counts binary, ids binary, to_leaf binary, "
    "routing binary, radius binary, to_parent binary, first binary, stop binary, leaf binary"
)
FOUND = "query int, id long, score long"
RESULT = "query_id long, rank int, vec_id long, score long"


class Points(NamedTuple):
    """Vectors with their squared lengths and the added coordinate."""

    x: np.ndarray
    squares: np.ndarray
    more: np.ndarray

    def take(self, rows) -> Points:
        return Points(self.x[rows], self.squares[rows], self.more[rows])


def points(x: np.ndarray, most: float) -> Points:
    x = x.astype(np.float64)
    squares = np.einsum("ij,ij->i", x, x)
    return Points(x, squares, np.sqrt(np.maximum(most - squares, 0)))


def distances(a: Points, b: Points) -> np.ndarray:
    """Of every one of ``a`` to every one of ``b``."""
    plain = a.squares[:, None] + b.squares[None] - 2 * (a.x @ b.x.T)
    return np.sqrt(np.maximum(plain + (a.more[:, None] - b.more[None]) ** 2, 0))


def margin(most: float) -> float:
    """More than rounding can move a distance by, the square root of a rounded difference of squares below 4 M."""
    return 1e-6 * (1 + most**0.5)


def spread(found: Points, number: int) -> list[int]:
    """Rows far apart: each next one is the farthest from those before."""
    chosen = [0]
    far = distances(found, found.take([0]))[:, 0]
    while len(chosen) < min(number, len(found.x)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, distances(found, found.take([chosen[-1]]))[:, 0])
    return chosen


class Subtree(NamedTuple):
    """Arrays over nodes, children after their parents and side by side, and over entries.
    ``first`` and ``stop`` bound a leaf's entries or another node's children."""

    order: np.ndarray
    to_leaf: np.ndarray
    routing: np.ndarray
    radius: np.ndarray
    to_parent: np.ndarray
    first: np.ndarray
    stop: np.ndarray
    leaf: np.ndarray


def bulk_load(found: Points, page: int = PAGE) -> Subtree:
    """A subtree over different vectors: rows are dealt to the nearest of some rows that lie far apart,
    until a page holds them."""
    groups, parents = [np.arange(len(found.x))], [-1]
    order: list[int] = []
    to_leaf: list[float] = []
    nodes: list[tuple] = []
    routing: list[int] = []
    for i, rows in enumerate(groups):  # grows meanwhile
        own = found.take(rows)
        centre = own.x.mean(axis=0)
        middle = int(np.argmin(own.squares - 2 * (own.x @ centre)))
        away = distances(own, own.take([middle]))[:, 0]
        routing.append(int(rows[middle]))
        parent = parents[i]
        up = 0.0 if parent < 0 else distances(found.take([routing[parent]]), own.take([middle]))[0, 0]
        if len(rows) <= page:
            nodes.append((away.max(), up, len(order), len(order) + len(rows), True))
            order.extend(rows.tolist())
            to_leaf.extend(away.tolist())
            continue
        pivots = spread(own, min(page, 2 * -(-len(rows) // page)))
        nearest = distances(own, own.take(pivots)).argmin(axis=1)
        parts = [rows[nearest == p] for p in range(len(pivots))]
        parts = [part for part in parts if len(part)]
        nodes.append((away.max(), up, len(groups), len(groups) + len(parts), False))
        groups.extend(parts)
        parents.extend([i] * len(parts))
    radius, to_parent, first, stop, leaf = map(np.array, zip(*nodes))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return Subtree(np.array(order), np.array(to_leaf), place[routing], radius, to_parent, first, stop, leaf)


def _narrow(x: np.ndarray) -> np.ndarray:
    low, high = x.min(initial=0), x.max(initial=0)
    return x.astype(next(kind for kind in (np.int16, np.int32, np.int64) if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max))


def _rows_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray, list[list[int]]]]:
    """Runs of one cell, of ``size`` rows at most, out of rows that come cell by cell."""
    cell, vectors, ids = None, [], []
    for batch in batches:
        cells = np.asarray(batch.column("cell"))
        x, own = matrix(batch.column("x")), batch.column("ids").to_pylist()
        at = 0
        while at < len(cells):
            if cell is not None and (cells[at] != cell or len(ids) >= size):
                yield cell, np.concatenate(vectors), ids
                vectors, ids = [], []
            cell = int(cells[at])
            until = at + int(np.searchsorted(cells[at:], cell, side="right"))
            until = min(until, at + size - len(ids))
            vectors.append(x[at:until])
            ids.extend(own[at:until])
            at = until
    if ids:
        yield cell, np.concatenate(vectors), ids


class Index(NamedTuple):
    """``subtrees``: a table with a row for each; ``rows``: (id, x) of all rows with a usable vector;
    ``sample``: some vectors, with the first of their ids."""

    subtrees: DataFrame
    rows: DataFrame
    pivots: np.ndarray
    sample: list[tuple]
    most: float
    exact: bool


def build(df: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = TOP, page: int = PAGE, tree: int = TREE) -> Index:
    """Index every row of ``df``. To the driver come two numbers and the sample."""
    spark = df.sparkSession
    rows = written(integer_rows(df, id, vector).where("id is not null").distinct(), "vectors")
    by_vector = Window.partitionBy("x").orderBy("id")
    least = rows.select("*", F.row_number().over(by_vector).alias("nth")).where(F.col("nth") <= k + 1)
    entries = written(least.groupBy("x").agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")
    square = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    number, most = entries.agg(F.count("*"), F.max(square)).first()
    most = (most or 0.0) * (1 + 1e-9)
    hashed = F.pmod(F.xxhash64("x"), F.lit(1 << 40))
    sample = entries.where(hashed < int((1 << 40) * min(1.0, SAMPLE / max(1, number)))).orderBy("x").collect()
    known = points(np.array([r.x for r in sample] or np.zeros((1, 0)), np.int64), most)
    pivots = known.take(spread(known, CELLS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = distances(points(matrix(batch.column("x")), most), pivots) if pivots.x.shape[1] else np.zeros((batch.num_rows, 1))
            cell = away.argmin(axis=1)
            columns = [pa.array(cell, pa.int32()), pa.array(away[np.arange(len(cell)), cell]), *batch.columns]
            yield pa.RecordBatch.from_arrays(columns, ["cell", "away", *batch.schema.names])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, x, ids in _rows_of(batches, tree):
            made = bulk_load(points(x, most), page)
            vectors, ids = _narrow(x[made.order]), [ids[i] for i in made.order]
            row = {
                "cell": cell,
                "kind": vectors.dtype.str,
                "vectors": vectors.tobytes(),
                "counts": np.array([len(i) for i in ids], np.int32).tobytes(),
                "ids": np.array([i for own in ids for i in own], np.int64).tobytes(),
            }
            row |= {name: getattr(made, name).tobytes() for name in Subtree._fields[1:]}
            kinds = [pa.int32(), pa.string()] + [pa.binary()] * (len(row) - 2)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), kinds)], list(row))

    _batches(spark, BATCH_ROWS)
    placed = entries.mapInArrow(assign, "cell int, away double, x array<long>, ids array<long>")
    # Equal distances are dealt by the vector, so that any number of them can be cut.
    order = ["cell", "away", F.xxhash64("x")]
    dealt = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    subtrees = written(dealt.mapInArrow(load, INDEX), "subtrees")
    return Index(subtrees, rows, pivots.x.astype(np.int64), [(r.x, r.ids) for r in sample], most, most < 2**52)


def _batches(spark, rows: int) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


class _Page(NamedTuple):
    """A subtree read back."""

    found: Points
    exact: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    tree: Subtree
    cell: int


def _read(row: dict, most: float, exact: bool) -> _Page:
    counts = np.frombuffer(row["counts"], np.int32)
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(len(counts), -1)
    kinds = {"routing": np.int64, "first": np.int64, "stop": np.int64, "leaf": np.bool_}
    arrays = [np.frombuffer(row[name], kinds.get(name, np.float64)) for name in Subtree._fields[1:]]
    found = points(vectors, most)
    return _Page(
        found,
        found.x if exact else vectors.astype(object),
        np.concatenate([[0], np.cumsum(counts)]),
        np.frombuffer(row["ids"], np.int64),
        Subtree(np.arange(len(counts)), *arrays),
        row["cell"],
    )


class Search:
    """The best ``k`` of a block of queries among the subtrees seen so far. The queries go down together: a
    node is visited once, for those of them that its bound does not exclude, and scored as one product."""

    def __init__(self, queries: list[tuple[int, list[int], float | int]], pivots: np.ndarray, most: float, exact: bool, k: int):
        self.ids = [q[0] for q in queries]
        x = np.array([q[1] for q in queries], np.int64)
        self.points = points(x, most)._replace(more=np.zeros(len(x)))
        self.exact = self.points.x if exact else x.astype(object)
        self.least = np.array([q[2] for q in queries], np.float64 if exact else object)
        self.best: list[list[tuple[int, int]]] = [[] for _ in queries]
        self.most, self.k = most, k
        self.slack = margin(most)
        #: Per query the distance beyond which no row can be among its best.
        self.reach = np.array([self._reach(i) for i in range(len(queries))])
        self.pivots = points(pivots, most)
        self.to_pivots = distances(self.points, self.pivots)
        self.computed = self.spared = 0

    def _reach(self, i: int) -> float:
        if self.least[i] == float("-inf"):
            return float("inf")
        return max(self.points.squares[i] + self.most - 2 * float(self.least[i]), 0) ** 0.5 + self.slack

    def _take(self, i: int, scores: np.ndarray, page: _Page, rows: np.ndarray) -> None:
        best = self.best[i]
        for row, score in zip(rows.tolist(), scores.tolist()):
            own = page.ids[page.starts[row] : page.starts[row + 1]].tolist()
            best.extend((-int(score), id) for id in own if id != self.ids[i])
        best.sort()
        del best[self.k :]
        if len(best) == self.k and -best[-1][0] > self.least[i]:
            self.least[i] = -best[-1][0]
            self.reach[i] = self._reach(i)

    def look(self, pages: list[_Page]) -> None:
        """Best-first over the nodes of some subtrees: the next node is the one with the least possible
        distance to any query that still needs it."""
        heap: list[tuple] = []
        serial = 0

        def push(p: int, node: int, asking: np.ndarray, away: np.ndarray) -> None:
            nonlocal serial
            bound = np.maximum(away - pages[p].tree.radius[node], 0)
            near = bound <= self.reach[asking]
            if near.any():
                serial += 1
                heapq.heappush(heap, (bound[near].min(), serial, p, node, asking[near], away[near]))

        for p, page in enumerate(pages):
            root = page.found.take([page.tree.routing[0]])
            up = distances(self.pivots.take([page.cell]), root)[0, 0]
            # By the stored distance alone; the distance itself is computed only for those that remain.
            bound = np.abs(self.to_pivots[:, page.cell] - up) - page.tree.radius[0]
            near = np.flatnonzero(bound <= self.reach)
            if len(near):
                push(p, 0, near, distances(self.points.take(near), root)[:, 0])
        while heap:
            _, _, p, node, asking, away = heapq.heappop(heap)
            page, tree = pages[p], pages[p].tree
            still = np.maximum(away - tree.radius[node], 0) <= self.reach[asking]
            asking, away = asking[still], away[still]
            if not len(asking):
                continue
            first, stop = int(tree.first[node]), int(tree.stop[node])
            if tree.leaf[node]:
                self._score(page, first, stop, asking, away)
                continue
            below = np.abs(tree.to_parent[first:stop, None] - away) - tree.radius[first:stop, None]
            needed = below <= self.reach[asking]
            children = first + np.flatnonzero(needed.any(axis=1))
            if len(children):
                aways = distances(page.found.take(tree.routing[children]), self.points.take(asking))
                for child, to in zip(children.tolist(), aways):
                    wanted = needed[child - first]
                    push(p, child, asking[wanted], to[wanted])

    def _score(self, page: _Page, first: int, stop: int, asking: np.ndarray, away: np.ndarray) -> None:
        needed = np.abs(page.tree.to_leaf[first:stop, None] - away) <= self.reach[asking]
        rows, columns = first + np.flatnonzero(needed.any(axis=1)), np.flatnonzero(needed.any(axis=0))
        self.computed += len(rows) * len(columns)
        self.spared += needed.size - len(rows) * len(columns)
        if not len(rows):
            return
        asking = asking[columns]
        scores = self.exact[asking] @ page.exact[rows].T
        high = scores >= self.least[asking][:, None]
        for i in np.flatnonzero(high.any(axis=1)).tolist():
            own = np.flatnonzero(high[i])
            self._take(int(asking[i]), scores[i, own], page, rows[own])

    def found(self) -> pa.RecordBatch:
        flat = [(i, id, -score) for i, best in enumerate(self.best) for score, id in best]
        columns = list(zip(*flat)) or [(), (), ()]
        kinds = [pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["query", "id", "score"])


def _first_bounds(queries: list[tuple[int, list[int]]], sample: list[tuple], k: int, exact: bool) -> list:
    """The k-th best score of each query among the sample without its own id, or minus infinity."""
    if not sample:
        return [float("-inf")] * len(queries)
    kind = np.float64 if exact else object
    x = np.array([s[0] for s in sample], np.int64).astype(kind)
    first, second = (np.array([(s[1] + [None, None])[j] for s in sample], object) for j in (0, 1))
    bounds = []
    for id, q in queries:
        scores = x @ np.array(q, np.int64).astype(kind)
        others = scores[(first != id) | (second != None)]  # noqa: E711  # an entry of its own id alone is no candidate
        bounds.append(int(np.sort(others)[-k]) if len(others) >= k else float("-inf"))
    return bounds


def top_k(index: Index, k: int = TOP, wanted: Column | None = None, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows for each row that is ``wanted``, a condition
    on ``id``. ``k`` may be at most that of :func:`build`."""
    spark = index.rows.sparkSession
    asked = index.rows.where(F.col("id") % EVERY == 0 if wanted is None else wanted)
    blocks = -(-asked.count() // block)
    path = scratch(spark, "llm-best")
    spark.createDataFrame([], RESULT).write.parquet(f"{path}/block=-1")
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id", "x"), F.lit(blocks)) == number).orderBy("id", "x").collect()
        queries = [(r.id, r.x) for r in own]
        if not queries:
            continue
        bounds = _first_bounds(queries, index.sample, k, index.exact)
        work = _searching([(id, x, bound) for (id, x), bound in zip(queries, bounds)], index, k)
        _batches(spark, HELD)
        found = written(index.subtrees.mapInArrow(work, FOUND), "found")
        _batches(spark, BATCH_ROWS)
        # One row per query of the block.
        numbers = spark.createDataFrame([(i, id) for i, (id, _) in enumerate(queries)], "query int, query_id long")
        best = _best(found, k).join(F.broadcast(numbers), "query")
        best.select("query_id", "rank", F.col("id").alias("vec_id"), "score").write.mode("overwrite").parquet(f"{path}/block={number}")
    return spark.read.schema(f"{RESULT}, block int").parquet(path).drop("block")


def _searching(queries: list[tuple], index: Index, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The work of a task: the best of its subtrees for each query."""
    pivots, most, exact = index.pivots, index.most, index.exact

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Search(queries, pivots, most, exact, k)
        for batch in batches:
            if batch.num_rows:
                state.look([_read(row, most, exact) for row in batch.to_pylist()])
        yield state.found()

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each query among those of all tasks; one task gives ``k`` at most."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.select("*", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)

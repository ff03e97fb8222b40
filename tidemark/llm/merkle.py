"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

Rows are leaves. Within each group (language), leaves stand in order of their key, and every
:data:`FAN` consecutive nodes become one node of the next level, until one is left: the group's
subroot. The subroots, in order of their groups, are the leaves of one more such tree, whose
root stands for the whole table.

Leaves are sorted by range; a run of at most :data:`SEGMENT` consecutive leaves of a group is a
segment, one row of a table. A segment derives all nodes that lie wholly within it, and hands
out only those whose parents do not: some of each level, at its two edges. Level by level these
meet the ones of other segments and become the upper nodes. For proofs, a segment computes the
least set of nodes that it cannot derive and that some leaf of its own needs as a sibling (the
octopus); it gets them in one join, derives the nodes shared by its leaves once, and writes each
leaf's proof from what it holds. No level of all nodes is ever shuffled, sorted or gathered.

A digest is lowercase hex SHA-256; a node's is that of its children's digests as text, in order.
A leaf's is that of its fields in order: ``-`` for null, else the number of UTF-8 bytes, a colon
and the value as text.

Defined results: null keys come first, then by key, then by digest, so repeated rows are leaves
side by side; a null group comes before all others, which follow bytewise. A node alone on its
level is the (sub)root itself; a single row has an empty proof. An empty table has no rows and
the root is null. Other columns of the table are not read; all names are allowed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_ROWS, written

FAN = 8
#: Leaves of a segment at most; a segment row takes about half a megabyte.
SEGMENT = 4096
#: Segment rows that a worker gets at once.
HELD = 8

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Groups as sortable text: null is ``n``, others follow ``v``.
_NULL, _SOME = "n", "v"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(values: Sequence[Column]) -> Column:
    """The digest of a row's fields, as binary."""
    texts = [value.cast("string") for value in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def chosen(id: str) -> Column:
    """Whether a row's text is tampered with in the audit: 3 divides the crc32 of its id as text."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 0, F.lit(False))


def tampered_text(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


# --- places in a tree -----------------------------------------------------------------


def width(total: int, level: int) -> int:
    """Nodes of a level over ``total`` leaves."""
    return -(-total // FAN**level)


def run_of(at: int, total: int, level: int) -> range:
    """The places of the nodes that share a parent with the node at ``at``."""
    first = at - at % FAN
    return range(first, min(first + FAN, width(total, level)))


def missing(first: int, count: int, total: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that proofs of ``count`` leaves from ``first`` on need and that
    cannot be derived from these leaves and from each other."""
    start, stop, level, found = first, first + count, 0, []
    while width(total, level) > 1:
        left, right = run_of(start, total, level).start, run_of(stop - 1, total, level).stop
        found += [(level, i) for i in (*range(left, start), *range(stop, right))]
        start, stop, level = left // FAN, -(-right // FAN), level + 1
    return found


def edges(first: int, leaves: list[str], total: int) -> list[tuple[int, int, str]]:
    """(level, place, digest) of the nodes that lie wholly over ``leaves`` while their parents do not."""
    found, level, start, nodes = [], 0, first, leaves
    while nodes:
        stop, wide = start + len(nodes), width(total, level)
        if wide == 1:
            found.append((level, 0, nodes[0]))
            break
        up = -(-start // FAN)
        until = -(-stop // FAN) if stop == wide else stop // FAN
        if up >= until:
            found += [(level, start + i, node) for i, node in enumerate(nodes)]
            break
        inside = range(up * FAN - start, min(until * FAN, wide) - start)
        found += [(level, start + i, node) for i, node in enumerate(nodes) if i not in inside]
        own = nodes[inside.start : inside.stop]
        nodes, start, level = [digest("".join(own[i : i + FAN])) for i in range(0, len(own), FAN)], up, level + 1
    return found


# --- segments -------------------------------------------------------------------------


def _segment_schema(key: str) -> str:
    return f"part int, seq int, g string, n long, keys array<{key}>, leaves binary, changed binary, which array<int>"


def _segments(leaves: DataFrame, size: int) -> DataFrame:
    """Leaves (g, k, leaf, changed) in order, cut into rows of at most ``size``."""
    order = ["g", "k", "leaf"]
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order)
    kind = leaves.schema["k"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        group: str | None = None
        keys: list[pa.Array] = []
        digests: list[bytes] = []
        changed: list[bytes | None] = []

        def row() -> pa.RecordBatch:
            which = [i for i, c in enumerate(changed) if c is not None]
            own = pa.concat_arrays(keys)
            columns = {
                "part": pa.array([part], pa.int32()),
                "seq": pa.array([seq], pa.int32()),
                "g": pa.array([group], pa.string()),
                "n": pa.array([len(digests)], pa.int64()),
                "keys": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                "leaves": pa.array([b"".join(digests)], pa.binary()),
                "changed": pa.array([b"".join(changed[i] for i in which)], pa.binary()),
                "which": pa.array([which], pa.list_(pa.int32())),
            }
            return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

        for batch in batches:
            groups, own, new = (batch.column(c).to_pylist() for c in ("g", "leaf", "changed"))
            key = batch.column("k")
            at = 0
            while at < len(groups):
                if digests and (groups[at] != group or len(digests) >= size):
                    yield row()
                    keys, digests, changed, seq = [], [], [], seq + 1
                group, until = groups[at], at
                while until < len(groups) and groups[until] == group and len(digests) + until - at < size:
                    until += 1
                keys.append(key.slice(at, until - at))
                digests += own[at:until]
                changed += new[at:until]
                at = until
        if digests:
            yield row()

    leaves.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return written(ranged.mapInArrow(cut, _segment_schema(kind)), "segments")


def _spans(segments: DataFrame) -> DataFrame:
    """(part, seq, g, n, first, total): the place of each segment's first leaf in its group. Counts are
    summed by partition first, so that no task gets all segments of a group."""
    sizes = segments.select("part", "seq", "g", "n")
    parts = sizes.groupBy("g", "part").agg(F.sum("n").alias("own"))
    group = Window.partitionBy("g")
    before = F.sum("own").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.select("g", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("own").over(group).alias("total"))
    inside = Window.partitionBy("g", "part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    local = sizes.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    joined = local.join(placed, ["g", "part"])
    return joined.select("part", "seq", "g", "n", (F.col("before") + F.col("inside")).alias("first"), "total")


class Tree(NamedTuple):
    """``segments``: leaves in place; ``nodes``: (g, level, at, total, hash) of all that segments need of
    each other; ``roots``: (g, root)."""

    segments: DataFrame
    spans: DataFrame
    nodes: DataFrame
    roots: DataFrame


def build_tree(leaves: DataFrame, size: int = SEGMENT) -> Tree:
    """The trees over (g, k, leaf, changed), one for each group. One number comes to the driver."""
    spark = leaves.sparkSession
    segments = _segments(leaves, size)
    spans = written(_spans(segments), "spans")

    def hand_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = edges(row["first"], _hex(row["leaves"]), row["total"])
                level, at, hashes = zip(*found)
                columns = [[row["g"]] * len(at), level, at, [row["total"]] * len(at), hashes]
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], ["g", "level", "at", "total", "hash"]
                )

    schema = "g string, level int, at long, total long, hash string"
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HELD))
    placed = segments.select("part", "seq", "leaves").join(spans, ["part", "seq"])
    handed = written(placed.mapInArrow(hand_out, schema), "edges")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    most = spans.agg(F.max("total")).first()[0] or 0
    level, levels = 0, []
    known = handed.where("level = 0")
    while width(most, level) > 1:
        levels.append(known)
        known = written(handed.where(F.col("level") == level + 1).unionByName(_parents(known, level)), "level")
        level += 1
    nodes = known
    for other in levels:
        nodes = nodes.unionByName(other)
    last = F.col("total") <= F.pow(F.lit(float(FAN)), F.col("level"))
    roots = nodes.where(last).select("g", F.col("hash").alias("root"))
    return Tree(segments, spans, nodes, written(roots, "roots"))


def _parents(known: DataFrame, level: int) -> DataFrame:
    """The nodes above those of a level, but for a root. A group is one run of at most :data:`FAN`."""
    children = F.sort_array(F.collect_list(F.struct("at", "hash")))
    up = known.where(F.col("total") > FAN**level).groupBy("g", F.expr(f"at div {FAN}").alias("at"), "total")
    return up.agg(F.sha2(F.array_join(F.transform(children, lambda c: c["hash"]), ""), 256).alias("hash")).select(
        "g", F.lit(level + 1).alias("level"), "at", "total", "hash"
    )


def _hex(joined: bytes) -> list[str]:
    text = joined.hex()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


# --- proofs ---------------------------------------------------------------------------


class Octopus:
    """The nodes on and beside the paths of a segment's leaves: its own, the fetched ones, and those derived."""

    def __init__(self, first: int, leaves: list[str], total: int, fetched: dict[tuple[int, int], str]):
        self.first, self.total = first, total
        self.known: list[dict[int, str]] = [{first + i: leaf for i, leaf in enumerate(leaves)}]
        for (level, at), node in fetched.items():
            while len(self.known) <= level:
                self.known.append({})
            self.known[level][at] = node
        start, stop, level = first, first + len(leaves), 0
        while width(total, level) > 1:
            if len(self.known) <= level + 1:
                self.known.append({})
            start, stop = start // FAN, -(-stop // FAN)
            for up in range(start, stop):
                run = run_of(up * FAN, total, level)
                self.known[level + 1][up] = digest("".join(self.known[level][i] for i in run))
            level += 1
        self.levels = level
        self._beside: dict[tuple[int, int], tuple[str, str]] = {}
        self._above: dict[tuple[int, int], str] = {}

    def beside(self, level: int, at: int) -> tuple[str, str]:
        """The digests of a node's run before and after it."""
        if (level, at) not in self._beside:
            run, nodes = run_of(at, self.total, level), self.known[level]
            self._beside[level, at] = "".join(nodes[i] for i in run if i < at), "".join(nodes[i] for i in run if i > at)
        return self._beside[level, at]

    def siblings(self, level: int, at: int) -> str:
        """All digests of the proof from this node up; shared by the leaves below it."""
        if level == self.levels:
            return ""
        if (level, at) not in self._above:
            self._above[level, at] = "".join(self.beside(level, at)) + self.siblings(level + 1, at // FAN)
        return self._above[level, at]

    def fold(self, leaf: str, at: int) -> str:
        """The (sub)root that a leaf's digest gives with the proof of its place."""
        for level in range(self.levels):
            before, after = self.beside(level, at)
            leaf, at = digest(before + leaf + after), at // FAN
            # From an unchanged node on, the path is the one all leaves below it share.
            if self.known[level + 1][at] == leaf:
                return self.known[self.levels][0]
        return leaf


class Manifest(NamedTuple):
    """The trees of all groups, the tree over their subroots, and its root (null for an empty table)."""

    tree: Tree
    top: Tree
    root: str | None


def leaves_of(
    df: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", key: str = "doc_id", changed: dict[str, Column] | None = None, where: Column | None = None
) -> DataFrame:
    """(g, k, leaf, changed): ``changed`` is the digest with other values for some fields, where the condition
    holds; else null."""
    columns = {name: F.col(f"`{name}`") for name in fields}
    g = F.coalesce(F.concat(F.lit(_SOME), F.col(f"`{group}`").cast("string")), F.lit(_NULL))
    other = F.lit(None).cast("binary")
    if changed:
        other = F.when(where, leaf_digest([changed.get(name, columns[name]) for name in fields]))
    return df.select(g.alias("g"), F.col(f"`{key}`").alias("k"), leaf_digest(list(columns.values())).alias("leaf"), other.alias("changed"))


def manifest(leaves: DataFrame, size: int = SEGMENT) -> Manifest:
    """Trees over the result of :func:`leaves_of`. One digest comes to the driver."""
    tree = build_tree(leaves, size)
    none = F.lit(None).cast("binary").alias("changed")
    subroots = tree.roots.select(F.lit("").alias("g"), F.col("g").alias("k"), F.unhex("root").alias("leaf"), none)
    top = build_tree(subroots, size)
    root = top.roots.first()
    return Manifest(tree, top, root.root if root else None)


def _fetched(tree: Tree) -> DataFrame:
    """(part, seq, first, total, fetched): each segment with the nodes it misses, asked for once."""
    needs = tree.spans.mapInArrow(_ask, "part int, seq int, g string, level int, at long")
    # Written, so that a node which very many segments ask for can be split in the join.
    asked = written(needs, "asked")
    nodes = asked.join(written(tree.nodes.select("g", "level", "at", "hash"), "nodes"), ["g", "level", "at"])
    found = nodes.groupBy("part", "seq").agg(F.collect_list(F.struct("level", "at", "hash")).alias("fetched"))
    return tree.spans.join(found, ["part", "seq"], "left")


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (row["part"], row["seq"], row["g"], level, at)
            for row in batch.to_pylist()
            for level, at in missing(row["first"], row["n"], row["total"])
        ]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64()]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "seq", "g", "level", "at"]
        )


def _octopus(row: dict) -> Octopus:
    fetched = {(f["level"], f["at"]): f["hash"] for f in row["fetched"] or ()}
    return Octopus(row["first"], _hex(row["leaves"]), row["total"], fetched)


def top_paths(top: Tree) -> DataFrame:
    """(g, subroot, path): per group its subroot and, level by level, the digests before and after its node."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made, rows = _octopus(row), []
                for i, g in enumerate(row["keys"]):
                    at = row["first"] + i
                    path = [dict(zip(("before", "after"), made.beside(level, at // FAN**level))) for level in range(made.levels)]
                    rows.append({"g": g, "subroot": made.known[0][at], "path": path})
                kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
                schema = pa.schema([("g", pa.string()), ("subroot", pa.string()), ("path", kind)])
                yield pa.RecordBatch.from_pylist(rows, schema)

    placed = top.segments.select("part", "seq", "keys", "leaves").join(_fetched(top).drop("g", "n"), ["part", "seq"])
    return placed.mapInArrow(expand, "g string, subroot string, path array<struct<before: string, after: string>>")


PROOFS = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(made: Manifest, key: str = "doc_id", siblings: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf. The fold starts from the
    changed digest where there is one. ``siblings`` adds the proof itself, an array of digests."""
    spark = made.tree.segments.sparkSession
    kind = made.tree.segments.schema["keys"].dataType.elementType.simpleString()
    root = made.root

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            for i, row in enumerate(batch.drop_columns(["keys"]).to_pylist()):
                octopus = _octopus(row)
                path = [(p["before"], p["after"]) for p in row["path"]]
                upper = "".join(before + after for before, after in path)
                changed = dict(zip(row["which"], _hex(row["changed"])))
                columns: list[list] = [[] for _ in range(6 + siblings)]
                for j in range(row["n"]):
                    at = row["first"] + j
                    leaf = octopus.known[0][at]
                    proof = octopus.siblings(0, at) + upper
                    folded = octopus.fold(changed.get(j, leaf), at)
                    folded = root if folded == row["subroot"] else _fold_path(folded, path)
                    values = [leaf, row["subroot"], root, digest(proof), folded, folded == root]
                    values += [[proof[k : k + 64] for k in range(0, len(proof), 64)]] * siblings
                    for column, value in zip(columns, values):
                        column.append(value)
                arrays = [keys.slice(i, 1).flatten(), *[pa.array(c, pa.string()) for c in columns[:5]], pa.array(columns[5], pa.bool_())]
                arrays += [pa.array(c, pa.list_(pa.string())) for c in columns[6:]]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = [key, *[field.split()[0] for field in PROOFS.split(", ")], *["siblings"] * siblings]
    tops = written(top_paths(made.top), "tops")
    # Small rows meet first; the join with the segments' leaves moves each of these once.
    fetched = written(_fetched(made.tree).join(tops, "g").drop("g", "n"), "fetched")
    placed = made.tree.segments.drop("g").join(fetched, ["part", "seq"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(HELD))
    return placed.mapInArrow(expand, f"`{key}` {kind}, {PROOFS}" + ", siblings array<string>" * siblings)


def _fold_path(digest_: str, path: list[tuple[str, str]]) -> str:
    for before, after in path:
        digest_ = digest(before + digest_ + after)
    return digest_


def verify(leaf: str, at: int, total: int, group_at: int, groups: int, siblings: list[str]) -> str:
    """The root that a leaf's digest gives with its proof alone: places and sizes say where each digest stands."""
    rest = list(siblings)
    for place, size in ((at, total), (group_at, groups)):
        level = 0
        while width(size, level) > 1:
            run = run_of(place, size, level)
            own, rest = rest[: len(run) - 1], rest[len(run) - 1 :]
            before = place - run.start
            leaf = digest("".join([*own[:before], leaf, *own[before:]]))
            place, level = place // FAN, level + 1
    return leaf

"""Near-duplicate classes by DartMinHash signatures, banded joins and an exact check.

1. A text is the set of its runs of :data:`RUN` words. Each run has a weight: 1, or with
   ``weights="count"`` its number of occurrences. Darts fall on the plane of weight and
   rank of each run, Poisson distributed by hashes of run and cell, so equal runs of
   different texts get the same darts. Darts above the run's weight or beyond the rank
   bound are off; of the rest each goes to one of :data:`COORDINATES` by its hash, and the
   earliest rank per coordinate is the signature. Two texts agree in a coordinate with the
   probability of their weighted Jaccard similarity. The rank bound is set so that k ln k +
   2k darts are expected; texts with an empty coordinate are thrown at again, further.
2. Equal texts (128-bit hash of the words) become one node before anything is joined.
3. Nodes that agree in a band of :data:`ROWS` coordinates meet in a bucket. Each member is
   compared with the bucket's first node only (that of the smallest id): as many pairs as
   members. Verified pairs are joined to components.
4. Buckets that then still hold several components are looked at again. What two texts have
   in common is at most what each has in common with the bucket's first node, plus the
   weight of those other runs of either that any other text there has. So most texts are
   shown to reach the threshold with no other: a text with many changes of its own is done
   without a comparison, however large its family. What is left is compared, members with the next :data:`CENTRES` nodes of another component that are not in
   the bucket's largest one, until a bucket is in one component or all nodes outside its
   largest have been centres: of two texts in different components one is outside it, so
   nothing is dropped.
5. Pairs are verified on the whole sets of runs: similarity of :data:`SIMILARITY` or more.

A pair at the threshold meets in no bucket with probability (1 - 0.8^4)^24 = 3e-6.

Defined results: words are separated by white space and compared as they are; texts of
fewer words than a run are one run; null and empty texts are equal texts; a null id is
allowed and sorts last; repeated rows are in one class; every row gives one row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_text, written
from tidemark.llm.components import components
from tidemark.llm.words import Words, find_words, mix, powers, shingles

RUN = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
COORDINATES = BANDS * ROWS
CENTRES = 256
_LAST = (1 << 63) - 1
#: Chance of at most n darts in a cell of area 1.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(18)])
_U = np.uint64


def _uniform(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> _U(11)).astype(np.float64) * 2.0**-53


def _weighted(texts: Words, weights: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of each text: (hash, text, weight), in order of text and hash."""
    hashes, owner = shingles(texts, RUN)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    counts = np.diff(np.append(at, len(hashes))).astype(np.float64)
    return hashes[at], owner[at], counts if weights == "count" else np.ones(len(at))


def _expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers repeated ``counts`` times, and the running number within each."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def darts(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, bound: np.ndarray):
    """(dart, text, rank) of all darts that hit: below their run's weight and the text's bound."""
    ranks = np.ceil(bound).astype(np.int64)[owner]
    rows, cell = _expand(np.ceil(weights).astype(np.int64) * ranks)
    up, along = cell // ranks[rows], cell % ranks[rows]
    with np.errstate(over="ignore"):
        place = mix(up.astype(_U) * _U(0x9E3779B97F4A7C15) + along.astype(_U) + _U(1))
        keys = mix(hashes[rows] + place)
        thrown = np.searchsorted(_POISSON, _uniform(mix(keys + _U(1))))
        cells, nth = _expand(thrown)
        dart = mix(keys[cells] + (nth.astype(_U) + _U(2)) * _U(0xD1342543DE82EF95))
        height = up[cells] + _uniform(mix(dart + _U(1)))
        rank = along[cells] + _uniform(mix(dart + _U(2)))
    rows = rows[cells]
    hit = (height < weights[rows]) & (rank < bound[owner[rows]])
    return dart[hit], owner[rows[hit]], rank[hit]


def signatures(hashes: np.ndarray, owner: np.ndarray, weights: np.ndarray, texts: int) -> np.ndarray:
    """Per text the dart of the earliest rank in each coordinate; rows of texts without runs are 0."""
    found = np.zeros((texts, COORDINATES), dtype=_U)
    total = np.bincount(owner, weights=weights, minlength=texts)
    wanted = COORDINATES * math.log(COORDINATES) + 2 * COORDINATES
    open_ = total > 0
    while open_.any():
        use = open_[owner]
        bound = np.where(open_, wanted / np.maximum(total, 1e-9), 0)
        dart, of, rank = darts(hashes[use], owner[use], weights[use], bound)
        slot = of * COORDINATES + (dart >> _U(40)).astype(np.int64) % COORDINATES
        order = np.lexsort((rank, slot))
        slot, dart = slot[order], dart[order]
        first = np.ones(len(slot), dtype=bool)
        first[1:] = slot[1:] != slot[:-1]
        found.reshape(-1)[slot[first]] = dart[first]
        filled = np.bincount(slot[first] // COORDINATES, minlength=texts)
        open_ &= filled < COORDINATES
        wanted *= 2
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band of each signature."""
    keys = np.zeros((len(found), BANDS), dtype=_U)
    rows = found.reshape(len(found), BANDS, ROWS)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            keys = mix(keys * _U(0xD1342543DE82EF95) + rows[:, :, k] + _U(1))
    return keys


def contents(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each text's sequence of words."""
    made = []
    with np.errstate(over="ignore"):
        for base in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            terms = mix(words.hashes + _U(base))
            place = np.arange(len(terms)) - words.bounds[:-1][words.owners()]
            sums = np.zeros(len(terms) + 1, dtype=_U)
            np.cumsum(terms * powers(base, int(place.max(initial=0)) + 1)[place], out=sums[1:])
            made.append(mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]] + np.diff(words.bounds).astype(_U)))
    return made[0], made[1]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _long(values))


def signed(docs: DataFrame, weights: str) -> DataFrame:
    """(id, version, one, two, bands) of every row of (id, version, text)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"))
        keys = band_keys(signatures(*_weighted(words, weights), batch.num_rows))
        one, two = contents(words)
        keys[np.diff(words.bounds) == 0] = 0
        bands = _lists(keys.reshape(-1), np.arange(batch.num_rows + 1) * BANDS)
        names = ["id", "version", "one", "two", "bands"]
        return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names[:2]), _long(one), _long(two), bands], names)

    return map_text(docs, work, "id long, version long, one long, two long, bands array<long>")


def _runs(docs: DataFrame, nodes: DataFrame, weights: str) -> DataFrame:
    """(node, runs, weights) of the nodes, read from the texts that they stand for."""
    wanted = docs.join(
        nodes.select("node", F.col("first").alias("of"), F.col("version").alias("of_version")),
        F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version")),
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, owner, weight = _weighted(find_words(batch.column("text")), weights)
        bounds = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        counts = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(weight.astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column("node"), _lists(hashes, bounds), counts], ["node", "runs", "weights"])

    made = map_text(wanted.select("node", "text"), work, "node long, runs array<long>, weights array<int>")
    return made.dropDuplicates(["node"])


def _similarity(pairs: DataFrame) -> DataFrame:
    """(a, b, shared, similarity) from the runs and weights of both sides."""

    def run(batches):
        for batch in batches:
            made, shared = [], []
            sides = [batch.column(k) for k in ("runs_a", "weights_a", "runs_b", "weights_b")]
            for i in range(batch.num_rows):
                ra, wa, rb, wb = (side[i].values.to_numpy() for side in sides)
                _, at_a, at_b = np.intersect1d(ra, rb, assume_unique=True, return_indices=True)
                common = int(np.minimum(wa[at_a], wb[at_b]).sum())
                made.append(common / (int(wa.sum()) + int(wb.sum()) - common))
                shared.append(common)
            columns = [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(made, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "shared", "similarity"])

    pairs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return pairs.mapInArrow(run, "a long, b long, shared long, similarity double")


def _compared(pairs: DataFrame, runs: DataFrame) -> DataFrame:
    """The pairs with the weight that their texts share, and their similarity."""
    for side in "ab":
        pairs = pairs.join(
            runs.select(F.col("node").alias(side), F.col("runs").alias(f"runs_{side}"), F.col("weights").alias(f"weights_{side}")),
            side,
        )
    return written(_similarity(pairs), "compared")


def _links(compared: DataFrame) -> DataFrame:
    return compared.where(F.col("similarity") >= SIMILARITY - 1e-12).select("a", "b")


def _nodes(rows: DataFrame) -> DataFrame:
    """(one, two, first, version, bands, node): one row per text, numbered in order of its smallest id."""
    nodes = rows.groupBy("one", "two").agg(
        F.min(F.struct(F.coalesce("id", F.lit(_LAST)).alias("order"), "id", "version")).alias("least"),
        F.first("bands").alias("bands"),
    )
    nodes = nodes.select("one", "two", F.col("least.id").alias("first"), F.col("least.version").alias("version"), "bands")
    sort = [F.col("first").asc_nulls_last(), F.col("version")]
    nodes = written(nodes, "texts").repartitionByRange(*sort).sortWithinPartitions(*sort)
    return written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after new links: the components of the old ones' roots."""
    old = roots.select("node", "root")
    ends = links
    for side in "ab":
        found = old.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        ends = ends.join(found, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    merged = components(ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    moved = merged.select(F.col("node").alias("root"), F.col("root").alias("newer"))
    kept = old.join(moved, "root", "left").select("node", F.coalesce("newer", "root").alias("root"))
    return written(kept.unionByName(merged), "roots")


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", weights: str = "set") -> DataFrame:
    """(id, version, class_id, root) for every row: the smallest id of its class, and a number
    that tells classes apart whose ids are null or not unique. ``version`` is the text's hash."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(body).alias("version"), body.alias("text"))
    rows = written(signed(docs, weights), "signed")
    nodes = _nodes(rows)

    members = nodes.where(F.exists("bands", lambda key: key != 0)).select("node", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("node").alias("centre")).where("n > 1")
    shared = written(shared, "shared")  # apart from the grouping, so that the join can split a large bucket
    members = written(members.join(shared, ["band", "key"]), "buckets")
    runs = written(_runs(docs, nodes.join(members.select("node").distinct(), "node"), weights), "runs")

    pairs = members.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    compared = _compared(pairs, runs)
    roots = written(components(_links(compared)), "roots")
    left = members.where("n > 2").withColumn("done", F.col("node") == F.col("centre")).drop("n")
    left = written(_unsettled(left, roots), "unsettled")
    runs = written(runs.join(left.select("node").distinct(), "node", "left_semi"), "runs")
    left = _bounded(left, runs, compared).join(nodes.select("node", "bands"), "node")
    left = written(_open(left), "open")
    while not left.isEmpty():
        centres = _next_centres(left)
        pairs = left.join(centres, ["band", "key"]).where("root != next_root").where(_first_bucket())
        most = F.least("shared", "next_shared") + F.least("other", "next_other")
        pairs = pairs.where(_reach(most, F.col("size") + F.col("next_size")))
        pairs = pairs.select(F.least("next_node", "node").alias("a"), F.greatest("next_node", "node").alias("b")).distinct()
        roots = _joined(roots, _links(_compared(pairs, runs)))
        used = centres.select("band", "key", F.col("next_node").alias("node"), F.lit(True).alias("now"))
        left = left.drop("root", "main").join(used, ["band", "key", "node"], "left")
        left = left.withColumn("done", F.col("done") | F.col("now").isNotNull()).drop("now")
        left = written(_open(_unsettled(left, roots)), "open")

    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("first").alias("class_id"))
    by_content = rooted.select("one", "two", "root").join(named, "root")
    return rows.select("id", "version", "one", "two").join(by_content, ["one", "two"]).select("id", "version", "class_id", "root")


def _unsettled(left: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their roots, and whether they
    have been a centre or need not be one."""
    rooted = left.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return _without_settled(rooted)


def _without_settled(rooted: DataFrame) -> DataFrame:
    """Members of buckets in which a node outside the largest component was no centre yet."""
    parts = rooted.groupBy("band", "key", "root").agg(F.count("*").alias("n"), F.sum((~F.col("done")).cast("long")).alias("new"))
    wanted = parts.groupBy("band", "key").agg(
        F.max(F.struct("n", "root", "new")).alias("most"), F.count("*").alias("parts"), F.sum("new").alias("new")
    )
    wanted = wanted.where("parts > 1 and new > most.new").select("band", "key", F.col("most.root").alias("main"))
    return rooted.drop("main").join(written(wanted, "several"), ["band", "key"])


def _bounded(left: DataFrame, runs: DataFrame, compared: DataFrame) -> DataFrame:
    """Members with ``size``, the weight of all their runs; ``shared``, that of the runs shared
    with the bucket's centre; ``other``, that of further runs that any other node has too."""
    each = runs.select("node", F.explode(F.arrays_zip("runs", "weights")).alias("run"))
    each = each.select("node", F.col("run.runs").alias("run"), F.col("run.weights").cast("long").alias("weight"))
    twice = written(each.groupBy("run").agg(F.count("*").alias("n")).where("n > 1").select("run"), "common")
    common = each.join(twice, "run").groupBy("node").agg(F.sum("weight").alias("common"))
    size = F.aggregate("weights", F.lit(0).cast("long"), lambda total, w: total + w)
    sizes = runs.select("node", size.alias("size")).join(common, "node", "left")
    sizes = written(sizes.na.fill(0, ["common"]), "sizes")
    known = compared.select(F.col("a").alias("centre"), F.col("b").alias("node"), "shared")
    found = left.join(sizes, "node").join(known, ["centre", "node"], "left")
    shared = F.when(F.col("node") == F.col("centre"), F.col("common")).otherwise(F.col("shared"))
    return found.withColumn("shared", shared).withColumn("other", F.greatest(F.col("common") - F.col("shared"), F.lit(0))).drop("common", "centre")


def _reach(common: Column, sizes: Column) -> Column:
    """Whether a common weight is enough for the threshold, given the sum of both sizes."""
    return common + F.lit(1e-9) >= F.lit(SIMILARITY / (1 + SIMILARITY)) * sizes


def _first_bucket() -> Column:
    """Whether two members share no bucket of an earlier band, where they meet already."""
    own, other = (F.slice(name, 1, F.col("band")) for name in ("bands", "next_bands"))
    return ~F.exists(F.zip_with(own, other, lambda a, b: a == b), lambda same: same)


def _open(left: DataFrame) -> DataFrame:
    """Members that may be similar to one of another component of their bucket."""
    smallest = written(left.groupBy("band", "key").agg(F.min("size").alias("least_size")), "smallest")
    able = left.join(smallest, ["band", "key"]).where(_reach(F.col("shared") + F.col("other"), F.col("size") + F.col("least_size")))
    return _without_settled(able.drop("least_size"))


def _next_centres(left: DataFrame) -> DataFrame:
    """The next :data:`CENTRES` nodes of each bucket, outside its largest component, that were no centre yet."""
    order = Window.partitionBy("band", "key").orderBy("node")
    ranked = left.where("not done and root != main").withColumn("at", F.row_number().over(order)).where(F.col("at") <= CENTRES)
    named = [F.col(name).alias(f"next_{name}") for name in ("node", "root", "size", "shared", "other", "bands")]
    return written(ranked.select("band", "key", *named), "centres")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", weights: str = "set") -> DataFrame:
    """``docs`` with one row of each class: that of the smallest id."""
    found = classes(docs, id, text, weights)
    least = F.min(F.struct(F.coalesce("id", F.lit(_LAST)).alias("order"), "id", "version"))
    kept = found.groupBy("root").agg(least.alias("least")).select("least.id", "least.version")
    kept = kept.select(F.col("id").alias("of"), F.col("version").alias("of_version"))
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id).cast("long").alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("version"),
    )
    both: Column = F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version"))
    found = keyed.join(kept, both).groupBy("id", "version").agg(F.first("row").alias("row"))
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])

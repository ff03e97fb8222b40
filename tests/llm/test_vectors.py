"""Exact top-k search and whitening against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mtree, whitening
from tidemark.sources.tables import read_table
from conftest import FOLDER

SCHEMA = "vec_id long, embedding array<float>"


def whole(vector):
    return [math.floor(256 * float(np.float32(c))) for c in vector]


def kept(rows):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in good), default=0)
    return [(i, whole(v) + [0] * (width - len(v))) for i, v in good]


def plain_top(rows, k, every):
    own = sorted({(i, tuple(x)) for i, x in kept(rows) if i is not None})
    found = []
    for q, x in own:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in own if i != q)
            found += [(q, rank + 1, i, -score) for rank, (score, i) in enumerate(scored[:k])]
    return sorted(found)


def searched(spark, rows, k=5, every=50, page=8, tree=40, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    index = mtree.build(df, k=k, page=page, tree=tree)
    return sorted(tuple(r) for r in mtree.top_k(index, k, F.col("id") % every == 0, **more).collect())


def clustered(rng, n, width=6):
    centres = rng.normal(size=(5, width))
    return [(centres[rng.integers(5)] + rng.normal(size=width) * 0.05).astype(np.float32).tolist() for _ in range(n)]


def test_search_equals_brute_force_with_ties_and_repeats(spark):
    rng = np.random.default_rng(3)
    rows = list(enumerate(clustered(rng, 300)))
    rows += [(1000 + i, rows[7][1]) for i in range(40)] + rows[:30] + [(20, rows[90][1])]
    rows += [(2000 + i, [float(v) for v in rng.integers(-1, 2, 6)]) for i in range(120)]
    assert searched(spark, rows, every=20) == plain_top(rows, 5, 20)
    assert searched(spark, rows, k=2, every=20, block=7) == plain_top(rows, 2, 20)


def test_search_leaves_out_unusable_vectors_and_rows_without_id(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [9.0, 9.0])]
    rows += [(5, []), (6, [0.5]), (50, [0.0, 0.0]), (-50, [-1.0, -1.0, 1.0])]
    got = searched(spark, rows)
    assert got == plain_top(rows, 5, 50)
    assert {r[2] for r in got} == {0, 5, 6, 50, -50}


def test_search_over_few_rows_and_none(spark):
    assert searched(spark, []) == []
    assert searched(spark, [(0, [1.0])]) == []
    assert searched(spark, [(0, [1.0]), (50, [2.0])]) == [(0, 1, 50, 256 * 512), (50, 1, 0, 256 * 512)]
    assert searched(spark, [(1, [1.0]), (2, [2.0])]) == []


def test_scores_beyond_floating_point_are_exact(spark):
    rows = [(i, [float(v) for v in v]) for i, v in enumerate([(3000000, 1), (3000000, 2), (1, 3000000), (0, 0), (2999998, 3)])]
    rows = [(i * 50, v) for i, v in rows]
    assert searched(spark, rows) == plain_top(rows, 5, 50)


def test_bounds_spare_computations():
    rng = np.random.default_rng(8)
    x = (np.concatenate([c + rng.normal(size=(400, 8)) * 3 for c in rng.normal(size=(10, 8)) * 300])).astype(np.int64)
    x = np.unique(x, axis=0)
    most = float((x * x).sum(axis=1).max())
    found = mtree.points(x, most)
    made = mtree.bulk_load(found, 64)
    assert sorted(made.order.tolist()) == list(range(len(x)))
    for node in range(len(made.radius)):
        rows = _below(made, node)
        away = mtree.distances(found.take(made.order[rows]), found.take(made.order[made.routing[[node]]]))
        assert away.max() <= made.radius[node] + mtree.margin(most)
    ordered = found.take(made.order)
    page = mtree._Page(ordered, ordered.x, np.arange(len(x) + 1), np.arange(len(x)), made, 0)
    search = mtree.Search([(-1, x[5].tolist(), float("-inf"))], x[:1], most, True, 5)
    search.look([page])
    want = sorted(((-int(s), i) for i, s in enumerate(x[made.order] @ x[5])))[:5]
    assert search.best[0] == want
    assert search.computed < len(x) / 2


def _below(made, node):
    if made.leaf[node]:
        return list(range(made.first[node], made.stop[node]))
    return [r for child in range(made.first[node], made.stop[node]) for r in _below(made, child)]


def test_search_reads_only_its_columns(spark):
    df = spark.createDataFrame([(0, [1.0], 3, "a"), (50, [1.0], 4, "b")], "vec_id long, embedding array<double>, x int, ids string")
    assert mtree.top_k(mtree.build(df)).count() == 2


# --- whitening ------------------------------------------------------------------------


def symmetric(rng, values):
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return (q * np.array(values, float)) @ q.T


@pytest.mark.parametrize("seed", range(4))
def test_counts_are_those_of_the_spectrum(seed):
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(30, 30))
    m = m + m.T
    m[:3, :3] = 0
    values = np.linalg.eigvalsh(m)
    for shift in rng.uniform(values[0] - 1, values[-1] + 1, 40):
        assert whitening.above(m, shift) == (values > shift).sum()


@pytest.mark.parametrize(
    "values",
    [[5, 3, 2, 1, 0.5, 0.1], [5, 5, 5, 1, 0, 0], [9, 9 - 1e-9, 9 - 2e-9, 4], [1e6, 1, 1e-3, 1e-6], [7], [2, 2], list(range(1, 41)), [1e-8] * 5],
)
def test_leading_eigenvalues(values):
    m = symmetric(np.random.default_rng(1), values)
    found, vectors = whitening.leading(m)
    want = sorted((v for v in values if v > 1e-13 * max(values)), reverse=True)[:4]
    assert len(found) == len(want)
    assert np.allclose(found, want, rtol=1e-9, atol=1e-13 * max(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(want)), atol=1e-10)
    assert np.abs(vectors @ m - found[:, None] * vectors).max() <= 1e-11 * max(values)


def test_no_positive_eigenvalue_gives_no_component():
    assert whitening.leading(np.zeros((3, 3)))[0].size == 0
    assert whitening.leading(np.zeros((0, 0)))[0].size == 0


def plain_whitening(rows):
    good = kept(rows)
    fit = np.array(sorted({tuple(x) for _, x in good}), float)
    centred = fit - fit.mean(axis=0)
    cov = centred.T @ centred / len(fit)
    values, vectors = np.linalg.eigh(cov)
    top = [(values[-c], vectors[:, -c]) for c in range(1, min(4, len(values)) + 1)]
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    out = {}
    for i, x in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        z = [float((np.array(x) - fit.mean(axis=0)) @ v / np.sqrt(e)) for e, v in top]
        out[i] = (n, deviation, z, [e / np.trace(cov) for e, _ in top])
    return out


def whitened_rows(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return whitening.by_component(df, whitening.fit(df)).collect()


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(clustered(rng, 200))]
    rows += [(500 + i, rows[3][1]) for i in range(50)] + rows[:20]
    rows += [(900, None), (901, [1.0, None] * 3), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, [0.1]), (905, [])]
    want = plain_whitening(rows)
    got = whitened_rows(spark, rows)
    assert len(got) == 4 * len(kept(rows))
    signs = {}
    for r in got:
        n, deviation, z, explained = want[r.vec_id]
        assert (r.n, r.deviation, int(r.deviation_exact)) == (n, deviation, deviation)
        sign = signs.setdefault(r.component, 1 if abs(z[r.component - 1] - r.whitened) < 1e-6 else -1)
        assert abs(sign * z[r.component - 1] - r.whitened) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-6
        assert 0 <= r.identity_error < 1e-9
    assert {r.component for r in got} == {1, 2, 3, 4}


def test_whitening_of_little(spark):
    assert whitened_rows(spark, []) == []
    assert whitened_rows(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []
    line = whitened_rows(spark, [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (None, [3.0, 6.0])])
    assert sorted((r.vec_id or 0, r.component) for r in line) == [(0, 1), (1, 1), (2, 1)]
    assert all(abs(r.explained - 1) < 1e-12 for r in line)


def test_deviation_beyond_a_long(spark):
    rows = [(i, [float(v) for v in (2**40 * i, 1, 2)]) for i in range(6)]
    want = plain_whitening(rows)
    for r in whitened_rows(spark, rows, "vec_id long, embedding array<double>"):
        exact = want[r.vec_id][1]
        assert int(r.deviation_exact) == exact
        assert r.deviation == (exact if exact < 2**63 else None)


def test_whiten_keeps_columns_that_clash(spark):
    rows = [(i, [random.Random(i).random(), float(i)], "p", i) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, whitened string, row int")
    got = whitening.whiten(df, whitening.fit(df))
    assert got.columns == ["vec_id", "embedding", "whitened", "row", "whitened_"]
    assert {(r.vec_id, r.whitened, r.row, len(r.whitened_)) for r in got.collect()} == {(i, "p", i, 2) for i in range(9)}


def test_whitened_table_has_unit_covariance(spark):
    rows = read_table(spark, FOLDER, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(rows)
    z = np.array([r.whitened for r in whitening.whiten(rows, model).select("whitened").collect()])
    assert np.abs(np.cov(z.T, bias=True) - np.eye(4)).max() < 1e-9 and model.error < 1e-9

"""Quality and toxicity: held-out accuracy, and the chain against all tag sequences."""

import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

import brute
from tidemark.llm import crf, labelled, quality, queries, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def marks(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet").toPandas().set_index("doc_id")


def test_quality_on_held_out_rows(spark, marks):
    got = queries.op6_quality(spark, FOLDER).toPandas().set_index("doc_id").join(marks)
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in got.held_out.items())
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    known = got[got.held_out & got.quality.notna()]
    assert (known.predicted == known.quality).mean() > 0.9
    assert known[known.quality == 1].predicted.mean() > 0.97


def test_toxicity_on_held_out_rows(spark, marks):
    got = queries.op2_toxicity(spark, FOLDER).toPandas().set_index("doc_id").join(marks)
    known = got[got.held_out & got.toxic.notna()]
    assert (known.predicted == known.toxic).mean() > 0.9
    assert known[known.toxic == 0].predicted.mean() < 0.05
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").toPandas().set_index("doc_id").text
    for id, spans in got[got.predicted == 1].spans.items():
        assert len(spans)
        for span in spans:
            word = texts[id][span["start"] : span["end"]]
            assert word == word.strip() and word


def test_labels_of_held_out_rows_are_not_used(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    rows = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    used = {r.key for r in labelled.rows(docs, rows, "quality").collect()}
    assert used == {i for i in range(40) if zlib.crc32(str(i).encode()) % 5}


def test_marginals_equal_the_sum_over_all_sequences():
    rng = np.random.default_rng(3)
    lengths = [0, 1, 5, 9, 0, 3]
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    emissions = rng.normal(size=bounds[-1])
    chain = crf.Chain(rng.normal(size=2), rng.normal(size=(2, 2)))
    for block in (2, 4, 32):
        crf.BLOCK, old = block, crf.BLOCK
        chance, pairs, starts = crf.Lattice(bounds).marginals(emissions, chain)
        crf.BLOCK = old
        want, want_pairs, want_starts = [], np.zeros((2, 2)), 0.0
        for a, b in zip(bounds, bounds[1:]):
            if a == b:
                continue
            total, ones, moves = 0.0, np.zeros(b - a), np.zeros((2, 2))
            for tags in itertools.product((0, 1), repeat=int(b - a)):
                weight = np.exp(
                    chain.start[tags[0]] + sum(chain.moves[x, y] for x, y in zip(tags, tags[1:])) + np.dot(tags, emissions[a:b])
                )
                total += weight
                ones += weight * np.array(tags)
                for x, y in zip(tags, tags[1:]):
                    moves[x, y] += weight
            want.extend(ones / total)
            want_pairs += moves / total
            want_starts += ones[0] / total
        assert np.allclose(chance, want) and np.allclose(pairs, want_pairs) and np.isclose(starts, want_starts)


def test_chain_learns_spans():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 50, 4000)
    tags = (words < 5).astype(np.int64)
    bounds = np.arange(0, 4001, 20)
    weights, chain = crf.fit(words[None, :], bounds, tags, 50, 40, 0.5, 1e-3)
    chance, _, _ = crf.Lattice(bounds).marginals(weights[words], chain)
    assert ((chance > 0.5) == tags).all()


def test_features_are_counts_of_words_and_signs():
    x = quality.features(pa.array(["a b a!!", "", None, "a"]))
    assert x.bounds.tolist()[1:4] == [x.bounds[1]] * 3
    assert np.isclose(x.values[x.bounds[0] : x.bounds[1]].sum() * np.sqrt(6), 6)  # 3 words, 2 pairs, 1 run of signs
    assert x.bounds[-1] - x.bounds[3] == 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edges(spark, module):
    label = "quality" if module is quality else "toxic"
    docs = spark.createDataFrame(
        [(1, None, "x"), (1, "", "y"), (None, "good words", None), (2, "bad " * 40_000, "z"), (2, "bad " * 40_000, "z"), (3, "...", "")],
        "doc_id long, text string, score string",
    )
    marks = spark.createDataFrame([(2, 1), (2, None), (None, 0), (7, 1), (1, 0)], f"doc_id long, {label} int")
    for labels in (marks, marks.limit(0)):
        got = module.score(docs, module.train(docs, labels, label), scored="p").collect()
        assert len(got) == 6 and all(0 <= r.p <= 1 for r in got) and {r.score for r in got} >= {"x", "y", "z"}
        same = [r.p for r in got if r.doc_id == 2]
        assert same[0] == same[1]
    assert module.score(docs.limit(0), module.train(docs.limit(0), marks, label), scored="p").count() == 0


def test_quality_scores_do_not_depend_on_neighbours():
    chance = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in chance.integers(0, 400, chance.integers(1, 300))) for _ in range(60)]
    model = quality.Model(chance.normal(size=1 << quality.BITS).astype(np.float32), 0.1)
    together = model.scores(pa.array([*texts, None, *texts[::-1]]))
    alone = [model.scores(pa.array([text]))[0] for text in texts]
    assert together.tolist() == [*alone, model.scores(pa.array([""]))[0], *alone[::-1]]


def test_quality_fit_equals_plain_ftrl():
    chance = np.random.default_rng(4)
    texts = [" ".join(f"w{i % (30 if k % 3 else 60)}" for i in chance.integers(0, 60, 20)) for k in range(80)]
    labels = [int(k % 3 > 0) for k in range(80)]
    x = quality.features(pa.array(texts))
    rows = [
        dict(zip(x.places[a:b].tolist(), x.values[a:b].tolist())) for a, b in zip(x.bounds[:-1], x.bounds[1:])
    ]
    weights, intercept = quality.fit(x, np.array(labels))
    plain, plain_intercept = brute.ftrl(rows, labels)
    assert intercept == pytest.approx(plain_intercept) and len(plain) > 30
    assert {at: w for at, w in enumerate(weights.tolist()) if w} == pytest.approx({at: w for at, w in plain.items() if w}, rel=1e-5)

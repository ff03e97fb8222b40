"""Packing: exact tokens, gapless sequences, few of them."""

import random
import zlib

import numpy as np
from conftest import FOLDER
from tokenizers import Tokenizer

from tidemark.llm import packing


def packed(spark, rows, size=packing.SIZE):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return packing.pack_documents(df, packing.public_vocabulary(), size).toPandas()


def check(got, size=packing.SIZE):
    assert (got.groupby("sequence_id").length.sum() <= size).all()
    lies = got.sort_values(["sequence_id", "offset"])
    before = lies.groupby("sequence_id").length.cumsum() - lies.length
    assert (before == lies.offset).all()


def test_pieces_hold_the_tokenizers_ids(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(-1, None), (-2, ""), (-3, "a <|endoftext|> b <|im_end|>"), (-4, "x" * 30_000), (-5, "é😀  \t\n" * 900)]
    got = packed(spark, rows)
    check(got)
    exact = Tokenizer.from_file(packing.public_vocabulary().json)
    for id, text in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, packing.FINAL_ID], dtype="<u4")
        own = got[got.doc_id == id].sort_values("piece")
        assert own.piece.tolist() == list(range(len(own)))
        assert own.length.sum() == len(ids) and own.length.iloc[1:].eq(packing.SIZE).all()
        for start, length, crc in zip(own.start, own.length, own.ids_crc32):
            assert zlib.crc32(ids[start : start + length].tobytes()) == crc


def test_few_sequences_on_the_table(spark):
    got = packed(spark, [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()])
    check(got)
    assert got.sequence_id.nunique() <= -(-got.length.sum() // packing.SIZE) * 1.01 + 1


def best_fit_decreasing(lengths, size):
    free = []
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, f in enumerate(free) if f >= length]
        if fitting:
            free[min(fitting, key=lambda i: free[i])] -= length
        else:
            free.append(size - length)
    return len(free)


def test_residual_packing_is_best_fit_decreasing():
    rng = random.Random(1)
    for size in (16, 50, 64):
        for _ in range(30):
            lengths = [rng.randint(1, size) for _ in range(rng.randint(0, 80))]
            histogram = np.bincount(lengths, minlength=size + 1)
            groups = packing.best_fit(histogram, size)
            used = np.zeros(size + 1, dtype=int)
            for parts, count in groups:
                assert sum(v * n for v, n in parts) <= size
                for v, n in parts:
                    used[v] += n * count
            assert (used == histogram).all()
            assert sum(g.count for g in groups) == best_fit_decreasing(lengths, size)


def test_patterns_are_no_worse_and_use_all_pieces():
    rng = np.random.default_rng(2)
    for weights in (rng.random(129), np.arange(129.0), 129 - np.arange(129.0)):
        weights[0] = 0
        histogram = rng.multinomial(5000, weights / weights.sum())
        groups = packing.pack_histogram(histogram, 128)
        used = np.zeros(129, dtype=int)
        for parts, count in groups:
            assert sum(v * n for v, n in parts) <= 128
            for v, n in parts:
                used[v] += n * count
        assert (used == histogram).all()
        plain = sum(g.count for g in packing.best_fit(histogram, 128))
        assert sum(g.count for g in groups) <= plain * 1.01 + 1


def test_counts_are_a_least_squares_fit():
    shapes = packing.patterns(32, 4)
    histogram = np.zeros(33)
    for shape, count in zip(shapes, [7, 0, 3, 12, *[5] * (len(shapes) - 4)]):
        for v in shape:
            histogram[v] += count
    packing.PASSES, old = 400, packing.PASSES
    counts = packing.fit_counts(shapes, histogram)
    packing.PASSES = old
    left = histogram.copy()
    for shape, count in zip(shapes, counts):
        for v in shape:
            left[v] -= count
    assert (counts >= 0).all() and np.abs(left).max() < 1


def test_repeated_rows_hot_lengths_and_no_rows(spark):
    got = packed(spark, [(1, "same text")] * 500 + [(None, "other"), (None, None), (2, "word " * 70)], 64)
    check(got, 64)
    assert len(got) == 500 + 2 + 2 and not got.duplicated(["sequence_id", "offset"]).any()
    assert len(packed(spark, [], 64)) == 0

"""The lexicon of the fingerprints holds terms, not hash buckets."""

import numpy as np
import pyarrow as pa

from tidemark.llm import fingerprints
from tidemark.llm.words import FOLD, find_words


def test_rare_term_that_shares_its_first_bits_with_a_frequent_one(spark, monkeypatch):
    words = [f"w{i}x" for i in range(9000)]
    bits = find_words(pa.array(words), FOLD).hashes >> np.uint64(44)
    seen: dict[int, str] = {}
    frequent, rare = next((seen[b], w) for w, b in zip(words, bits.tolist()) if seen.setdefault(b, w) != w)
    texts = [f"own{i} " + frequent * (i < 900) + f" {rare}" * (i >= 990) for i in range(1100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = fingerprints.lexicon(df)
    alone, both, with_own = fingerprints.values(pa.array([rare, f"{frequent} {rare}", f"{rare} own1"]), kept)
    assert (alone == both).all() and (alone == with_own).all()
    monkeypatch.setattr(fingerprints, "TASK_TERMS", 50)
    assert np.array_equal(np.sort(fingerprints.lexicon(df)), np.sort(kept))

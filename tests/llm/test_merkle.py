"""The manifest's digests, places and proofs against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_path(levels, at):
    """(digests before, digests after) level by level."""
    path = []
    for nodes in levels[:-1]:
        first = at - at % 8
        path.append((nodes[first:at], nodes[at + 1 : first + 8]))
        at //= 8
    return path


def plain_proofs(rows):
    groups = {}
    for row in rows:
        low = row[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])
        hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
        leaf = plain_leaf(row)
        groups.setdefault(row[2], []).append((row[0], leaf, plain_leaf((*row[:4], low)) if hit else leaf))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = plain_levels([leaf for _, leaf, _ in groups[g]])
    top = plain_levels([trees[g][-1][0] for g in order])
    found = []
    for i, g in enumerate(order):
        for at, (key, leaf, changed) in enumerate(groups[g]):
            path = plain_path(trees[g], at) + plain_path(top, i)
            folded = changed
            for before, after in path:
                folded = sha("".join([*before, folded, *after]))
            proof = [d for before, after in path for d in (*before, *after)]
            found.append((key, leaf, trees[g][-1][0], top[-1][0], sha("".join(proof)), folded, folded == top[-1][0], proof))
    return sorted(found, key=str)


def proven(spark, rows, size):
    df = spark.createDataFrame(rows, SCHEMA)
    leaves = merkle.leaves_of(df, changed={"text": merkle.tampered_text(F.col("text"))}, where=merkle.chosen("doc_id"))
    made = merkle.manifest(leaves, size)
    return made, sorted((tuple(r) for r in merkle.proofs(made, siblings=True).collect()), key=str)


def documents(rng, n, langs):
    texts = ["", None, "Ünï cødé Ω", "ABC def", "x" * 50_000 + "Q", "line\nline"]
    return [
        (i, rng.choice(["web", None, "a:b"]), rng.choice(langs), rng.choice([None, 0, 12]), rng.choice(texts) if i % 5 else f"Text {i}")
        for i in range(n)
    ]


@pytest.mark.parametrize("size", [1, 5, 64])
def test_proofs_equal_a_plain_tree(spark, size):
    rng = random.Random(size)
    rows = documents(rng, 700, ["en"] * 6 + ["de", "", None, "é", "Z"]) + [(9000, "s", "solo", 1, "One")]
    rows += rows[:12] * 3 + [(None, "web", "en", 1, "No Id"), (None, "web", "en", 1, "No Id")]
    rng.shuffle(rows)
    made, got = proven(spark, rows, size)
    want = plain_proofs(rows)
    assert got == [(*w[:-1], w[-1]) for w in want]
    assert not all(w[6] for w in want) and any(w[6] for w in want)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_sizes_around_full_runs(spark, n):
    rows = [(i, None, "en", i, "Abc") for i in range(n)]
    _, got = proven(spark, rows, 7)
    assert got == plain_proofs(rows)


def test_many_groups_make_a_tree_of_their_own(spark):
    rows = [(i, "s", f"g{i % 90}", 1, str(i)) for i in range(200)]
    _, got = proven(spark, rows, 16)
    assert got == plain_proofs(rows)


def test_empty_table(spark):
    made, got = proven(spark, [], 8)
    assert made.root is None and got == []


def test_a_proof_alone_gives_the_root(spark):
    rows = [(i, "s", "en" if i % 3 else "de", 1, str(i)) for i in range(100)]
    made, got = proven(spark, rows, 16)
    for g, lang in enumerate(("de", "en")):
        own = [i for i in range(100) if ("en" if i % 3 else "de") == lang]
        by_key = {r[0]: r for r in got}
        for at, key in enumerate(own):
            assert merkle.verify(by_key[key][1], at, len(own), g, 2, by_key[key][7]) == made.root


def test_missing_nodes_are_the_least_ones():
    rng = random.Random(1)
    for _ in range(200):
        total = rng.randint(1, 3000)
        first = rng.randrange(total)
        count = rng.randint(1, total - first)
        wanted = set()
        own = set(range(first, first + count))
        for level in range(5):
            if merkle.width(total, level) == 1:
                break
            run = {j for i in own for j in merkle.run_of(i, total, level)}
            wanted |= {(level, j) for j in run - own}
            own = {i // 8 for i in own}
        assert set(merkle.missing(first, count, total)) == wanted
        assert len(merkle.missing(first, count, total)) == len(wanted) <= 14 * 5


def test_other_columns_and_names(spark):
    df = spark.createDataFrame(
        [("a", "x", "left", 1.5), ("b", None, None, None)], "`my key` string, g string, leaf string, changed double"
    )
    leaves = merkle.leaves_of(df, ["my key", "leaf", "changed"], group="g", key="my key")
    made = merkle.manifest(leaves)
    got = {r["my key"]: r for r in merkle.proofs(made, key="my key").collect()}
    assert got["a"].leaf == plain_leaf(("a", "left", 1.5)) and got["b"].leaf == plain_leaf(("b", None, None))
    assert got["a"].verified and got["b"].root == sha(got["b"].subroot + got["a"].subroot)

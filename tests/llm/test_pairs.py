"""Near duplicates, components and benchmark matches against brute force."""

import random

import numpy as np
import pyarrow as pa
from brute import edit_distance, near_classes, search_distance
from conftest import FOLDER

from tidemark.llm import decontamination, near_dups
from tidemark.llm.components import components
from tidemark.llm.words import find_words, shingles


def grouped(pairs):
    groups = {}
    for key, value in pairs:
        groups.setdefault(key, set()).add(value)
    return sorted(map(sorted, groups.values()))


def test_words_are_those_of_split():
    rng = random.Random(1)
    texts = ["", None, " ", "a", " a  b\n", "\n".join("".join(rng.choices("ab é\t", k=40)) for _ in range(9))]
    words = find_words(pa.array(texts).slice(0))
    assert np.diff(words.bounds).tolist() == [len((t or "").split()) for t in texts]
    flat = [w for t in texts for w in (t or "").split()]
    assert len(set(words.hashes.tolist())) == len(set(flat))
    assert len(set(zip(words.hashes.tolist(), flat))) == len(set(flat))
    runs, owner = shingles(words, 5)
    assert np.bincount(owner, minlength=6).tolist() == [max(1, len((t or "").split()) - 4) if (t or "").split() else 0 for t in texts]


def test_agreement_is_the_weighted_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(1, 2**62, 300, dtype=np.uint64)
    shared = 0
    wanted = 0.0
    for trial in range(30):
        a, b = rng.integers(0, 4, 300), rng.integers(0, 4, 300)
        b[:220] = a[:220]
        hashes = pool + np.uint64(trial)
        elements = [(hashes[w > 0], w[w > 0].astype(float)) for w in (a, b)]
        owner = np.repeat([0, 1], [len(e[0]) for e in elements])
        found = near_dups.signatures(np.concatenate([e[0] for e in elements]), owner, np.concatenate([e[1] for e in elements]), 2)
        assert (found != 0).all()
        shared += (found[0] == found[1]).sum()
        wanted += np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(shared / 30 / near_dups.COORDINATES - wanted / 30) < 0.03


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    nodes = list(range(200))
    rng.shuffle(nodes)
    links = list(zip(nodes[:90], nodes[1:91])) + [(nodes[100], n) for n in nodes[101:160]] + [(5, 5)]
    df = spark.createDataFrame(links + links[:10], "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    want = {n: min(nodes[:91]) for n in nodes[:91]} | {n: min(nodes[100:160]) for n in nodes[100:160]}
    assert got == {n: r for n, r in want.items() if n != r}
    assert components(df.limit(0)).count() == 0


def test_classes_equal_brute_force_on_the_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = near_dups.classes(docs).collect()
    want = grouped((c, r[0]) for r, c in zip(rows, near_classes(rows)))
    assert grouped((r.root, r.id) for r in got) == want
    assert all(r.class_id == min(g) for r in got for g in want if r.id in g)
    kept = near_dups.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(g) for g in want)
    assert kept.schema == docs.schema


def variants(words, count, changes, rng):
    made = []
    for _ in range(count):
        own = list(words)
        for i in rng.sample(range(len(own)), changes):
            own[i] = f"new{rng.random()}"
        made.append(" ".join(own))
    return made


def test_large_families_of_copies(spark):
    """Copies of one text that are near it but mostly not near each other, with and without it."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(240)]
    texts = [" ".join(words)] + variants(words, 60, 4, rng) + variants([f"v{i}" for i in range(240)], 60, 5, rng)
    texts += [texts[0]] * 30
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    near_dups.CENTRES, old = 4, near_dups.CENTRES
    try:
        got = near_dups.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        near_dups.CENTRES = old
    assert grouped((r.root, r.id) for r in got) == grouped((c, r[0]) for r, c in zip(rows, near_classes(rows)))


def test_near_dup_edges(spark):
    long = "word " * 60_000
    rows = [(1, None, "a"), (None, "", "b"), (2, "  \n", "c"), (3, "x y", "d"), (4, "x y", "e"), (4, "x y", "e"), (5, long, "f"), (6, long + "word", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = near_dups.classes(df).collect()
    assert len(got) == 8
    assert grouped((r.root, str(r.id)) for r in got) == [["1", "2", "None"], ["3", "4"], ["5", "6"]]
    kept = near_dups.one_of_each(df).collect()
    assert sorted((r.doc_id, r.root) for r in kept) == [(1, "a"), (3, "d"), (5, "f")]
    assert near_dups.classes(df.limit(0)).count() == 0 and near_dups.one_of_each(df.limit(0)).columns == df.columns
    counted = near_dups.classes(df.where("doc_id >= 5"), weights="count").collect()
    assert len({r.root for r in counted}) == 1


def test_myers_equals_the_distance_table():
    rng = random.Random(3)
    for _ in range(150):
        item = "".join(rng.choices("abc", k=rng.randint(1, 70)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 90)))
        distance, end = decontamination.closest(item, text)
        assert distance == search_distance(item, text)
        assert end == 0 and distance == len(item) or min(edit_distance(item, text[a:end]) for a in range(end + 1)) == distance


def test_matches_within_the_budget_are_found(spark):
    rng = random.Random(6)
    letters = "abcdefghijklmnop "
    items = ["".join(rng.choices(letters, k=rng.randint(60, 200))).strip() for _ in range(25)] + ["too short", "", None]
    docs, want = [], set()
    for n in range(120):
        around = ["".join(rng.choices(letters, k=rng.randint(0, 300))) for _ in range(2)]
        item = rng.randrange(25)
        flat = decontamination.plain(items[item])
        edits = rng.choice([0, 1, decontamination.budget(flat), decontamination.budget(flat) + 12])
        body = list(flat)
        for i in rng.sample(range(len(body)), edits):
            body[i] = rng.choice(["", "Z", "ZZ"]) if body[i] != " " else " "
        docs.append((n, around[0] + " \n" + "".join(body).replace(" ", "  ").upper() + "\n" + around[1]))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(docs + [(500, None), (501, ""), (None, docs[0][1])], "doc_id long, text string")
    got = {(r.doc_id, m.item_id) for r in decontamination.mark(df, table).collect() for m in r.matches if r.doc_id is not None}
    for id, text in docs:
        for item in range(25):
            flat = decontamination.plain(items[item])
            if search_distance(flat, decontamination.plain(text)) <= decontamination.budget(flat):
                want.add((id, item))
    assert got == want and len(want) > 60
    flagged = {i for i, _ in want}
    clean = decontamination.clean(df, table).collect()
    assert {r.doc_id for r in clean} - {None} == {i for i, _ in docs + [(500, ""), (501, "")]} - flagged


def test_benchmark_in_several_blocks_and_edges(spark):
    items = [(i, f"this is the benchmark passage with number {i} and some more words") for i in range(40)] + [(None, None), (3, "x")]
    table = spark.createDataFrame(items, "item_id long, text string")
    text = "Ä" * 70_000 + " " + items[7][1] + " then come some other words " + items[7][1]
    df = spark.createDataFrame([(1, text, 3), (1, text, 3), (2, "clean", 4)], "doc_id long, text string, matches int")
    decontamination.BLOCK_CHARS, old = 300, decontamination.BLOCK_CHARS
    try:
        many = decontamination.mark(df, table, matches="found").collect()
    finally:
        decontamination.BLOCK_CHARS = old
    once = decontamination.mark(df, table, matches="found").collect()
    key = lambda rows: [(r.doc_id, r.matches, sorted((m.item_id, m.start, m.end, m.distance) for m in r.found)) for r in rows]
    assert sorted(key(many)) == sorted(key(once))
    first = [m for m in once[0].found if m.distance == 0]
    assert [text[m.start : m.end] for m in first if m.item_id == 7] == [items[7][1]] * 2
    assert decontamination.mark(df, table.limit(0)).where("size(matches) > 0").count() == 0
    assert decontamination.clean(df.limit(0), table).count() == 0
    assert decontamination.clean(df, table).collect() == df.where("doc_id = 2").collect()

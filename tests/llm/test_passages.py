"""Repeated passages go from their first line to their last; what is no passage stays."""

import random

import pytest
from brute import dedup_lines
from conftest import FOLDER

import corpus_pipeline
from tidemark.llm import line_dedup

DOCS = "doc_id long, text string"


def deduped(spark, rows):
    return line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS), removed="removed").collect()


def planted(rng):
    """Rows, and the texts they should be: two copies of each passage in fresh surroundings."""
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(5))
    rows, want = [], {}
    for length in [*range(2, 21)] * 3:
        passage = [line() for _ in range(length)]
        for copy in range(2):
            ahead, after = ([line() for _ in range(rng.randint(0, 4))] for _ in range(2))
            id = len(rows)
            rows.append((id, "\n".join(ahead + passage + after)))
            want[id] = "\n".join(ahead + passage * (copy == 0) + after)
    return rows, want


def test_planted_passages_go_whole(spark):
    rows, want = planted(random.Random(4))
    assert {r.doc_id: r.text for r in deduped(spark, rows)} == want


def test_stage_of_the_pipeline(spark):
    rows, want = planted(random.Random(8))
    df = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long")
    got = dict(corpus_pipeline.STAGES)["line_dedup"](spark, df, FOLDER).collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


CODE = [
    "int f(int a) {\n    if (a) {\n        a++;\n    }\n    return a;\n}",
    "int g(int b) {\n    while (b) {\n        b--;\n    }\n    return a;\n}",
    "def f(x):\n    for i in range(10):\n        if x > i:\n            return True\n    return False",
    "def g(y):\n    for i in range(10):\n        if y > i:\n            return True\n    return False",
    "import java.util.List;\nimport java.util.Map;\n\npublic class A {\n    public static void main(String[] args) {\n        run();\n    }\n}",
    "import java.util.List;\nimport java.util.Map;\n\npublic class B {\n    public static void main(String[] args) {\n        go();\n    }\n}",
    "# One\n\nSome text.\n\n- [x]\n---",
    "# Two\n\nOther text.\n\n- [x]\n---",
    "\n\n\n\n",
    "x\n\n\n\n",
]


def test_code_stays(spark):
    got = deduped(spark, list(enumerate(CODE)))
    assert {r.doc_id: r.text for r in got} == dict(enumerate(CODE)) and not any(r.removed for r in got)


def test_pieces_found_at_different_places_do_not_add_up(spark):
    """Two small repeats side by side are no passage, and one of a passage's pairs known from elsewhere parts it."""
    a, b, c = ("alpha beta gamma delta one", "beta two three four", "gamma five six seven eight")
    rows = [(1, f"{a}\n{b}\nx"), (2, f"y\n{b}\n{c}"), (3, f"{a}\n{b}\n{c}")]
    assert {r.doc_id: r.text for r in deduped(spark, rows)} == dict(rows)


def test_exact_copies_lose_all_but_the_first(spark):
    text = "\n".join(f"sentence {i} here" for i in range(50))
    got = {r.doc_id: r for r in deduped(spark, [(i, text) for i in (7, 3, 9)])}
    assert got[3].text == text and got[3].removed == 0
    assert got[7].text == got[9].text == "" and got[7].removed == 50


def test_copies_within_a_document(spark):
    passage = "one of the lines of a passage\nthat stands here more than once over"
    same = "the very same line again and again and again here"
    rows = [(1, f"{passage}\nbetween\n{passage}\nend"), (2, "\n".join([same] * 5)), (3, "文" * 120 + "\n" + "字" * 90), (4, "文" * 120 + "\n" + "字" * 90)]
    got = {r.doc_id: r.text for r in deduped(spark, rows)}
    assert got == {1: f"{passage}\nbetween\nend", 2: f"{same}\n{same}", 3: rows[2][1], 4: ""}


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_version(spark, seed):
    rng = random.Random(seed)
    lines = [" ".join(rng.choices(["a", "word", "words,", "x1", "Überall", "", "the"], k=rng.randint(0, 9))) for _ in range(60)]
    rows = [(i, "\n".join(rng.sample(lines, rng.randint(0, 6)) + lines[:17] * (i % 3 > 0) + rng.choices(lines, k=9))) for i in range(60)]
    rows += [(3, rows[3][1]), (99, None), (None, rows[4][1]), (100, ""), (101, "\n\n\n"), (102, "\n\n\n"), (103, "one line")]
    rows += [(104, "one line"), (105, "\n".join(lines * 40)), (106, "x" * 300_000 + "\n" + "\n".join(lines * 3))]
    got = deduped(spark, rows)
    want = dedup_lines(rows)
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    assert sorted(((r.doc_id, r.text, r.removed) for r in got), key=key) == sorted(((r[0], *want[r]) for r in rows), key=key)
    assert sum(r.removed for r in got) > 500


def test_columns_that_clash_and_no_rows(spark):
    text = "\n".join(["first line of some words here", "second line of some more words"])
    clash = spark.createDataFrame([(1, text, 5, "p", 1.0), (2, text, 6, "q", 2.0)], "doc_id int, text string, pos int, gone string, row double")
    assert [tuple(r) for r in line_dedup.dedup_lines(clash).orderBy("doc_id").collect()] == [(1, text, 5, "p", 1.0), (2, "", 6, "q", 2.0)]
    assert line_dedup.dedup_lines(clash.limit(0)).collect() == []

"""Main text, chat templates and fingerprints."""

import hashlib
import html
import re

import pytest
from conftest import FOLDER
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from tidemark.llm import chat, fingerprints, html_text, queries
from tidemark.llm.template import Template, TemplateError


def article(page: str) -> str:
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


def test_main_text_of_the_table(spark):
    got = queries.op5_html_text(spark, FOLDER).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


SCORES = html_text.Scores(1.0, {"article": -50.0, "/article": -50.0, "body": -50.0})


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<p>b  c\n d<br>e", "a\nb c d e"),
        ("<nav><p>menu one two</nav><article><h1>T &amp; U</h1><aside>x y z</aside><p>one&nbsp;two</p></article>", "T & U\none two"),
        ("<article><header><h1>Title</h1></header><p>x <!-- no --> y</p></article><footer>f g</footer>", "Title\nx y"),
        ("<article><p>x</p><div class='comments'><div>bad words here</div> more</div><p>y</p></article>", "x\ny"),
        ("<article><p class=ad>buy this<p>text</p></article>", "text"),
        ("<article><script>if (a < b) { p('</p>') }</script><p>t</p><form><input>q</form></article>", "t"),
        ("<article class='post with-sidebar'><p>t</p><div id='cookie-bar'>c</div></article>", "t"),
        ("<div>short ad</div><article><p>" + "word " * 9 + "</p></article>", ("word " * 9).strip()),
        ("<article><p>a > b < c</p><ul><li>i<li>j</ul></article>", "a > b < c\ni\nj"),
        ("<body><aside>never closed <p>words words", ""),
        ("<p title='a>b'>x</p><!-- open", "x"),
    ],
)
def test_main_text_of_pages(page, text):
    assert html_text.main_text(page, SCORES) == text


def test_best_run_is_the_best_of_all():
    import random

    rng = random.Random(7)
    for _ in range(200):
        values = [rng.randint(-4, 4) for _ in range(rng.randint(0, 14))]
        a, b = html_text.best_run(values)
        best = max([0] + [sum(values[i:j]) for i in range(len(values)) for j in range(i + 1, len(values) + 1)])
        assert sum(values[a:b]) == best


def test_pages_edges(spark):
    rows = [(1, None, "u"), (None, "", None), (2, "<p>x", "u"), (2, "<p>x", "u"), (3, "<article>" + "<p>word " * 30_000, "v")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = html_text.extract(df, html_text.train(df)).orderBy("page_id").collect()
    assert [r.text for r in got] == ["", "", "x", "x", "\n".join(["word"] * 30_000)]
    assert html_text.extract(df.limit(0), html_text.train(df.limit(0))).count() == 0


texts = st.lists(st.sampled_from([*"ab\\n<|>\n é", "<|im_end|>", "<|im_start|>", "\\|"]), max_size=30).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("assistant"), texts), texts), max_size=5))
def test_formatted_turns_read_back(turns):
    text, spans = Template(chat.CHAT, chat.FILTERS).render(messages=[{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text, spans) == [(r, t, t if r == "assistant" else "") for r, t in turns]
    assert "".join(chat.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_template_language():
    def run(source, **scope):
        return Template(source, chat.FILTERS).render(**scope)[0]

    assert run("{{ 'a' + 1 + \"b\\n\" }}") == "a1b\n"
    assert run("{% set x = 'v' %}{{ x | upper }}{{ none }}") == "V"
    assert run("{% if a == 1 and not b %}one{% elif b or c %}two{% else %}three{% endif %}", a=2, c=1) == "two"
    assert run("{% for x in xs %}[{{ x['k'] }}{{ x.missing }}]{% endfor %}", xs=[{"k": 1}, {"k": "z"}]) == "[1][z]"
    assert Template("a{% if 1 == 1 %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}d", chat.FILTERS).tree == [("abCd",)]
    assert Template("x{% generation %}yz{% endgeneration %}").render() == ("xyz", [(1, 3)])
    for bad in ("{% for x %}{% endfor %}", "{{ a.b( }}", "{{ 'x' | nope }}", "{% if a %}", "{% import os %}", "{{ }}", "{{ a b }}", "{% endif %}"):
        with pytest.raises(TemplateError):
            Template(bad, chat.FILTERS)
    for reach in ("{{ x.__class__ }}", "{{ x['__len__'] }}"):
        with pytest.raises(TemplateError):
            run(reach, x="text")
    with pytest.raises(TemplateError):
        chat.compiled("before {% for m in messages %}{% endfor %}")


def test_conversation_edges(spark):
    rows = [
        (1, 2, "assistant", "second", "k"), (1, 1, "user", None, "k"), (1, None, None, "first", "k"), (None, 1, "assistant", "x" * 90_000, None),
        (2, 1, "assistant", "same", "k"), (2, 1, "assistant", "same", "k"), (2, 1, "a\nb", "<|im_end|>", "k"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, spans string")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(df)).collect()}
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("\nfirst\nuser\n\nassistant\nsecond\n") and got[1].n_turns == 3
    assert got[2].turns_sha256 == sha("a\nb\n<|im_end|>\n" + "assistant\nsame\n" * 2) and got[2].loss_sha256 == sha("samesame")
    assert got[None].loss_chars == 90_000
    assert chat.digests(chat.format_turns(df.limit(0))).count() == 0


def test_fingerprints_of_edited_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = queries.op7_fingerprints(spark, FOLDER).toPandas().set_index("doc_id")
    rows = docs.toPandas().sort_values("doc_id")
    ids, texts = rows.doc_id.tolist(), rows.text.tolist()
    edited = [edit_plainly(text, texts[(i + 1) % len(texts)]) for i, text in enumerate(texts)]
    prints, edited_prints = brute.fingerprints(texts, texts), brute.fingerprints(texts, edited)
    for i, id in enumerate(ids):
        assert got.edited_sha256[id] == hashlib.sha256(edited[i].encode()).hexdigest() and got.n_chars[id] == len(texts[i])
        assert got.fingerprint[id] == "".join(f"{v:04x}" for v in prints[i])
        assert got.edited_fingerprint[id] == "".join(f"{v:04x}" for v in edited_prints[i])
        assert got.near_edited[id] == brute.likeness(prints[i], edited_prints[i])
        assert got.near_next[id] == brute.likeness(prints[i], prints[(i + 1) % len(ids)])
    assert got.near_edited.mean() > 0.4 and got.near_next.mean() < 0.1
    assert (got.near_edited > got.near_next).mean() > 0.9


def edit_plainly(text, after):
    quarter = len(text) // 4
    return text[: len(text) - quarter] + after[:quarter]


def test_the_table_of_the_lexicon_has_one_size(spark):
    for n in (3, 300):
        df = spark.createDataFrame([(i, f"a{i % 40} b{i % 7}") for i in range(n)], "doc_id long, text string")
        assert fingerprints.lexicon(df).nbytes == 1 << (fingerprints.BITS - 3)


def test_fingerprint_edges(spark):
    rows = [(5, None), (5, None), (None, "last words of all"), (1, ""), (2, "abcdefgh"), (7, "b " * 50_000), (7, "other text with the id"), (9, "abcdefgh")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, version string")
    got = fingerprints.compare_edits(df, fingerprints.lexicon(df)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[2].edited_sha256 == hashlib.sha256(b"abcdef").hexdigest() and by[2].fingerprint == by[9].fingerprint
    assert by[None].edited_sha256 == hashlib.sha256(b"last words of").hexdigest()
    none = df.limit(0)
    assert fingerprints.compare_edits(none, fingerprints.lexicon(none)).count() == 0
    alone = spark.createDataFrame([(1, "only one text")], "doc_id long, text string")
    got = fingerprints.compare_edits(alone, fingerprints.lexicon(alone)).first()
    assert got.near_next == 1.0 and got.edited_sha256 == hashlib.sha256(b"only one tonl").hexdigest()

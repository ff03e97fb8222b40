"""The pipeline's stages, each against plain Python on what the one before it kept."""

import corpus_pipeline
from brute import dedup_lines, near_classes
from conftest import FOLDER
from test_packing import check

from tidemark.llm import decontamination, packing, quality


def test_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality"](spark, docs, FOLDER).cache()
    model = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = docs.toPandas()
    import pyarrow as pa

    scores = model.scores(pa.array(rows.text))
    assert {r.doc_id for r in good.collect()} == set(rows.doc_id[scores >= quality.THRESHOLD])
    assert good.columns == docs.columns

    cut = stages["line_dedup"](spark, good, FOLDER).cache()
    want = dedup_lines([(r.doc_id, r.text) for r in good.collect()])
    assert {r.doc_id: r.text for r in cut.collect()} == {id: text for (id, _), (text, _) in want.items()}
    assert all(r.n_chars == len(r.text) for r in cut.collect()) and cut.schema == docs.schema

    one = stages["near_dups"](spark, cut, FOLDER).cache()
    rows = sorted((r.doc_id, r.text) for r in cut.collect())
    assert {r.doc_id for r in one.collect()} == {rows[c][0] for c in near_classes(rows)}

    clean = stages["decontamination"](spark, one, FOLDER).cache()
    items = [decontamination.plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in clean.collect()}
    for r in one.collect():
        flat = decontamination.plain(r.text)
        assert not (r.doc_id in kept and any(item in flat for item in items))
        if r.doc_id not in kept:
            assert any(decontamination.closest(i, flat)[0] <= decontamination.budget(i) for i in items)

    packed = stages["packing"](spark, clean, FOLDER).toPandas()
    check(packed)
    assert set(packed.doc_id) == kept
    encoder = packing.Encoder(packing.public_vocabulary())
    tokens = {r.doc_id: len(encoder.encode(r.text)) + 1 for r in clean.collect()}
    assert packed.groupby("doc_id").length.sum().to_dict() == tokens


def test_run_is_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    key = ["doc_id", "piece", "length", "ids_crc32"]
    got, want = corpus_pipeline.run(spark, FOLDER).toPandas(), docs.toPandas()
    assert got[key].sort_values(key).values.tolist() == want[key].sort_values(key).values.tolist()


def test_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a b c d e f\n" * 9, "en", "s", None), (2, "a b c d e f\n" * 9, "en", "s", None)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, score double")
    for some in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            some = stage(spark, some, FOLDER)
            assert some.columns == docs.columns
            some.collect()
        corpus_pipeline.STAGES[-1][1](spark, some, FOLDER).collect()

"""The corpus pipeline, stage by stage, against plain Python on the stage's own input."""

import pathlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from stockrisk.llm import gam
from stockrisk.llm.mixing import mix
from stockrisk.llm.pii import KINDS, detect
from stockrisk.llm.quality import features, fit, score, training_rows
from test_simhash import plain_components, plain_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, cached."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF).cache()
        out.append((name, docs, done))
        docs = done
    return {name: (before, after) for name, before, after in out}


def test_order_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "personal_data", "mix", "tokens"]
    columns = spark.read.parquet(f"{SF}/documents.parquet").schema
    for name in ("quality", "near_dedup", "personal_data", "mix"):
        assert [(f.name, f.dataType) for f in stages[name][1].schema] == [(f.name, f.dataType) for f in columns]


def test_quality_keeps_what_the_model_passes(spark, stages):
    before, after = stages["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = gam.fit(*training_rows(before, labels, "quality"))
    want = {r.doc_id for r in before.collect() if model.score(features(r.text)[None, :])[0] >= 0.7}
    assert {r.doc_id for r in after.collect()} == want and 0 < len(want) < before.count()
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert sum(marked.get(d) == 0 for d in want) <= 1
    good = [d for d, q in marked.items() if q == 1]
    assert sum(d in want for d in good) >= 0.97 * len(good)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_dedup"]
    prints = {r.doc_id: plain_fingerprint(r.text) for r in before.collect()}
    root = plain_components(list(set(prints.values())), 4)
    first = {}
    for d in sorted(prints):
        first.setdefault(root[prints[d]], d)
    kept = after.collect()
    assert sorted(r.doc_id for r in kept) == sorted(first.values())


def test_personal_data_is_gone(stages):
    before, after = stages["personal_data"]
    spans = {r.doc_id: r.spans for r in detect(before).collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    got = {r.doc_id: (r.text, r.n_chars) for r in after.collect()}
    assert any(spans.values())
    for d, text in texts.items():
        out, at = "", 0
        for s in sorted(spans[d], key=lambda s: (s.start, s.kind)):
            if s.start >= at:
                out += text[at : s.start] + f"<{KINDS[s.kind].upper()}>"
            at = max(at, s.end)
        assert got[d] == (out + text[at:], len(out + text[at:]))


def test_mix_takes_each_document_as_often_as_it_says(spark, stages):
    before, after = stages["mix"]
    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    weighed = score(before, fit(documents, labels), "weight")
    copies = {r.doc_id: r.copies for r in mix(weighed, quality=F.col("weight")).collect()}
    assert Counter(r.doc_id for r in after.collect()) == Counter({d: c for d, c in copies.items() if c})


def test_tokens_are_the_library_s(stages):
    before, after = stages["tokens"]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in before.collect()}
    rows = after.collect()
    assert len(rows) == before.count()
    for r in rows:
        assert r.ids == library.encode(texts[r.doc_id]) and r.decoded == library.decode(r.ids)


def test_run_equals_the_stages(spark, stages):
    ran = corpus_pipeline.run(spark, SF)
    assert Counter((r.doc_id, tuple(r.ids)) for r in ran.collect()) == Counter((r.doc_id, tuple(r.ids)) for r in stages["tokens"][1].collect())


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_any_rows_and_any_column_names(spark):
    """NULL, empty, very long and repeated rows; columns named like every helper column there is."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    long_text = " ".join(f"word{i % 997} and more {i}" for i in range(30_000))
    odd = [(9001, None), (9002, ""), (9003, long_text), (None, "a text without id, call +1 (375) 555-4393"), (9004, "tie"), (9004, "tie too")]
    more = spark.createDataFrame([(*r, None, "src0", len(r[1] or "")) for r in odd], docs.schema)
    docs = docs.unionByName(more).unionByName(docs.where("doc_id % 3 = 0")).unionByName(docs.where("doc_id % 3 = 0"))
    names = ["_ka", "_key", "_id", "_quality_score", "quality_score", "quality", "masked", "ka", "kb", "row", "size", "rank", "row_hash", "copies", "_source"]
    names += ["target", "spans", "text_key", "own_key", "group", "fp", "score", "_pos", "epochs", "a.b", "budget", "labels", "kept"]
    for n in names:
        docs = docs.withColumn(n, F.lit(n))
    for name, stage in corpus_pipeline.STAGES[1:4]:  # the first one keeps few of these
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        rows = after.collect()
        assert rows and all(r[n] == n for r in rows for n in names), name
    kept = corpus_pipeline.quality(spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() > 0
    once = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    assert len(once) == len({(r.doc_id, r.text) for r in once}) and any(r.text == long_text for r in once)
    assert {r.text for r in corpus_pipeline.personal_data(spark, docs, SF).where("doc_id is null").collect()} == {"a text without id, call <PHONE>"}
    out = corpus_pipeline.tokens(spark, corpus_pipeline.mix(spark, docs, SF), SF)
    assert out.columns == ["doc_id", "source", "ids", "decoded"] and out.count() > 0


def test_only_the_result_stays_stored(spark):
    def stored():
        root = spark.sparkContext.getCheckpointDir()
        return {str(p) for p in pathlib.Path(root.removeprefix("file:"), "tables").glob("*") if any(p.rglob("*.parquet"))}

    before = stored()
    out = corpus_pipeline.run(spark, SF)
    assert len(stored() - before) == 1 and out.count() > 0

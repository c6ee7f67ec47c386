"""The additive model on made-up effects; the classifier on held-out rows."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockrisk.llm import gam
from stockrisk.llm.common import held_out
from stockrisk.llm.quality import FEATURES, features, fit, keep_good, quality_report, training_rows

SF = "/root/testdata/sf0.01"


def test_main_effects_and_interactions():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(6000, 4))
    bump = ((x[:, 0] > 0.3) & (x[:, 0] < 0.6)).astype(float)
    crossed = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    for y in (bump, crossed):
        model = gam.fit(x[:4000], y[:4000])
        assert ((model.score(x[4000:]) > 0.5) == y[4000:]).mean() > 0.95
    assert (1, 2) in model.pairs
    alone = gam.fit(x[:4000], crossed[:4000], pairs=0)
    assert ((alone.score(x[4000:]) > 0.5) == crossed[4000:]).mean() < 0.6  # no sum of single tables tells it


def test_tables_are_additive():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    model = gam.fit(x, (x[:, 0] + x[:, 1] > 0).astype(float))
    total = np.full(len(x), model.intercept)
    for j in range(3):
        total += [model.tables[j][int((model.cuts[j] <= v).sum())] for v in x[:, j]]
    for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
        total += [t[int((model.pair_cuts[i] <= a).sum()), int((model.pair_cuts[j] <= b).sum())] for a, b in x[:, [i, j]]]
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(-total)))


def test_features():
    for text in (None, "", " \n", "x", "é" * 50000, "a b\na b"):
        assert features(text).shape == (len(FEATURES),) and np.isfinite(features(text)).all()
    got = dict(zip(FEATURES, features("Ab! ab! ab!\nab!"), strict=True))
    assert got["upper"] == 1 / 8 and got["distinct_words"] == 0.5 and got["echoes"] == 0.5 and got["marked_words"] == 1


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_report(docs, labels).join(labels, "doc_id").toPandas()
    held = out[out["held_out"]]
    assert len(held) > 50 and (held["predicted"] == held["quality"]).mean() > 0.95
    assert out["score"].between(0, 1).all() and ((out["score"] >= 0.7) == (out["predicted"] == 1)).all()


def test_labels_of_the_held_out_fold_are_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").limit(300), spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [{r.doc_id: r.score for r in quality_report(docs, x).collect()} for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "text"), (5, "word " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("label", F.lit(3))
    some = spark.createDataFrame([(1, 0, 0), (2, 1, 0), (2, 0, 0), (5, 1, 0), (None, 1, 1), (8, None, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (some, some.limit(0), some.where("quality = 1")):
        out = quality_report(docs, labels).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert quality_report(docs.limit(0), some).count() == 0
    assert keep_good(docs, some, 0.0).columns == docs.columns and keep_good(docs, some, 0.0).count() == len(rows)


def test_an_id_of_many_rows_is_one_row_of_the_sample(spark):
    """The least text of an id is learned, chosen before rows reach the driver."""
    texts = [(1, f"zz {k} later text!") for k in range(500)] + [(1, "Aa first text"), (2, None), (4, "four words of text")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 4)], "doc_id long, quality int")
    rows, marks = training_rows(docs, labels.where(~held_out(F.col("doc_id"))), "quality")
    ids = [r.doc_id for r in labels.where(~held_out(F.col("doc_id"))).orderBy("doc_id").collect()]
    want = {1: features("Aa first text"), 2: features(None), 4: features("four words of text")}
    assert 1 in ids and np.allclose(rows, [want[i] for i in ids]) and marks.tolist() == [i % 2 for i in ids]


def plain_features(text):
    """The figures of ``FEATURES``, byte by byte."""
    data = list((text or "").encode())
    is_upper = [chr(b) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for b in data]
    is_letter = [u or b > 127 or chr(b) in "abcdefghijklmnopqrstuvwxyz" for u, b in zip(is_upper, data, strict=True)]
    digits = sum(chr(b) in "0123456789" for b in data)
    spaces = sum(b in (32, 9, 10, 11, 12, 13) for b in data)
    stops = sum(chr(b) in ".,;:'\"()-" for b in data)
    shouts = sum(chr(b) in "!?" for b in data)
    symbols = len(data) - sum(is_letter) - digits - spaces - stops - shouts
    words, word = [], []
    for b in [*data, 32]:
        if b in (32, 9, 10, 11, 12, 13):
            words += [tuple(word)] if word else []
            word = []
        else:
            word.append(b)
    lines = [line for line in bytes(data).split(b"\n") if line != b""]
    n, many, cased = max(len(data), 1), max(len(words), 1), max(sum(is_letter), 1)
    triples = {tuple(words[i : i + 3]) for i in range(len(words) - 2)}
    return [
        math.log(1 + len(data)), cased / n, sum(is_upper) / cased, digits / n, symbols / n, shouts / n, stops / n, spaces / n,
        sum(len(w) for w in words) / many, len(set(words)) / many, max((words.count(w) for w in set(words)), default=0) / many,
        sum(a == b for a, b in zip(words, words[1:])) / many, len(triples) / max(len(words) - 2, 1),
        len(set(lines)) / max(len(lines), 1), math.log(1 + many / max(len(lines), 1)), (shouts + symbols) / many,
    ]


def test_whole_table_by_plain_sums(spark):
    """Every row's score is the sum of what its figures find in the model's tables, looked up one by one."""
    small = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = fit(docs, labels)
    assert any(np.ptp(t) > 0 for t in model.tables) and len(model.pairs) == 5
    got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in quality_report(docs, labels).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        x = plain_features(r.text)
        total = model.intercept + sum(t[sum(c <= v for c in cuts)] for t, cuts, v in zip(model.tables, model.cuts, x, strict=True))
        for (i, j), t in zip(model.pairs, model.pair_tables, strict=True):
            total += t[sum(c <= x[i] for c in model.pair_cuts[i]), sum(c <= x[j] for c in model.pair_cuts[j])]
        want = 1 / (1 + math.exp(-total))
        held, found, predicted = got[r.doc_id]
        assert found == pytest.approx(want, abs=1e-9) and predicted == int(found >= 0.7)
        assert held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)

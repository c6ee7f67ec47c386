"""Language identification: held-out accuracy, families, undetermined texts."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from stockrisk.llm.language import fit_model, group_families, language_report, predict, profile, train, training_profiles
from stockrisk.llm.linear import fit_svms


def test_machines_part_what_can_be_parted():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 5))
    t = np.sign(np.stack([x[:, 0] - x[:, 1] + 0.3, x[:, 2] + 2 * x[:, 3]], axis=1))
    t[:50, 1] = 0
    w = fit_svms(x, t, steps=800)
    margin = np.concatenate([x, np.ones((300, 1))], axis=1) @ w
    assert ((margin * t > 0) | (t == 0)).mean() > 0.97


def test_families_hold_like_languages():
    rows = {"aa": "la casa es mi casa y la tuya", "ab": "la casa e mia casa e la tua", "ba": "das haus ist mein haus und deins", "bb": "dat huis is mijn huis en dijn"}
    groups = group_families(np.array([profile(t) for t in rows.values()]))
    assert sorted(sorted(g) for g in groups) == [[0, 1], [2, 3]]


def test_profiles_see_the_whole_text():
    assert np.allclose(profile("ab  cd\n1 ef"), profile("AB cd EF"))
    assert not np.allclose(profile("a" * 300000), profile("a" * 300000 + " quite another end of the text"))
    assert np.isfinite(profile("")).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = out[out["held_out"]]
    assert len(held) > 100 and (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert out["score"].between(0, 1).all()


def invented(languages, each):
    """Rows of languages whose words are drawn from syllables of their own."""
    rng = np.random.default_rng(1)
    parts = [["".join(rng.choice(list("abcdefghijklmnop"), 3)) for _ in range(6)] for _ in range(languages)]
    return [
        (l * 1000 + k, " ".join(rng.choice(parts[l], 30)), f"l{l:03d}") for l in range(languages) for k in range(each)
    ]


def test_every_language_is_learned(spark):
    rows = invented(230, 6)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    out = predict(docs, train(docs)).toPandas()
    right = out["lang_pred"] == out["lang"]
    assert right.mean() > 0.97 and out[right]["lang"].nunique() == 230


def test_machines_fitted_by_tasks_are_the_drivers(spark):
    docs = spark.createDataFrame(invented(9, 20), "doc_id long, text string, lang string").repartition(2)
    here, there = train(docs), train(docs, driver_rows=10)
    assert sorted(map(sorted, here.families)) == sorted(map(sorted, there.families)) and here.pairs == there.pairs
    assert np.allclose(here.family_weights, there.family_weights, atol=1e-3)
    assert np.allclose(here.pair_weights, there.pair_weights, atol=1e-3)


def test_sample_is_bounded_by_language_and_holds_no_copies(spark):
    rows = invented(2, 300) + [(7, "one text again and again", "l000")] * 2000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = training_profiles(docs, sample=100).toPandas()
    assert drawn["key"].is_unique
    assert all(60 < n < 140 for n in drawn["lang"].value_counts())


def test_edge_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", None), (4, "le chat et la souris " * 9, "fr"), (4, "le chat et la souris " * 9, "fr"),
            (6, "the cat and the mouse " * 9, "en"), (None, "der hund", None), (8, "the mouse " * 30000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(7)).withColumn("profile", F.lit(1))
    out = language_report(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == "fr" and got[6][0] == got[8][0] == "en"
    assert {r.lang_pred for r in language_report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language_report(docs.limit(0)).count() == 0
    one = fit_model(np.array([profile("only one")]), np.array(["xx"], dtype=object))
    assert [(r.lang_pred, r.score) for r in predict(docs.where("doc_id = 6"), one).collect()] == [("xx", 1.0)]


def plain_profile(text):
    """Counts of hashed byte pairs and triples of the letters, one by one."""
    data, letters = b" " + text.lower().encode() + b" ", []
    for b in data:
        c = b if b > 127 or 97 <= b <= 122 else 32
        if c != 32 or not letters or letters[-1] != 32:
            letters.append(c)
    counts = [0] * 4096
    for width, salt in ((2, 0x9E3779B1), (3, 0x85EBCA77)):
        for i in range(len(letters) - width + 1):
            gram = int.from_bytes(bytes(letters[i : i + width]), "big")
            counts[gram * salt % 2**32 >> 20] += 1
    size = math.sqrt(sum(counts))
    return [math.sqrt(c) / size for c in counts] + [1.0]


def plain_prediction(model, text):
    """The family of the greatest margin, then the language with the most duels won, margins breaking ties."""
    x = plain_profile(text)
    margins = [float(np.dot(x, w)) for w in model.family_weights.T]
    family = max(range(len(margins)), key=margins.__getitem__)
    sure = 1 / (1 + math.exp(-4 * margins[family])) if len(margins) > 1 else 1.0
    names = model.families[family]
    won, weakest = [0.0] * len(names), [math.inf] * len(names)
    for (f, a, b), w in zip(model.pairs, model.pair_weights.T, strict=True):
        if f == family:
            m = float(np.dot(x, w))
            for place, margin in ((a, m), (b, -m)):
                won[place] += (margin > 0) + 1e-3 * math.tanh(margin)
                weakest[place] = min(weakest[place], margin)
    best = max(range(len(names)), key=won.__getitem__)
    low = weakest[best]
    return names[best], sure if math.isinf(low) else sure / (1 + math.exp(-4 * low))


def test_whole_table_by_plain_margins(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = train(docs)
    assert sum(map(len, model.families)) == 4
    got = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language_report(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        held, lang, score = got[r.doc_id]
        assert held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if any(c.isalpha() for c in r.text or ""):
            want = plain_prediction(model, r.text)
            assert lang == want[0] and abs(score - want[1]) < 1e-4
        else:
            assert (lang, score) == ("und", 0.0)

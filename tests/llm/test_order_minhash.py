"""Order MinHash: the neighbour digest against a plain loop, and what the fingerprint is sensitive to."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockrisk.llm import order_minhash
from stockrisk.llm.order_minhash import _RUN, compare_neighbours, edited, elements, fingerprint, fingerprint_report, likeness


def plain_report(rows):
    """rows: (doc_id, text); ids differ."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for n, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(n + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        changed = (text[:-half] if half else text) + following[:half]
        own = fingerprint(text)
        out[doc] = (
            len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), fingerprint(changed).tobytes().hex(),
            likeness(own, fingerprint(changed)), likeness(own, fingerprint(following)),
        )
    return out


def test_elements_number_occurrences():
    once, twice = elements("a b c"), elements("a b c a b")
    assert len(once) == 2 and len(twice) == 4
    assert (twice[:2] == once).all() and twice[3] != twice[0] and len(set(twice.tolist())) == 4
    assert elements("ab c")[0] != elements("a bc")[0]
    assert (elements(" a\tb\x0bc\n") == once).all() and len(elements(" ")) == 1
    assert len(elements("x")) == 1 and len(elements(" \n")) == 0


def plain_slots(text, picks=2):
    """Slots from a plain selection of the smallest ranks, kept in text order."""
    from stockrisk.llm import order_minhash as o

    own = [int(x) for x in elements(text)]
    out = []
    for s in range(o.SLOTS):
        a, b = int(o._MULTIPLY[s]), int(o._ADD[s])
        ranks = []
        for e in own:
            r = (e * a + b) % 2**64
            ranks.append((r ^ (r >> 32)) * a % 2**64)
        value = np.zeros(1, np.uint64)
        for p, i in enumerate(sorted(sorted(range(len(own)), key=lambda i: ranks[i])[:picks])):
            value = o._mix(value * np.uint64(5) + np.uint64(own[i]) + np.uint64(p + 1))
        out.append(int(value[0]) >> 48)
    return out


@pytest.mark.parametrize("text", ["x", "a b", "a b c", "the cat sat on the mat and the cat sat on the hat", "w " * 700])
def test_slots(text):
    assert fingerprint(text).tolist() == plain_slots(text)


def test_order_and_edits():
    rng = random.Random(1)
    words = [f"w{rng.randrange(400)}" for _ in range(600)]
    text = " ".join(words)
    blocks = [words[i : i + 20] for i in range(0, 600, 20)]
    rng.shuffle(blocks)
    shuffled = " ".join(w for b in blocks for w in b)
    few = words[:]
    for i in rng.sample(range(600), 12):
        few[i] = "other"
    close = likeness(fingerprint(text), fingerprint(" ".join(few)))
    assert likeness(fingerprint(text), fingerprint(text)) == 1
    assert close > 0.6
    assert likeness(fingerprint(text), fingerprint(shuffled)) < close  # the same words, far by edits
    assert likeness(fingerprint(text), fingerprint(" ".join(f"x{w}" for w in words))) < 0.05
    assert edited("abcdé", "xyz") == "abcxy" and edited("a", "b") == "a" and edited("abcd", "") == "ab"


@pytest.mark.parametrize("text", ["日本語の文章には空白がないので言葉の切れ目が見えません。" * 20, "internationalisation localisation", "x1y2" * 200, "Ein Satz mit wenigen Wörtern, kurz."])
def test_likeness_without_blanks_and_with_few_words(text):
    last = text[:-1] + "Q"
    assert fingerprint(text).tolist() == plain_slots(text)
    assert likeness(fingerprint(text), fingerprint(text)) == 1
    assert likeness(fingerprint(text), fingerprint(last)) > (0.9 if len(text) > 500 else 0.5)
    assert likeness(fingerprint(text), fingerprint("0123456789" * 60)) < 0.3


def test_repeated_rows_are_compared_once(spark, monkeypatch):
    """One row is a third of the table: each row gets its result, no task reads more of it than there are tasks."""
    rows = [(500, "the repeated row " * 9)] * 300 + [(i, f"text number {i} of its own " * 3) for i in range(600)] + [(700, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    ordered = sorted(rows, key=lambda r: (-r[0], r[1] == "the repeated row " * 9))
    xx = {r.text: r.ka for r in docs.select("text", F.xxhash64("text").alias("ka")).distinct().collect()}
    ordered = sorted(rows, key=lambda r: (-r[0], xx[r[1]]))
    want = []
    for n, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(n + 1) % len(ordered)][1] or ""
        changed = edited(text, following)
        want.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), likeness(fingerprint(text), fingerprint(following))))
    got = fingerprint_report(docs).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.near_next) for r in got) == sorted(want)
    read = docs.select("doc_id", F.lit(1).cast("long").alias("ka"), F.xxhash64("text").alias("kb"), F.coalesce("text", F.lit("")).alias("text"))
    once = read.mapInArrow(order_minhash._collapse, "doc_id long, ka long, kb long, text string, many long").where("doc_id = 500")
    assert once.count() <= 14 and once.agg(F.sum("many")).first()[0] == 301


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "z"), (None, "w")], "doc_id string, text string")
    got = {r.doc_id: r.edited_sha256 for r in fingerprint_report(docs).collect()}
    assert got == {"b": hashlib.sha256(b"x z"[:2] + b"z").hexdigest(), "a": hashlib.sha256(b"z").hexdigest(), None: hashlib.sha256(b"w").hexdigest()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_whole_table(spark, partitions):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next)
               for r in fingerprint_report(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert got == plain_report([(r.doc_id, r.text) for r in docs.collect()])


def test_edge_rows(spark):
    rows = [(9, None), (2**60 + 1, "😀é " * 9), (4, ""), (-3, "a b c d e f"), (None, "last one"), (7, "z" * 50000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("partition", F.lit(1)).withColumn("place", F.lit(5))
    want = plain_report(rows)
    got = fingerprint_report(docs).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in got} == want
    assert fingerprint_report(docs.limit(0)).count() == 0
    one = fingerprint_report(docs.where("doc_id = -3")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprint_report(docs.union(docs)).count() == 12
    assert "place int" in _RUN and compare_neighbours(docs).count() == 6

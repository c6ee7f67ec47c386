"""The mix against a plain sort and prefix sum of the same keys."""

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stockrisk.llm.mixing import mix, mix_report, mixed_documents


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, left = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        shared = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / shared > most * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / shared for s in free}
        for s in over:
            capped.add(s)
            target[s] = most * sizes[s]
        left = sum(sizes.values()) - sum(target[s] for s in capped)


def plain_mix(rows, targets):
    """rows: (source, size, quality, hash). Copies of each row by the sorted keys of its source."""
    copies, by = {}, defaultdict(list)
    for i, (source, size, quality, h) in enumerate(rows):
        uniform = ((h % 2**64 >> 11) + 1) / 2**53
        by[source].append((-math.log(uniform) / quality, h, i, size))
    for source, own in by.items():
        total = sum(s for *_, s in own)
        epochs = math.floor(targets[source] / total) if total else 0
        budget, upto = targets[source] - epochs * total, 0
        for _, _, i, size in sorted(own):
            copies[i] = epochs + (budget > 0 and upto + size / 2 <= budget)
            upto += size
    return copies


def quality_of(text, size):
    return max(0.05, math.exp(-abs(len(text) / max(size, 1) - 6) / 6)) if text is not None else 0.05


@pytest.mark.parametrize("options", [{}, {"weights": (1.0, 40.0), "most": 2.0}])
def test_whole_table(spark, options):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    out = mix(docs, **options).collect()
    assert len(out) == len(texts)
    rows, sizes = [], defaultdict(int)
    for r in out:
        source, text = texts[r.doc_id]
        size = len(re.findall(r"[^\x20\x09-\x0D]+", text))
        assert r["size"] == size
        sizes[source] += size
        rows.append((source, size, quality_of(text, size), r.row_hash))
    targets = plain_targets(sizes, options.get("weights", (5, 2, 1)), options.get("most", 3))
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    want = plain_mix(rows, targets)
    assert {i: r.copies for i, r in enumerate(out)} == want
    taken = defaultdict(int)
    for r in out:
        taken[r.source] += r["size"] * r.copies
    for s, t in targets.items():
        assert abs(taken[s] - t) <= max(r["size"] for r in out if r.source == s) / 2 + 1e-6


def test_rows_come_as_often_as_taken_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    copies = {r.doc_id: r.copies for r in mix(docs).collect()}
    out = mixed_documents(docs.repartition(7))
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += 1
    assert dict(got) == {d: c for d, c in copies.items() if c}


@pytest.mark.parametrize("seed", range(4))
def test_repeated_rows_are_taken_by_number(spark, seed):
    """Rows equal in id and text are a third of the table, and the budget ends among them."""
    rows = [(1, "w " * 180, "a")] * 600 + [(i, "v " * (i % 40 + 1), "ab"[i % 7 > 0]) for i in range(2, 1200)] + [(5000, "one small text", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    out = mix(docs, seed=seed).collect()
    assert len(out) == len(rows)
    texts = {d: t for d, t, _ in rows}
    listed = [(r.source, r["size"], quality_of(texts[r.doc_id], r["size"]), r.row_hash) for r in out]
    targets = {r.source: r.target for r in out}
    want = plain_mix(listed, targets)
    assert sorted((r.doc_id, r.copies) for r in out) == sorted((r.doc_id, want[i]) for i, r in enumerate(out))
    assert len({r.copies for r in out if r.doc_id == 1}) == 2
    for source, target in targets.items():
        assert abs(sum(r["size"] * r.copies for r in out if r.source == source) - target) <= 90
    copies = sorted(r.doc_id for r in out for _ in range(r.copies))
    assert sorted(r.doc_id for r in mixed_documents(docs, seed=seed).collect()) == copies


def test_edge_rows(spark):
    rows = [(1, "a b c", None), (2, None, "s"), (3, "", "s"), (4, "one two", "r"), (4, "one two", "r"), (None, "w " * 30000, "r"), (7, "x", "é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in ("size", "rank", "target", "copies", "budget"):
        docs = docs.withColumn(c, F.lit("clash"))
    out = mix_report(docs).collect()
    assert len(out) == len(rows) and all(r.taken <= 3 * r["size"] for r in out)
    sizes = {"r": 30004, "s": 0, "é": 1, None: 3}
    targets = plain_targets(sizes)
    by = {(r.source_size): r.target for r in out}
    assert by == {sizes[s]: pytest.approx(t) for s, t in targets.items()}
    assert mix_report(docs.limit(0)).count() == 0
    assert mix_report(docs.where("doc_id = 3")).first().taken == 0
    assert mixed_documents(docs).columns == docs.columns

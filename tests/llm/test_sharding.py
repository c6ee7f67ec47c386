"""Sampled splitters: the laws of the shards, on the tables and on hot texts."""

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stockrisk.llm import sharding
from stockrisk.llm.sharding import SHARDS, shard_by_bytes, shard_report
from stockrisk.sources.sinks import pin


def check_laws(rows, out, shards=SHARDS):
    """Every row once, true sizes and checksums, gapless slots; returns bytes by shard."""
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in out) == want
    slots, load = defaultdict(list), Counter()
    for r in out:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        load[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return load


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = shard_report(docs).collect()
    load = check_laws(rows, out)
    largest, total = max(len(t.encode()) + 8 for _, t in rows), sum(load.values())
    assert len(load) == SHARDS and max(load.values()) - min(load.values()) <= largest + 0.125 * total / SHARDS
    assert {r.law for r in out} == {"bytes"} and {r.grown_shard for r in out} == {None}
    homes = defaultdict(set)
    for r in out:
        homes[r.text_crc32, r["size"]].add(r.shard)
    assert all(len(h) == 1 for h in homes.values())  # no text's copies are an eighth of a shard here


def test_hot_text_is_spread(spark):
    rows = [(i, "the same text over and over" * 10) for i in range(3000)] + [(i, f"text {i} " * (i % 50)) for i in range(3000, 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    load = check_laws(rows, shard_by_bytes(docs).collect())
    mean = sum(load.values()) / SHARDS
    assert len(load) == SHARDS and max(load.values()) < 1.05 * mean and min(load.values()) > 0.95 * mean
    again = {(r.doc_id, r.shard, r.slot) for r in shard_by_bytes(docs.repartition(3)).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in shard_by_bytes(docs).collect()}


def test_a_text_of_many_rows_and_few_bytes_is_cut_into_cells(spark, monkeypatch):
    """A third of the rows is empty: they share a shard, but no task holds them all."""
    kept = {}
    monkeypatch.setattr(sharding, "pin", lambda df, name: kept.setdefault(name, pin(df, name)))
    rows = [(i, "") for i in range(3000)] + [(i, f"text {i} " * 200) for i in range(3000, 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = shard_by_bytes(docs, most_rows=500).collect()
    load = check_laws(rows, out)
    assert len({r.shard for r in out if r["size"] == 8}) == 1
    assert max(load.values()) < 1.05 * sum(load.values()) / SHARDS
    starts = sorted(r.rows_before for r in kept["cells"].collect()) + [len(rows)]
    assert max(b - a for a, b in zip(starts, starts[1:])) < 750


def test_a_repeated_row_is_one_row_until_the_end(spark, monkeypatch):
    """Rows equal in id and text, a third of the table by rows and more than a shard by bytes."""
    kept = {}
    monkeypatch.setattr(sharding, "pin", lambda df, name: kept.setdefault(name, pin(df, name)))
    rows = [(7, "the same row " * 30)] * 3000 + [(i, f"text {i} " * 40) for i in range(3000, 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = shard_by_bytes(docs, most_rows=500).collect()
    load = check_laws(rows, out)
    mean = sum(load.values()) / SHARDS
    assert max(load.values()) < 1.05 * mean and min(load.values()) > 0.95 * mean
    assert kept["keyed"].where("n > 1").count() == 1 and kept["placed"].count() == 6001


@pytest.mark.parametrize("shards", [1, 5])
def test_edge_rows(spark, shards):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (4, "é" * 60000), (5, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("size", "h", "range", "piece", "shard"):
        docs = docs.withColumn(c, F.lit("clash"))
    check_laws(rows, shard_by_bytes(docs, shards).collect(), shards)
    assert shard_report(docs.limit(0)).count() == 0


def test_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = shard_report(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

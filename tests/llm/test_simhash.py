"""SimHash near-dedup against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stockrisk.llm.bitslice import near_pairs
from stockrisk.llm.simhash import blocks_for, fingerprint, keep_one_per_component, link_fingerprints, near_dedup, simhash_components


def plain_fingerprint(text, width=4):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in folded + " ":
        if c in " \t\n\v\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin(a ^ b).count("1") <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "a b c", "a B c d", "x " * 500, "Ä É ab\x0bcd\x1cef gh " * 7, "w" * 40000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_native_hash_agrees(spark):
    rows = spark.createDataFrame([("a b c d",)], "t string").select(F.xxhash64("t")).first()
    assert rows[0] % 2**64 == xxhash.xxh64(b"a b c d", seed=42).intdigest()


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(9)] + [base])
    for sizes in ([400], [1] * 400, [63, 64, 65, 200, 8], [20] * 20):
        run = np.repeat(np.arange(len(sizes)), sizes)
        got = sorted((int(i), int(j)) for a, b in near_pairs(fps, run, radius) for i, j in zip(a, b, strict=True))
        want = [
            (i, j)
            for i in range(400)
            for j in range(i + 1, 400)
            if run[i] == run[j] and int(fps[i] ^ fps[j]).bit_count() <= radius
        ]
        assert got == want


@pytest.mark.parametrize("tile", [4096, 7])
def test_components_over_tiles(spark, tile):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for b in base for _ in range(5)} | {0}
    signed = {f: f - 2**64 if f >= 2**63 else f for f in fps}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = {r.node: r.component for r in link_fingerprints(frame, tile=tile).collect()}
    want = plain_components(list(fps), 4)
    groups = {}
    for f, root in want.items():
        groups.setdefault(root, []).append(signed[f])
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_blocks_grow_with_the_rows_and_links_stay(spark):
    for rows in (0, 10**6, 10**9, 10**10, 10**12):
        blocks = blocks_for(rows)
        edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
        bits = sum(sorted(b - a for a, b in zip(edges, edges[1:]))[: blocks - 4])
        assert rows / 2**bits <= 1025
    assert [blocks_for(n) for n in (0, 10**8, 10**10, 10**12, 10**15)] == [6, 6, 7, 8, 9]
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for b in base for _ in range(5)})
    frame = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    found = [sorted(map(tuple, link_fingerprints(frame, blocks=b).collect())) for b in (None, 6, 7, 8, 9)]
    assert found[0] and all(f == found[0] for f in found)


def test_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(5, long), (3, long), (9, None), (8, ""), (8, ""), (None, "a b c d e"), (11, "solo text here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("x")).withColumn("fp", F.lit(1))
    got = {(r.doc_id, r.component_id) for r in near_dedup(docs).collect()}
    assert got == {(5, 3), (3, 3), (9, 8), (8, 8), (None, None), (11, 11)}
    assert near_dedup(docs).count() == 7
    kept = keep_one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 8, 11]
    assert near_dedup(docs.limit(0)).count() == 0


def test_ids_that_are_missing_or_shared(spark):
    rows = [(None, "a b c d e"), (None, "q r s t u v"), (None, "q r s t u v"), (4, "one text with words"), (4, "quite another one here"),
            (4, "one text with words"), (2, "one text with words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id or 0, r.text) for r in keep_one_per_component(docs).collect()))
    assert kept == [(0, "a b c d e"), (0, "q r s t u v"), (2, "one text with words"), (4, "quite another one here")]


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: plain_fingerprint(r.text) for r in docs.collect()}
    roots = plain_components(list(set(texts.values())), 4)
    first = {}
    for d in sorted(texts):
        first.setdefault(roots[texts[d]], d)
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in simhash_components(docs).collect()}
    assert got == {d: (f, first[roots[f]]) for d, f in texts.items()}

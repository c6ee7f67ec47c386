"""Product-quantised near-dedup against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockrisk.llm.embedding_dedup import near_dedup
from stockrisk.llm.quantize import Index


def brute_force(rows, cosine=0.98):
    """(vec_id, n_links, component_id) of (vec_id, vector, label)."""
    usable = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(usable):
        a = np.array(rows[i][1], dtype=np.float64)
        for j in usable[n + 1 :]:
            b = np.array(rows[j][1], dtype=np.float64)
            if rows[i][2] == rows[j][2] and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    return sorted((rows[i][0], links[i], min(groups[find(i)])) for i in range(len(rows)))


def run(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    frame = frame.withColumn("vector", F.lit("clash")).withColumn("rid", F.lit(0))
    out = near_dedup(frame, **options).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


def as_floats(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("options", [{}, {"lists": 40, "filed_tile": 16, "query_tile": 32}])
def test_chains_copies_and_hot_labels(spark, options):
    rng = np.random.default_rng(4)
    rows = []
    for centre in rng.normal(size=(12, 24)):
        for k in range(20):  # steps along a path: chains of links
            centre = centre + rng.normal(size=24) * 0.12
            rows.append((len(rows), as_floats(centre * rng.uniform(0.1, 50)), int(k % 7 == 0)))
    rows += [(len(rows) + i, rows[3][1], rows[3][2]) for i in range(30)]
    rows += [(1000, rows[3][1], 5), (1000, rows[3][1], 5)]
    assert run(spark, rows, **options) == brute_force(rows)


def test_edge_rows(spark):
    v = as_floats([1, 2, 3])
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 2.0], 1), (5, [1.0, float("nan")], 1),
        (6, [float("inf"), 1.0, 1.0], 1), (7, v, None), (8, v, None), (9, v, 2), (10, v, 3), (11, as_floats([2, 4, 6]), 3),
        (12, as_floats([1, 2, 3, 0]), 3), (13, as_floats([-1, -2, -3]), 3), (14, [1e-30, 2e-30, 3e-30], 4), (15, [1e18, 2e18, 3e18], 4),
    ]
    assert run(spark, rows) == brute_force(rows)
    assert near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert run(spark, rows[:3]) == [(1, 0, 1), (2, 0, 2), (3, 0, 3)]


def test_components_of_any_size_and_labels_of_any_type(spark):
    vectors = [[1e200, 2e200], [1e200, 2.0001e200], [-1e200, 2e200], [1e-310, 2e-310], [3e-310, 6e-310], [5e-324, 1e-323], [1.0, 2.0], [2.0, -1.0], [1e308, -5e307]]
    rows = [(i, v, "ab"[i == 1]) for i, v in enumerate(vectors)] + [(i + 20, v, "c") for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_dedup(frame).collect())
    alike = {20 + i for i in (0, 1, 3, 4, 5, 6)}
    assert {g[0] for g in got if g[2] == 20} == alike and all(g[1] == 5 for g in got if g[0] in alike)
    assert {g[0] for g in got if g[2] == 0} == {0, 3, 4, 5, 6} and [g for g in got if g[0] == 1] == [(1, 0, 1)]
    assert {g[0] for g in got if g[2] == 27} == {27, 28}
    halves = spark.createDataFrame([(1, [1.0, 2.0], 1.2), (2, [1.0, 2.0], 1.7), (3, [2.0, 4.0], 1.2)], "vec_id long, embedding array<double>, label double")
    assert sorted((r.vec_id, r.component_id) for r in near_dedup(halves).collect()) == [(1, 1), (2, 2), (3, 1)]


def test_probes_and_bounds_lose_nothing():
    rng = np.random.default_rng(0)
    rows = rng.normal(size=(3000, 16))
    rows[1500:] = rows[:1500] + rng.normal(size=(1500, 16)) * 0.03
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    index = Index.fit(rows[::3], 50, 8)
    home, reach = index.probes(rows, 0.2)
    codes, error = index.encode(rows, home)
    for a, b in zip(*np.nonzero((rows @ rows.T >= 0.98)), strict=True):
        assert reach[a, home[b]]
        assert index.table_distances(rows[a : a + 1], home[b], codes[b : b + 1])[0, 0] <= 0.2 + error[b] + 1e-6
    assert reach.mean() < 0.9


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in frame.collect()]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in near_dedup(frame).collect())
    assert got == brute_force(rows)

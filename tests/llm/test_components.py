"""Connected components against a plain union-find."""

import random

import numpy as np
import pytest

from stockrisk.llm.common import connected_components
from stockrisk.llm.unionfind import local_roots


def plain_roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in (e for e in edges if e[0] != e[1]):
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


GRAPHS = {
    "path": [(i, i + 1) for i in range(40)],
    "star": [(0, i) for i in range(1, 300)] + [(500, i) for i in range(501, 520)],
    "random": [(random.Random(i).randrange(200), random.Random(i + 999).randrange(200)) for i in range(150)],
    "loops and repeats": [(5, 5), (3, 2), (2, 3), (3, 2), (-7, 2)],
    "nothing": [(1, 1)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_graphs(spark, name):
    edges = GRAPHS[name]
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()}
    want = plain_roots(nodes, edges)
    assert {n: got.get(n, n) for n in nodes} == want
    if all(n >= 0 for n in nodes) and nodes:
        at = {n: i for i, n in enumerate(sorted(nodes))}
        pairs = np.array([(at[a], at[b]) for a, b in edges if a != b])
        roots = local_roots(len(at), pairs[:, 0], pairs[:, 1])
        assert {n: sorted(nodes)[roots[at[n]]] for n in nodes} == want

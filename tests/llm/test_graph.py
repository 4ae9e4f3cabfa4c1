import random

import pytest

from lakeworks.llm import graph


def least_reachable(edges):
    """Least node of each node's component, by plain Python; edges with a null end and loops are left out."""
    root = {}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            root.setdefault(a, a)
            root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in root and b in root and a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return sorted(root.items())


def edges_of(kind):
    draw = random.Random(4)
    if kind == "stars":
        return [(0, n) for n in range(1, 20)] + [(n, 30) for n in range(31, 40)]
    if kind == "path":
        return [(n + 1, n) for n in range(40)]
    if kind == "centre is not least":
        return [(50, n) for n in range(20)]
    if kind == "none":
        return [(None, 1), (2, None), (3, 3)]
    found = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)]
    return found + [(b, a) for a, b in found[:9]] + found[:5] + [(None, 3), (61, None), (62, 62)]


@pytest.mark.parametrize("kind", ["stars", "path", "centre is not least", "none", "random"])
def test_components_by_brute_force(spark, kind):
    edges = edges_of(kind)
    found = graph.components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert sorted(map(tuple, found.collect())) == least_reachable(edges)


def test_edges_that_are_stars_take_no_round(spark, monkeypatch):
    """Every round is some thousand tasks on many partitions, of which the driver keeps a record each."""
    tables = []
    monkeypatch.setattr(graph, "stored", lambda df, label, make=graph.stored: tables.append(label) or make(df, label))
    for kind, most in (("stars", 1), ("centre is not least", 2)):
        tables.clear()
        graph.components(spark.createDataFrame(edges_of(kind), "a long, b long"), "a", "b").collect()
        assert len(tables) <= most, kind

import random

from casegrid.llm.components import components


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(k, k + 1) for k in range(100, 160)]  # a path
    edges += [(500, k) for k in range(501, 560)]  # a star
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(220)]
    edges += [(7, 7), (9, 8), (8, 9)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

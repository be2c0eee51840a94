import random

from usagelens.llm import common


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)] + [(7, 7), (400, 399), (399, 400)]
    parent = list(range(401))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in edges:
        parent[max(top(a), top(b))] = min(top(a), top(b))
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {n: top(n) for n in nodes}
    assert len(got) == len(nodes)
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []

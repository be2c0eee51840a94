import math

import numpy as np
import pytest

from usagelens.llm import negatives
from usagelens.llm.sql import SQL

from compare import difference, open_tables

KIND = "vec_id long, embedding array<float>, label int, query string, leaf string"


def brute(rows):
    usable = []
    for i, e, label in rows:
        if None not in (i, e, label) and all(v is not None and math.isfinite(v) for v in e):
            usable.append((i, [math.floor(256 * float(np.float32(v))) for v in e], label))
    out = []
    for k, (anchor, a, label) in enumerate(usable):
        if anchor % 100:
            continue
        scored = [
            (-sum(p * q for p, q in zip(a, b)), i, other)
            for j, (i, b, other) in enumerate(usable)
            if j != k and len(a) == len(b)
        ]
        same = sorted((s, i) for s, i, other in scored if other == label)[:5]
        rest = sorted((s, i) for s, i, other in scored if other != label)
        for s, i in same:
            inside = [(t, j) for t, j in rest if 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(anchor, i, n + 1, j, -s, -t) for n, (t, j) in enumerate(inside)]
    return sorted(out)


def found(spark, rows):
    df = spark.createDataFrame([(i, e, label, "q", "l") for i, e, label in rows], KIND)
    out = negatives.hard_negatives(df.drop("query", "leaf")).drop("positive_rank")
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for centre in range(10):
        x = rng.standard_normal(12)
        for k in range(30):
            v = (x + rng.standard_normal(12) * rng.uniform(0, 1)) / 4
            out.append((len(out) * 5, v.astype(np.float32).tolist(), k % 3))
    same = out[0][1]
    # A group of copies, repeated ids, ties, and anchors among all of them.
    out += [(3000 + 10 * k, same, k % 2) for k in range(100)] + [(100, same, 1)] * 3
    out += [
        (None, same, 0),
        (400, None, 0),
        (500, [], 0),
        (502, [], 1),
        (503, [], 0),
        (600, [0.0] * 12, 0),
        (700, [float("nan")] + same[1:], 0),
        (800, [float("inf")] + same[1:], 0),
        (900, [None] + same[1:], 0),
        (1000, same, None),
        (1100, same[:4], 0),
        (1101, same[:4], 0),
        (1102, same[:4], 2),
        (-200, same, 2),
    ]
    return out


def test_equals_brute_force(spark, rows):
    true = brute(rows)
    assert len(true) > 150
    assert found(spark, rows) == true


@pytest.mark.parametrize("leaf, ways, block", [(40, 4, 16)])
def test_deep_trees_and_small_blocks_give_the_same(spark, rows, monkeypatch, leaf, ways, block):
    for name, value in (("LEAF_ROWS", leaf), ("WAYS", ways), ("DRAWN", 2 * ways), ("BLOCK_ROWS", block)):
        monkeypatch.setattr(negatives, name, value)
    assert found(spark, rows) == brute(rows)


def test_tree_holds_every_entry_once_and_prunes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF_ROWS", 30)
    rng = np.random.default_rng(1)
    data = [
        (i, (rng.standard_normal(6) * 0.02 + np.eye(6)[i % 6]).tolist(), i % 5) for i in range(900)
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    every = negatives.entries(negatives.quantised(df))
    leaves, levels = negatives.build(every)
    assert levels and leaves.count() == every.count()
    assert leaves.groupBy("leaf").count().agg({"count": "max"}).first()[0] <= 30
    queries = leaves.filter("array_contains(ids, 0)").selectExpr(
        "entry AS query", "x", "array(60000L) AS low", "array(70000L) AS high"
    )
    visited = {r["leaf"] for r in negatives.walk(queries, levels).collect()}
    here = {r["leaf"] for r in leaves.filter("exists(ids, i -> i % 6 = 0)").collect()}
    assert visited & here and len(visited) < leaves.select("leaf").distinct().count() / 2


def test_products_beyond_doubles_are_exact():
    a = np.array([[2**31, 3]], np.int64)
    b = np.array([[2**31 - 1, 5], [2**40, 2**40]], np.int64)
    assert negatives.products(a, b).tolist() == [[2**31 * (2**31 - 1) + 15, min(2**63 - 1, 2**71 + 3 * 2**40)]]


def test_empty_table(spark):
    assert found(spark, []) == []


def test_sample_with_small_leaves_equals_sql(spark, monkeypatch):
    from usagelens.llm.queries import QUERIES

    monkeypatch.setattr(negatives, "LEAF_ROWS", 40)
    path = "/root/testdata/sf0.001"
    df = QUERIES["op11_hard_negatives"](spark, path)
    assert difference(df, open_tables(path), SQL["op11_hard_negatives"]) is None

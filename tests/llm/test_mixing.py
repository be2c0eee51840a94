from collections import defaultdict

import pytest

from usagelens.llm import mixing


def filled(sizes, weights, share=1.5, most=2):
    """Water-filling one source at a time."""
    target, free, budget = {}, dict(weights), share * sum(sizes.values())
    while free:
        level = budget / sum(free.values())
        over = [s for s in free if most * sizes[s] < free[s] * level]
        if not over:
            return target | {s: w * level for s, w in free.items()}
        for s in over:
            target[s] = most * sizes[s]
            budget -= target[s]
            del free[s]
    return target


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


@pytest.mark.parametrize("counts", [{"a": 50, "b": 1, "c": 3, None: 30}, {"z": 4}, {"a": 1, "b": 90, "c": 1, "d": 1}])
def test_targets_and_taken_words(spark, counts):
    rows, k = [], 0
    for source, n in counts.items():
        for j in range(n):
            rows.append((k, "w " * (1 + (j * 13) % 40), source))
            k += 1
    got = mixing.mix(table(spark, rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(text.split())
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    true = filled(sizes, {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)})
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(true[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in true.items():
        assert abs(taken[source] - target) <= 1
    again = mixing.mix(table(spark, rows).repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)


def test_hostile_rows(hostile, nothing):
    rows = mixing.mix(hostile).collect()
    assert len(rows) == hostile.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (3, 4, 5))
    assert mixing.mix(nothing).collect() == []
    out = mixing.mixed(hostile)
    assert out.columns == hostile.columns
    assert out.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed(nothing).collect() == []


def test_words_are_runs_of_other_than_ascii_space(spark):
    rows = table(spark, [(1, " a b\tc\x0bd\x1fe\r\n", "s"), (2, " ", "s")])
    assert sorted((r["doc_id"], r["size"]) for r in mixing.mix(rows).collect()) == [(1, 3), (2, 1)]

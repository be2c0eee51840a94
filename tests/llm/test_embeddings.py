import math

import numpy as np
import pytest

from usagelens.llm import embeddings

KIND = "vec_id long, embedding array<float>, label int, node string, table string"


def brute(rows):
    usable = {}
    for k, (i, e, label) in enumerate(rows):
        ok = label is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(e)
        if ok:
            usable[k] = np.array(e, np.float32).astype(float)
    links = {k: set() for k in range(len(rows))}
    for k in usable:
        for j in usable:
            if j != k and rows[k][2] == rows[j][2] and len(usable[k]) == len(usable[j]):
                a, b = usable[k], usable[j]
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= embeddings.THRESHOLD:
                    links[k].add(j)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[k][0], len(links[k]), low, rows[k][0] is not None and rows[k][0] == low))
    return sorted(out, key=repr)


def found(spark, rows):
    df = spark.createDataFrame([(i, e, label, "n", "t") for i, e, label in rows], KIND)
    return sorted((tuple(r) for r in embeddings.near_vectors(df).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = []
    for centre in range(12):
        x = rng.standard_normal(16)
        for k in range(14):
            v = (x + rng.standard_normal(16) * rng.uniform(0, 0.5)).astype(np.float32)
            out.append((len(out), v.tolist(), centre % 3))
    same = out[0][1]
    out += [(900 + k, same, 0) for k in range(30)] + [(950, [2 * v for v in same], 0), (951, same, 1)]
    out += [
        (None, same, 0),
        (None, None, 0),
        (960, None, 0),
        (961, [], 0),
        (962, [0.0] * 16, 0),
        (963, [float("nan")] + same[1:], 0),
        (964, [float("inf")] + same[1:], 0),
        (965, [None] + same[1:], 0),
        (966, same, None),
        (967, same[:8], 0),
        (901, same, 0),
    ]
    return out


def test_links_and_components_equal_brute_force(spark, rows):
    true = brute(rows)
    assert sum(r[1] for r in true) > 1000
    assert found(spark, rows) == true


def test_blocks_do_not_change_the_result(spark, rows, monkeypatch):
    monkeypatch.setattr(embeddings, "BUCKET_ROWS", 8)
    assert found(spark, rows) == brute(rows)


def test_block_links_of_split_buckets(rows):
    import pandas as pd

    usable = [(i, e) for i, e, label in rows[:60]]
    x = np.array([e for _, e in usable])
    hashes = embeddings.sign_hashes(x, 2, 3, 1)
    frame = pd.DataFrame(
        {
            "node": [i for i, _ in usable],
            "weight": 1,
            "embedding": [np.array(e, np.float32) for _, e in usable],
            "hashes": [h.tobytes() for h in hashes],
        }
    )
    whole = embeddings.block_links(frame.assign(block=0), 0, 0, 0, 0.9).groupby("node").links.sum()
    split = frame.assign(block=np.arange(60) % 2)
    parts = [embeddings.block_links(split[split.block.isin([i, j])], 0, i, j, 0.9) for i, j in ((0, 0), (0, 1), (1, 1))]
    assert pd.concat(parts).groupby("node").links.sum().to_dict() == whole.to_dict()


def test_tables_meet_the_promised_miss():
    for largest in (1, 100, 10**4, 10**7):
        bits, tables = embeddings.plan_tables(largest, 0.93, 1e-6)
        agree = (1 - math.acos(0.93) / math.pi) ** bits
        assert (1 - agree) ** tables <= 1e-6


def test_empty_table(spark):
    assert found(spark, []) == []

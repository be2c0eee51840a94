import random

from pyspark.sql import functions as F

from usagelens.llm import lines


def distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_edit_distance_equals_the_full_table(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé\U0001f600 ") for _ in range(rng.randint(1, 14)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é"])
        pairs.append((a, "".join(b) or "y"))
    df = spark.createDataFrame(pairs, "a string, b string")
    for edits in (1, 2, 3):
        got = df.withColumn("d", lines.edit_distance(F.col("a"), F.col("b"), edits)).collect()
        for row in got:
            true = distance(row["a"], row["b"])
            assert row["d"] == (true if true <= edits else None), (row, true)


def test_links_equal_brute_force(spark):
    rng = random.Random(2)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(20, 60))).strip() + "z" * 3 for _ in range(40)]
    texts = set(base)
    for line in base:
        for edits in (1, 2, 3):
            t = list(line)
            for _ in range(edits):
                at = rng.randrange(len(t))
                t[at : at + 1] = rng.choice([[], [t[at], "q"], ["q"]])
            texts.add("".join(t).strip())
    texts = sorted(t for t in texts if len(t) >= lines.SHORTEST)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = lines.line_classes(docs).select("doc_id", "n_links", "class_doc").collect()
    true = {k: {j for j, b in enumerate(texts) if j != k and distance(a, b) <= lines.EDITS} for k, a in enumerate(texts)}
    assert sum(map(len, true.values())) > 50
    assert {r["doc_id"]: r["n_links"] for r in found} == {k: len(v) for k, v in true.items()}


def test_hostile_rows(hostile, nothing):
    found = lines.line_classes(hostile)
    rows = found.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert 3 not in by_doc and 4 not in by_doc and 5 not in by_doc
    assert [r["kept"] for r in sorted(by_doc[10], key=lambda r: r["line_no"])] == [True, False, True]
    near = min(by_doc[11], key=lambda r: r["line_no"])
    assert (near["class_doc"], near["class_line"], near["kept"], near["n_links"]) == (10, 0, False, 1)
    assert sum(r["kept"] for r in by_doc[1] + by_doc[2]) == 1
    assert lines.line_classes(nothing).collect() == []


def test_dedup_keeps_columns_and_blank_lines(hostile):
    out = lines.dedup_lines(hostile)
    assert out.columns == hostile.columns and out.count() == hostile.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[11] == "\n\nand one more line that stands alone"
    assert texts[3] is None and texts[4] == ""

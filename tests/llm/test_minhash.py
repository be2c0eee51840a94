import random

import numpy as np

from usagelens.llm import minhash
from .texts import prose


def lcs(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(before[j] + 1 if x == y else max(before[j + 1], now[-1]))
        before = now
    return before[-1]


def test_alignment_equals_the_full_table():
    rng = random.Random(5)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randint(1, 40))]
        b = [x for x in a if rng.random() > 0.08]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(12))
        n = lcs(a, b)
        true = n / (len(a) + len(b) - n) if b else 0.0
        got = minhash.aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert abs(got - (true if true >= minhash.THRESHOLD else 0.0)) < 1e-9


def test_shingles_ignore_case_and_marks_and_span_five_words():
    s = minhash.Shingler()
    assert (s.shingles("One, TWO three four five six") == s.shingles("one two  three four-five six")).all()
    assert len(s.shingles("a b c d e f g")) == 3 and len(s.shingles("a b")) == 1
    assert len(s.shingles(None)) == len(s.shingles("?!")) == 0
    once, again = s.shingles("a b c d e"), s.shingles("x a b c d e")
    assert once[0] == again[1]
    known = s.labelled(s.shingles("a a a a a a a a a"))
    assert len(set(known.tolist())) == len(known)


def test_classes_equal_brute_force(spark):
    rng = random.Random(7)
    texts = []
    for k in range(25):
        words = prose(k, rng.randint(60, 200)).split()
        words = [w + str(k) for w in words]
        for edits in (0, 1, 2, 4, 8):
            copy = list(words)
            for _ in range(edits):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    s = [minhash.Shingler().shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(texts)):
        for j in range(i):
            if minhash.aligned(s[i], s[j]) > 0:
                parent[max(top(i), top(j))] = min(top(i), top(j))
    assert got == {k: top(k) for k in range(len(texts))}
    assert 25 < len(set(got.values())) < len(texts)


def test_large_group_of_copies_is_one_class(spark):
    words = prose(3, 120).split()
    rng = random.Random(1)
    texts = []
    for k in range(400):
        copy = list(words)
        copy[rng.randrange(len(copy))] = f"edit{k}"
        texts.append(" ".join(copy) if k % 3 else " ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = minhash.near_duplicates(docs).collect()
    assert {r["class_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1


def test_hostile_rows(hostile, nothing):
    rows = minhash.near_duplicates(hostile).collect()
    assert len(rows) == hostile.count()
    classes = {}
    for r in rows:
        classes.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert classes[1] == classes[2] == {1} and classes[8] == {7}
    assert classes[3] == {3} and classes[4] == {4} and classes[5] == {5}
    assert sum(r["kept"] for r in rows if r["doc_id"] in (1, 2)) == 1
    out = minhash.deduplicated(hostile)
    assert out.columns == hostile.columns and out.count() == hostile.count() - 3
    assert minhash.near_duplicates(nothing).collect() == []

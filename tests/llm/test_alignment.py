import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from usagelens.llm import alignment

from .texts import prose

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def vocabularies():
    return alignment.read_vocabularies()


def brute(texts, vocabularies):
    """Token by token with the public tokenizers, byte offsets compared pair by pair."""
    import sentencepiece
    from tokenizers import Tokenizer

    by_bytes = Tokenizer.from_str(vocabularies.by_bytes.decode())
    by_bytes.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.by_pieces)
    letters = alignment.printable_bytes()
    docs = []
    for text in texts:
        a = by_bytes.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in by_bytes.id_to_token(i)) for i in a]
        bytes_b = []
        for i in b:
            p = pieces.id_to_piece(i)
            bytes_b.append(bytes([int(p[3:-1], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
        whole = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append(([], [], [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
        spans_a = list(zip([0, *ends_a], ends_a))
        spans_b = list(zip([0, *ends_b], ends_b))
        links, j = [], 0
        for i, (s, e) in enumerate(spans_a):
            while j and spans_b[j - 1][1] > s:
                j -= 1
            while spans_b[j][1] <= s:
                j += 1
            k = j
            while k < len(spans_b) and spans_b[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        groups = []
        at_a = at_b = 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            to_a, to_b = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        docs.append((a, b, links, ";".join(groups)))
    counts = Counter(link for d in docs for link in d[2])
    most = Counter()
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (
            len(a),
            len(b),
            g.count(";") + 1 if g else 0,
            len(links),
            sum(counts[x] == most[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(g.encode()).hexdigest() if g else "",
        )
        for a, b, links, g in docs
    ]


TEXTS = [
    None,
    "",
    " ",
    "x",
    "Hello world, hello again <|endoftext|> and <s> or </s> <unk>",
    "naïve ﬁancée ▁ ½ Ａ   　",
    "\U0001f600\U0001f468‍\U0001f469 日本語 mixed ab",
    "line\n\n\ttabs   spaces      " * 5,
    "é \x00 \x07 \r\n",
    prose(1, 400),
    prose(1, 400),
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30,
    "".join(random.Random(2).choice("abc ÄΩя1!\n") for _ in range(3000)),
]


def found(spark, texts, vocabularies):
    df = spark.createDataFrame(
        [(k, t, "n", 1) for k, t in enumerate(texts)], "doc_id long, text string, n_a string, pair int"
    ).repartition(3)
    out = alignment.alignments(df, vocabularies, ["doc_id"]).select(COLUMNS).collect()
    return [tuple(r)[1:] for r in sorted(out)]


def test_equals_brute_force(spark, vocabularies):
    assert found(spark, TEXTS, vocabularies) == brute(TEXTS, vocabularies)


def test_bounds_do_not_change_the_result(spark, vocabularies, monkeypatch):
    true = brute(TEXTS, vocabularies)
    monkeypatch.setattr(alignment, "BLOCK", 7)
    monkeypatch.setattr(alignment, "COMMON_PAIRS", 20)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 10)
    assert found(spark, TEXTS, vocabularies) == true


def test_sample_equals_brute_force(spark, vocabularies):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted(tuple(r) for r in docs.collect())
    out = alignment.alignments(docs, vocabularies, ["doc_id"]).select(COLUMNS)
    ours = sorted(tuple(r) for r in out.collect())
    theirs = brute([t for _, t in rows], vocabularies)
    assert ours == [(i, *x) for (i, _), x in zip(rows, theirs)]


def test_products_equal_dense_matrices(monkeypatch):
    rng = np.random.default_rng(5)
    left, right = rng.random((9, 12)) < 0.3, rng.random((12, 7)) < 0.4

    def csr(m):
        return alignment.Csr(np.r_[0, np.cumsum(m.sum(1))], np.nonzero(m)[1], m.shape[1])

    for block in (1, 5, 1000):
        monkeypatch.setattr(alignment, "BLOCK", block)
        out = np.zeros((9, 7), int)
        for rows, columns, values in alignment.product(csr(left), csr(right)):
            np.add.at(out, (rows, columns), values)
        assert (out == left.astype(int) @ right.astype(int)).all()
    back = alignment.transposed(csr(right))
    assert (back.columns == np.nonzero(right.T)[1]).all()


def test_links_and_group_links(spark, vocabularies):
    docs = spark.createDataFrame([(1, "Überraschung naïve"), (2, None)], "doc_id long, text string")
    tokens = alignment.encoded(docs, vocabularies, ["doc_id"])
    rows = alignment.links(tokens, vocabularies, ["doc_id"]).collect()
    total = alignment.alignments(docs, vocabularies, ["doc_id"]).filter("doc_id = 1").first()
    assert sum(r["n_bytes"] > 0 for r in rows) == total["n_links"]
    assert len(rows) == total["n_shared"]
    assert sum(r["n_bytes"] for r in rows) == len(" Überraschung naïve".encode())


def test_hostile_rows(hostile, nothing, vocabularies):
    out = alignment.alignments(hostile, vocabularies, ["doc_id"])
    assert out.count() == hostile.count()
    assert out.filter("n_a = 0 AND (n_links > 0 OR groups_sha256 != '')").count() == 0
    assert alignment.alignments(nothing, vocabularies, ["doc_id"]).collect() == []

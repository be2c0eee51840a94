import math

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from .texts import prose
from usagelens.llm import compression, quality, toxicity

SF, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


@pytest.mark.parametrize("operator, label, modulus, remainder", [(toxicity, "toxic", 4, 2), (quality, "quality", 3, 1)])
def test_held_out_accuracy(spark, operator, label, modulus, remainder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = compression.held_out(F.col("doc_id"), modulus, remainder)
    scored = operator.score(docs, operator.fit(docs, labels, ~held), ["doc_id"])
    assert scored.columns[:2] == ["doc_id", "score"] and scored.count() == docs.count()
    judged = scored.filter(held).join(labels, "doc_id").filter(F.col(label).isNotNull())
    right = judged.filter((F.col("score") >= operator.PREDICT_FROM) == (F.col(label) == 1)).count()
    assert right >= 0.9 * judged.count()


@pytest.mark.parametrize("operator", [toxicity, quality])
def test_hostile_rows(hostile, nothing, label_table, operator):
    model = operator.fit(hostile, label_table, F.lit(True))
    out = operator.score(hostile, model)
    assert [c for c in out.columns if c not in ("score", "savings", "difference")] == [
        c for c in hostile.columns if c != "score"
    ]
    assert out.count() == hostile.count()
    assert out.filter("score IS NULL OR score < 0 OR score > 1 OR isnan(score)").count() == 0
    empty = {r["score"] for r in out.filter("text IS NULL OR text = ''").collect()}
    assert len(empty) == 1
    assert operator.score(nothing, model).collect() == []
    unlearnt = operator.fit(hostile, label_table.filter("false"), F.lit(True))
    assert {round(r["score"], 6) for r in operator.score(hostile, unlearnt).collect()} == {0.5}


def test_stage_keeps_columns(hostile, label_table):
    model = toxicity.fit(hostile, label_table, F.lit(True))
    assert toxicity.accepted(hostile, model, 1.1).count() == hostile.count()
    assert toxicity.accepted(hostile, model, -1.0).count() == 0
    assert toxicity.accepted(hostile, model).columns == hostile.columns


def test_one_planted_word_is_enough(spark):
    rows = []
    for k in range(200):
        words = prose(k, 60).split()
        if k % 4 == 0:
            words.insert(k * 7 % 50, "blatherskite")
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    learn = F.col("doc_id") % 3 != 0
    out = toxicity.score(docs, toxicity.fit(docs, labels, learn), ["doc_id"]).filter("doc_id % 3 = 0").collect()
    wrong = [r for r in out if (r["score"] >= toxicity.PREDICT_FROM) != (r["doc_id"] % 4 == 0)]
    assert len(wrong) <= 0.1 * len(out)


def test_toxic_of_every_language_held_out(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    held = compression.held_out(F.col("doc_id"), 4, 2)
    model = toxicity.fit(docs, labels, ~held)
    judged = docs.filter(held).join(labels.filter("toxic IN (0, 1)"), "doc_id")
    rows = toxicity.score(judged, model, ["lang", "toxic"]).collect()
    found = [(r["lang"], r["toxic"], r["score"] >= toxicity.PREDICT_FROM) for r in rows]
    figures = {}
    for lang in (None, "en", "fr", "de", "es"):
        own = [(y, p) for g, y, p in found if lang in (None, g)]
        hit = sum(y and p for y, p in own)
        figures[lang] = hit, sum(p for _, p in own), sum(y for y, _ in own)
    print("held-out toxic: found, predicted, labelled", figures)
    hit, predicted, labelled = figures[None]
    assert hit >= 0.75 * labelled and hit >= 0.7 * predicted
    assert all(figures[lang][0] >= 0.5 * figures[lang][2] for lang in ("en", "fr", "de", "es"))


def test_a_strong_vocabulary_leaves_weak_word_beginnings(spark):
    rows = []
    for k in range(600):
        words = prose(k, 60).split()
        if k % 4 == 0:
            # A tenth of the toxic documents share only the beginning of a word.
            words.insert(k * 7 % 50, f"zquivox{'abcdefghij'[k // 40 % 10]}" if k % 40 == 0 else "blatherskite")
        rows.append((k, " ".join(words), int(k % 4 == 0)))
    sample = spark.createDataFrame(rows, "d long, text string, y int")
    segments = [segment for segment, _ in toxicity.segment_evidence(sample)]
    assert "blatherskite " in segments and "zquivox" in segments


def test_lengths_do_not_depend_on_the_batch(monkeypatch):
    by = compression.compressor(b"", dict(compression_level=3))
    pieces = [b"abc" * k for k in range(200)]
    whole = compression.lengths(by, pieces)
    monkeypatch.setattr(compression, "SPAN_BYTES", 50)
    assert (compression.lengths(by, pieces) == whole).all() and whole[0] == 0


def test_logistic_fit_of_separable_and_missing_rows():
    x, y = np.arange(10.0)[:, None], (np.arange(10) > 4).astype(float)
    p = compression.logistic(compression.fit_logistic(x, y, np.ones(10)), x)
    assert ((p > 0.5) == (y == 1)).all()
    empty = compression.fit_logistic(np.empty((0, 1)), np.empty(0), np.empty(0))
    assert compression.logistic(empty, x).tolist() == [0.5] * 10


def test_equal_rows_score_the_same_in_batches_of_any_size():
    rng = np.random.default_rng(3)
    for width in (1, 3, 7):
        model = np.abs(rng.standard_normal((3, width + 1))) + 0.1
        row = rng.standard_normal(width)
        scores = {
            float(p) for n in range(1, 65) for p in compression.logistic(model, np.tile(row, (n, 1)))
        }
        assert len(scores) == 1


def frame(dictionary, parameters, raw, piece):
    """Compressed length of one piece, by a compressor of its own."""
    settings = zstandard.ZstdCompressionParameters(
        write_content_size=False, write_checksum=False, write_dict_id=False, **parameters
    )
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    return len(zstandard.ZstdCompressor(compression_params=settings, dict_data=data).compress(piece))


def probability(model, features):
    total = model.calibration[2][-1]
    for k, f in enumerate(features):
        total += (f - model.calibration[0][k]) / model.calibration[1][k] * model.calibration[2][k]
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, total))))


def quality_by_hand(text, model):
    data = (text or "").encode()
    good, bad, size = [], [], []
    for k in range(0, len(data), quality.CHUNK_BYTES):
        piece = data[k : k + quality.CHUNK_BYTES]
        good.append(frame(model.good, quality.PARAMETERS, False, piece))
        bad.append(frame(model.bad, quality.PARAMETERS, False, piece))
        size.append(len(piece) + 8)
    f = [0.0] * quality.FEATURES
    if size:
        d = [(a - b) / n for a, b, n in zip(good, bad, size)]
        f = [
            (sum(good) - sum(bad)) / sum(size), (sum(good) - sum(bad)) / (sum(good) + sum(bad)), sum(good) / sum(size),
            max(d), min(d), min(a / n for a, n in zip(good, size)), math.log(sum(size)),
        ]
    return probability(model, [*f, *(x * x for x in f)])


def toxicity_by_hand(text, model):
    words = (text or "").lower().split()
    saved = []
    for k in range(0, len(words), toxicity.WINDOW_WORDS):
        piece = (" " + " ".join(words[k : k + toxicity.WINDOW_WORDS]) + " ").encode()
        plain = frame(model.background, toxicity.PARAMETERS, True, piece)
        saved.append(plain - frame(model.toxic, toxicity.PARAMETERS, True, piece))
    f = [0.0] * toxicity.FEATURES
    if saved:
        saved.sort()
        n = len(saved)
        shares = [min(most, sum(x >= least for x in saved) / n) for least, most in ((2, 0.5), (3, 0.3), (4, 0.3), (5, 0.3))]
        second = max(-1, min(8, saved[-2])) if n > 1 else 0
        mean = min(1, sum(max(0, min(8, x)) for x in saved) / n)
        f = [max(-1, min(8, saved[-1])), second, min(6, sum(x >= 4 for x in saved)), math.log1p(n), *shares, mean]
    return probability(model, [*f, *(max(0, f[0] - k) for k in (2, 3, 4)), min(0.5, f[-1])])


@pytest.mark.parametrize("operator, label, by_hand", [(toxicity, "toxic", toxicity_by_hand), (quality, "quality", quality_by_hand)])
def test_scores_equal_brute_force(spark, operator, label, by_hand):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = operator.fit(docs, labels, F.lit(True))
    rows = operator.score(docs.filter("doc_id % 5 = 0"), model).collect()
    assert len(rows) > 30
    for row in rows:
        assert abs(row["score"] - by_hand(row["text"], model)) < 1e-9

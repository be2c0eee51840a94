import numpy as np
from pyspark.sql import functions as F

from usagelens.llm import languages


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    out = languages.predict(docs, languages.fit(docs, ~held)).filter(held)
    assert out.filter("lang_pred = lang").count() >= 0.98 * out.count()
    assert out.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_long_texts_count_like_one_span(monkeypatch):
    letter, text = languages.is_letter(), "Ein langer Text, 12 Wörter\n" * 40
    whole = languages.ngram_counts(text, letter)
    monkeypatch.setattr(languages, "SPAN_CHARS", 37)
    assert (languages.ngram_counts(text, letter) == whole).all()


def test_hostile_rows(hostile, nothing):
    model = languages.fit(hostile, F.lit(True))
    out = languages.predict(hostile, model)
    assert out.columns == [*(c for c in hostile.columns if c != "score"), "lang_pred", "score", "rejected"]
    rows = {r["doc_id"]: r for r in out.collect()}
    for empty in (3, 4, 5):
        assert (rows[empty]["lang_pred"], rows[empty]["score"], rows[empty]["rejected"]) == ("und", 0.0, True)
    assert rows[1]["lang_pred"] == "en" and rows[9]["lang_pred"] in ("en", "fr")
    unlearnt = languages.fit(nothing, F.lit(True))
    assert {r["lang_pred"] for r in languages.predict(hostile, unlearnt).collect()} == {"und"}
    assert languages.predict(nothing, model).collect() == []


def test_clusters_of_one_row():
    x = np.eye(languages.DIMENSIONS, dtype=np.float32)[:1]
    centroids, owner = languages.cluster(x, 4, 0)
    assert len(centroids) == 1 and owner.tolist() == [0]


def counted(text):
    """n-gram counts of a text, character by character."""
    letter = languages.is_letter()
    codes = [ord(c) for c in text.lower()]
    known = [c < len(letter) and bool(letter[c]) for c in codes]
    line = [32]
    for k, c in enumerate(codes):
        if known[k]:
            line.append(c)
        elif k == 0 or known[k - 1]:
            line.append(32)
    line.append(32)
    counts = np.zeros(languages.DIMENSIONS)
    for n in languages.NGRAMS:
        for k in range(len(line) - n + 1):
            h = n
            for c in line[k : k + n]:
                h = (h * 0x100000001B3 % 2**64) ^ c
            counts[(h * 0x9E3779B97F4A7C15 % 2**64) >> 52] += 1
    return counts


def test_predictions_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = languages.fit(docs, F.lit(True))
    checked = 0
    for row in languages.predict(docs.filter("doc_id % 7 = 0"), model).collect():
        x = np.log1p(counted(row["text"])) * model.idf
        near = [float(x @ c) / np.sqrt(float(x @ x)) for c in model.centroids.astype(float)]
        best = int(np.argmax(near))
        assert abs(near[best] - row["score"]) < 1e-4
        second = max(n for k, n in enumerate(near) if model.owner[k] != model.owner[best])
        if near[best] - second > 1e-4:
            assert row["lang_pred"] == model.languages[model.owner[best]]
            checked += 1
    assert checked > 10


def test_repeated_ids_do_not_choose_the_sample(spark):
    texts = {"en": "the cat sat on the mat and it was {} of them", "de": "der hund und die katze sind {} im haus"}
    rows = [(5, texts[lang].format(k), lang) for lang in texts for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.fit(docs, F.lit(True), per_language=20)
    assert model.languages == ["de", "en"]
    out = languages.predict(docs, model)
    assert out.filter("lang_pred = lang").count() == 600

"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams, log counts times inverse document
frequency, of length one. Every language has several centroids, found by clustering the
vectors of a bounded sample of its documents. The language of the most similar centroid, by
cosine, is the prediction; a text farther from it than nearly all of the centroid's own
members is flagged as rejected. Document frequencies are counted over all texts learnt from.

Defined cases: a null text, or one without a letter, is ``und`` with score 0 and rejected;
rows with a null text or language are not learnt from; if nothing can be learnt every text
is ``und``; other columns are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import stored

UNKNOWN = "und"
# Hashed features, n-gram lengths, documents of a language that are clustered, clusters.
DIMENSIONS, NGRAMS, PER_LANGUAGE, CLUSTERS = 4096, (1, 2, 3), 1000, 4
# A text is rejected below this share of the cosine that all but this share of the members reach.
REJECT_SHARE, MEMBER_QUANTILE = 0.7, 0.02
# Texts are turned into vectors by so many characters at once.
SPAN_CHARS = 1 << 18
ROWS = 256


@dataclass
class Model:
    languages: list[str]
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray  # index of its language
    reach: np.ndarray  # least cosine that is not rejected
    idf: np.ndarray


def is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def ngram_counts(text: str, letter: np.ndarray) -> np.ndarray | None:
    """Counts of hashed n-grams; None without a letter. Runs of other characters are one space.

    Long texts go in spans that overlap by the longest n-gram less one, so every n-gram
    counts once.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letter[codes]
    if not known.any():
        return None
    codes = np.where(known, codes, 32).astype(np.uint64)
    keep = known | np.r_[True, known[:-1]]
    codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
    counts = np.zeros(DIMENSIONS, np.int64)
    for start in range(0, len(codes), SPAN_CHARS):
        for n in NGRAMS:
            span = codes[start : start + SPAN_CHARS + n - 1]
            m = len(span) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h * np.uint64(0x100000001B3)) ^ span[k : k + m]
            h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
            counts += np.bincount(h.astype(np.int64), minlength=DIMENSIONS)
    return counts


def vectors(texts: pd.Series, letter: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and whether each text has a letter."""
    x = np.zeros((len(texts), DIMENSIONS), np.float32)
    has = np.zeros(len(texts), bool)
    for row, text in enumerate(texts):
        counts = ngram_counts(text, letter) if text else None
        if counts is not None:
            x[row], has[row] = np.log1p(counts) * idf, True
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(size > 0, size, 1), has


def cluster(x: np.ndarray, clusters: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centroids and the owner of each row."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.permutation(len(x))[: min(clusters, len(x))]].copy()
    owner = np.zeros(len(x), int)
    for _ in range(12):
        owner = (x @ centroids.T).argmax(axis=1)
        for k in range(len(centroids)):
            if (owner == k).any():
                centroids[k] = x[owner == k].sum(axis=0)
        centroids /= np.sqrt((centroids**2).sum(axis=1, keepdims=True)) + 1e-12
    return centroids, (x @ centroids.T).argmax(axis=1)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, over all of them, and how many there are.

    A task adds up its texts; ``DIMENSIONS`` sums reach the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letter = is_letter()
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.text:
                counts = ngram_counts(text, letter)
                if counts is not None:
                    seen += counts > 0
                    n += 1
        yield pd.DataFrame({"k": np.arange(-1, DIMENSIONS), "n": np.r_[n, seen]})

    sums = texts.select("text").mapInPandas(count, "k int, n long").groupBy("k").agg(F.sum("n").alias("n"))
    out = np.zeros(DIMENSIONS + 1, np.int64)
    for row in sums.collect():
        out[row["k"] + 1] = row["n"]
    return out[1:], int(out[0])


def fit(documents: DataFrame, learn: Column, per_language: int = PER_LANGUAGE, clusters: int = CLUSTERS) -> Model:
    """Centroids from the rows that ``learn`` admits and that have a text and a language.

    At most ``per_language`` documents of a language, in the order of a hash of their id and
    text, are clustered, each language in a task of its own. One count per language reaches the
    driver.
    """
    known = documents.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        "text", "lang"
    )
    frequency, n = document_frequencies(known)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    # A hash thins every language out before its first rows are ranked, so little text is
    # shuffled whatever the size of the corpus. Ids can repeat, so the text is hashed as well.
    counts = documents.filter(learn & F.col("lang").isNotNull()).groupBy("lang").count().collect()
    share = F.lit(0.0)
    for row in counts:
        share = F.when(
            F.col("lang") == row["lang"], F.lit(min(1.0, 1.5 * per_language / row["count"]))
        ).otherwise(share)
    place = F.xxhash64("doc_id", "text", F.lit("languages"))
    thin = F.pmod(place, F.lit(1_000_000)) < share * 1_000_000
    order = Window.partitionBy("lang").orderBy(place, "text")
    sample = stored(
        documents.filter(learn & F.col("text").isNotNull() & F.col("lang").isNotNull() & thin)
        .withColumn("n", F.row_number().over(order))
        .filter(F.col("n") <= per_language)
        .select("text", "lang"),
        "language-sample",
    )

    def centre(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x, has = vectors(rows.text, is_letter(), idf)
        x = x[has]
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        centroids, owner = cluster(x, clusters, zlib.crc32(key[0].encode()))
        near = (x * centroids[owner]).sum(axis=1)
        reach = [
            np.quantile(near[owner == k], MEMBER_QUANTILE) if (owner == k).any() else 1.0
            for k in range(len(centroids))
        ]
        return pd.DataFrame(
            {"lang": [key[0]] * len(centroids), "centroid": [c.tolist() for c in centroids], "reach": reach}
        )

    found = (
        sample.groupBy("lang")
        .applyInPandas(centre, "lang string, centroid array<float>, reach double")
        .orderBy("lang")
        .collect()
    )
    languages = sorted({row["lang"] for row in found})
    return Model(
        languages,
        np.array([row["centroid"] for row in found], np.float32).reshape(-1, DIMENSIONS),
        np.array([languages.index(row["lang"]) for row in found], int),
        REJECT_SHARE * np.array([row["reach"] for row in found]),
        idf,
    )


def predict(documents: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``documents``, or its columns ``keep``, with lang_pred, score (cosine of the best centroid) and rejected."""
    names = ("lang_pred", "score", "rejected")
    rest = [c for c in keep or documents.columns if c not in names]
    kinds = documents.select(*rest).schema
    kinds = kinds.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        letter = is_letter()
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                rows = batch.iloc[at : at + ROWS].copy()
                x, has = vectors(rows.text, letter, model.idf)
                has &= len(model.languages) > 0
                near = x @ model.centroids.T if len(model.languages) else np.zeros((len(rows), 1))
                best = near.argmax(axis=1)
                value = np.clip(near[np.arange(len(rows)), best].astype(float), 0, 1)
                rows["lang_pred"] = [
                    model.languages[model.owner[b]] if ok else UNKNOWN
                    for b, ok in zip(best, has, strict=True)
                ]
                rows["score"] = np.where(has, value, 0.0)
                rows["rejected"] = (
                    ~has | (value < model.reach[best]) if len(model.languages) else np.ones(len(rows), bool)
                )
                yield rows[[*rest, *names]]

    return documents.select(*dict.fromkeys([*rest, "text"])).mapInPandas(judge, kinds)

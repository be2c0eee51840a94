"""Toxicity by compression distance.

Two zstandard dictionaries share a background trained on ordinary text; the toxic one also
holds the segments of toxic text that ordinary text lacks. A window of a document is
compressed with both. How many bytes the toxic dictionary saves is the distance; the largest
savings of a document go through thresholds calibrated on labelled documents.

A segment is a word, or the beginning of words, that toxic documents use far more often than
ordinary ones. Each is judged by its own evidence, whatever the best one has: a vocabulary of
few documents, as of a rarer language, stays beside a strong one. Among the segments taken
about one in ten may be there by chance, by the number of words and beginnings tried.
Documents are counted by the contexts (word before, word, word after) they are the first to
use, so that a group of copies counts as one document.

Defined cases: a null, empty or blank text has no windows and gets the score of no savings;
labels other than 0 and 1 and labels without a document are not learnt from; of several
labels of a document the largest holds; without labelled documents of both classes every
score is the share of toxic labels, or 1/2 without any; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import erfc, sqrt

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm import compression
from usagelens.llm.common import ROW, small_batches, stored, with_rows, without

# Labelled documents of a class that are learnt from, and ordinary windows the background is
# trained on.
PER_CLASS, BACKGROUND_WINDOWS = 4000, 20000
WINDOW_WORDS = 12
BACKGROUND_BYTES = 16384
# Characters of a word's beginning. The whole word counts at any length.
BEGINNING = 3, 24
# Least evidence of a segment, share of segments that may be there by chance, and bytes of
# segments, so that they and the background stay within reach of the window.
EVIDENCE_LEAST, BY_CHANCE, SEGMENT_BYTES = 12.0, 0.1, 65536
PARAMETERS = dict(
    hash_log=16,
    chain_log=17,
    window_log=17,
    search_log=6,
    min_match=4,
    target_length=32,
    strategy=zstandard.STRATEGY_BTLAZY2,
)
FEATURES = 9
PREDICT_FROM = 0.3


@dataclass
class Model:
    background: bytes
    toxic: bytes
    calibration: np.ndarray


def windows(text: str) -> list[bytes]:
    """A text's consecutive windows of words, lower-cased, with a space on both sides."""
    words = text.lower().split()
    return [
        (" " + " ".join(words[k : k + WINDOW_WORDS]) + " ").encode("utf-8", "surrogatepass")
        for k in range(0, len(words), WINDOW_WORDS)
    ]


def savings(texts: pd.Series, model: Model) -> np.ndarray:
    """Per text: the largest and second largest saving, how many windows save, windows, the
    shares of windows that save 2, 3, 4 and 5 bytes, and the mean saving."""
    plain = compression.compressor(model.background, PARAMETERS, raw=True)
    toxic = compression.compressor(model.toxic, PARAMETERS, raw=True)
    out = np.zeros((len(texts), FEATURES))
    for row, text in enumerate(texts):
        pieces = windows(text) if text is not None else []
        if not pieces:
            continue
        saved = np.sort(compression.lengths(plain, pieces) - compression.lengths(toxic, pieces))
        out[row] = (
            np.clip(saved[-1], -1, 8),
            np.clip(saved[-2], -1, 8) if len(saved) > 1 else 0,
            min(6, (saved >= 4).sum()),
            np.log1p(len(saved)),
            *(min(most, (saved >= least).mean()) for least, most in ((2, 0.5), (3, 0.3), (4, 0.3), (5, 0.3))),
            min(1, np.clip(saved, 0, 8).mean()),
        )
    return out


def curved(features: np.ndarray) -> np.ndarray:
    top = features[:, 0]
    mean = np.minimum(0.5, features[:, -1])
    return np.c_[features, np.maximum(0, top - 2), np.maximum(0, top - 3), np.maximum(0, top - 4), mean]


def segment_evidence(sample: DataFrame) -> list[tuple[str, float]]:
    """Words, each with a space at its end, and beginnings of words that mark toxic text, with
    the likelihood ratio of their document counts, the best first."""
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = sample.select(
        "y", F.xxhash64("text").alias("d"), F.concat(F.array(F.lit("")), words, F.array(F.lit(""))).alias("w")
    )
    contexts = padded.select("y", "d", "w", F.posexplode("w").alias("k", "word")).filter("word != ''")
    first = contexts.groupBy(
        "y", F.xxhash64(F.expr("w[k - 1]"), "word", F.expr("w[k + 1]")).alias("context"), "word"
    ).agg(F.min("d").alias("d"))
    sizes = {r["y"]: r["n"] for r in padded.groupBy("y").agg(F.countDistinct("d").alias("n")).collect()}
    if len(sizes) < 2:
        return []
    total = F.lit(float(sizes[0] + sizes[1]))
    least, most = BEGINNING
    ends = F.sequence(F.lit(least), F.least(F.char_length("word"), F.lit(most)))
    beginnings = F.when(
        F.char_length("word") >= least, F.transform(ends, lambda k: F.substring("word", F.lit(1), k))
    ).otherwise(F.array().cast("array<string>"))
    counted = (
        first.select("y", "d", "word")
        .distinct()
        .select(
            "y", "d", F.explode(F.concat(F.array(F.concat("word", F.lit(" "))), beginnings)).alias("segment")
        )
        .distinct()
        .groupBy("segment")
        .agg(*(F.count_if(F.col("y") == y).alias(f"n{y}") for y in (0, 1)))
    )
    # One document is no evidence.
    tried = stored(counted.filter("n1 > 1"), "toxicity-segments")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    share = (F.col("n0") + F.col("n1")) / total
    evidence = 2 * sum(
        (
            part(F.col(f"n{y}").cast("double"), sizes[y] * share)
            + part(sizes[y] - F.col(f"n{y}").cast("double"), sizes[y] * (1 - share))
            for y in (0, 1)
        ),
        start=F.lit(0.0),
    )
    often = F.col("n1") / sizes[1] > 5 * F.col("n0") / sizes[0]
    marking = tried.filter(often).select("segment", "n0", "n1", evidence.alias("evidence"))
    best = (
        marking.filter(F.col("evidence") >= EVIDENCE_LEAST)
        .orderBy(F.col("evidence").desc(), "segment")
        .limit(SEGMENT_BYTES)
        .collect()
    )
    return longest([tuple(row) for row in best[: above_chance([r["evidence"] for r in best], tried.count())]])


def above_chance(evidence: list[float], tried: int) -> int:
    """How many of the best of ``tried`` segments to take, so that the expected share of those
    there by chance is at most ``BY_CHANCE`` (Benjamini and Hochberg)."""
    return max(
        (k for k, e in enumerate(evidence, 1) if erfc(sqrt(e / 2)) / 2 * tried <= BY_CHANCE * k), default=0
    )


def longest(segments: list[tuple[str, int, int, float]]) -> list[tuple[str, float]]:
    """Segments and their evidence without those that a longer one with the same documents begins with."""
    counts = {segment: (n0, n1) for segment, n0, n1, _ in segments}
    spare = {
        segment[:k]
        for segment in counts
        for k in range(1, len(segment))
        if counts.get(segment[:k]) == counts[segment]
    }
    return [(segment, e) for segment, _, _, e in segments if segment not in spare]


def dictionary(segments: list[str]) -> bytes:
    """At most ``SEGMENT_BYTES`` of the first ``segments``, the first nearest to the end. Each
    has a space before it; the line ends between them match nothing in a window."""
    out, size = [], 0
    for segment in segments:
        piece = f" {segment}\n".encode("utf-8", "surrogatepass")
        size += len(piece)
        if size > SEGMENT_BYTES:
            break
        out.append(piece)
    return b"".join(reversed(out))


def fit(
    documents: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", per_class: int = PER_CLASS
) -> Model:
    """Dictionaries and calibration from the labelled documents that ``learn`` admits."""
    sample, totals = compression.labelled_sample(
        documents, labels, label, learn, per_class, "toxicity-sample"
    )
    segments = [segment for segment, _ in segment_evidence(sample)]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch.text:
                yield pd.DataFrame({"piece": windows(text)})

    pieces = (
        sample.filter("y = 0")
        .select("text")
        .mapInPandas(cut, "piece binary")
        .orderBy(F.xxhash64("piece"), "piece")
        .limit(BACKGROUND_WINDOWS)
        .collect()
    )
    background = compression.train([bytes(row["piece"]) for row in pieces], BACKGROUND_BYTES)
    model = Model(background, dictionary(segments) + background, np.zeros((3, 1)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"y": batch.y, **{f"f{k}": c for k, c in enumerate(savings(batch.text, model).T)}}
            )

    columns = ", ".join(f"f{k} double" for k in range(FEATURES))
    rows = np.array(
        [tuple(r) for r in sample.mapInPandas(measure, f"y int, {columns}").collect()], float
    ).reshape(-1, FEATURES + 1)
    y = rows[:, 0]
    model.calibration = compression.fit_logistic(
        curved(rows[:, 1:]), y, compression.class_weights(y, totals)
    )
    return model


def score(documents: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``documents``, or its columns ``keep``, with ``score`` (0 to 1) and ``savings``, the
    largest saving in bytes.

    One pass over the texts without a shuffle.
    """
    rest = [c for c in keep or documents.columns if c not in ("score", "savings")]
    kinds = documents.select(*rest).schema.add("score", "double").add("savings", "double")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            features = savings(batch.text, model)
            scores = compression.logistic(model.calibration, curved(features))
            yield batch[rest].assign(score=scores, savings=features[:, 0])

    return documents.select(*dict.fromkeys([*rest, "text"])).mapInPandas(judge, kinds)


def accepted(documents: DataFrame, model: Model, reject_from: float = PREDICT_FROM) -> DataFrame:
    """The documents that score below ``reject_from``, with all their columns.

    The rejected rows are the small side of the join.
    """
    rows = with_rows(documents, "toxic-rows")
    scored = score(rows.select("text", *ROW), model, ROW)
    with small_batches(documents.sparkSession):
        rejected = stored(scored.filter(F.col("score") >= reject_from).select(*ROW), "toxic-dropped")
    return without(rows, rejected, documents.columns)

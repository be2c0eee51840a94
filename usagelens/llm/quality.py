"""Quality by compression: dictionaries of good and of bad text.

A document's chunks are compressed with a dictionary trained on good text and one trained
on bad text. The difference of the two lengths, by chunk length, over the document and at
its extremes, goes through a logistic calibration on labelled documents.

Defined cases: a null or empty text is scored as a text without chunks; labels other than 0
and 1 and labels without a document are not learnt from; of several labels of a document the
largest holds; without labelled documents of both classes every score is near the share of
good labels, or 1/2 without any; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm import compression

# Labelled documents of a class that are learnt from, and their chunks a dictionary is
# trained on.
PER_CLASS, TRAINED_CHUNKS = 4000, 12000
CHUNK_BYTES = 500
DICTIONARY_BYTES = 32768
PARAMETERS = dict(compression_level=3)
FEATURES = 7
PREDICT_FROM = 0.5


@dataclass
class Model:
    good: bytes
    bad: bytes
    calibration: np.ndarray


def chunks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[k : k + CHUNK_BYTES] for k in range(0, len(data), CHUNK_BYTES)]


def differences(texts: pd.Series, model: Model) -> np.ndarray:
    """Per text: difference by length and by sum, length with the good dictionary, the
    extreme differences and the smallest length of a chunk, log bytes."""
    good = compression.compressor(model.good, PARAMETERS)
    bad = compression.compressor(model.bad, PARAMETERS)
    out = np.zeros((len(texts), FEATURES))
    for row, text in enumerate(texts):
        pieces = chunks(text) if text is not None else []
        if not pieces:
            continue
        size = np.array([len(p) for p in pieces]) + 8.0
        a, b = compression.lengths(good, pieces), compression.lengths(bad, pieces)
        d = (a - b) / size
        out[row] = (
            (a - b).sum() / size.sum(),
            (a - b).sum() / (a + b).sum(),
            a.sum() / size.sum(),
            d.max(),
            d.min(),
            (a / size).min(),
            np.log(size.sum()),
        )
    return out


def curved(features: np.ndarray) -> np.ndarray:
    return np.c_[features, features**2]


def fit(
    documents: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", per_class: int = PER_CLASS
) -> Model:
    """Dictionaries and calibration from the labelled documents that ``learn`` admits."""
    sample, totals = compression.labelled_sample(
        documents, labels, label, learn, per_class, "quality-sample"
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch.text:
                yield pd.DataFrame({"piece": chunks(text)})

    def trained(y: int) -> bytes:
        pieces = (
            sample.filter(F.col("y") == y)
            .select("text")
            .mapInPandas(cut, "piece binary")
            .orderBy(F.xxhash64("piece"), "piece")
            .limit(TRAINED_CHUNKS)
            .collect()
        )
        return compression.train([bytes(row["piece"]) for row in pieces], DICTIONARY_BYTES)

    model = Model(trained(1), trained(0), np.zeros((3, 1)))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                {"y": batch.y, **{f"f{k}": c for k, c in enumerate(differences(batch.text, model).T)}}
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
    """``documents``, or its columns ``keep``, with ``score`` (0 to 1) and ``difference``, bytes saved per byte by the
    bad dictionary. One pass over the texts without a shuffle."""
    rest = [c for c in keep or documents.columns if c not in ("score", "difference")]
    kinds = documents.select(*rest).schema.add("score", "double").add("difference", "double")

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            features = differences(batch.text, model)
            scores = compression.logistic(model.calibration, curved(features))
            yield batch[rest].assign(score=scores, difference=features[:, 0])

    return documents.select(*dict.fromkeys([*rest, "text"])).mapInPandas(judge, kinds)

"""Classification by compression: dictionaries, compressed lengths, calibration.

Shared by the toxicity and quality operators. Everything here works on one task's pieces of
text or on a bounded sample; Spark spreads the pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import stored

# Longer pieces are compressed in spans of this many bytes and their lengths added.
SPAN_BYTES = 1 << 20


def train(samples: Sequence[bytes], size: int) -> bytes:
    """A dictionary of at most ``size`` bytes; too few samples for the trainer are used as they are."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[-size:]


def compressor(
    dictionary: bytes, parameters: dict, raw: bool = False
) -> zstandard.ZstdCompressor:
    """Frames carry no size, checksum or dictionary id, so lengths differ by content only."""
    settings = zstandard.ZstdCompressionParameters(
        write_content_size=False, write_checksum=False, write_dict_id=False, **parameters
    )
    if not dictionary:
        return zstandard.ZstdCompressor(compression_params=settings)
    kind = zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO
    data = zstandard.ZstdCompressionDict(dictionary, dict_type=kind)
    data.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(compression_params=settings, dict_data=data)


def decompressor(dictionary: bytes) -> Callable[[bytes, int], bytes]:
    """Undoes ``compressor``; takes a frame and the most bytes it can hold."""
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    by = zstandard.ZstdDecompressor(dict_data=data)
    return lambda frame, most: by.decompress(frame, max_output_size=most)


def lengths(by: zstandard.ZstdCompressor, pieces: Sequence[bytes]) -> np.ndarray:
    """Compressed length of every piece; an empty piece has length 0."""
    out = np.zeros(len(pieces), np.int64)
    full = [k for k, piece in enumerate(pieces) if piece]
    at = 0
    while at < len(full):
        end, total = at, 0
        while end < len(full) and (end == at or total + len(pieces[full[end]]) <= SPAN_BYTES):
            total += len(pieces[full[end]])
            end += 1
        chosen = full[at:end]
        size = np.array([len(pieces[k]) for k in chosen], np.uint64)
        start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.uint64)
        packed = zstandard.BufferWithSegments(
            b"".join(pieces[k] for k in chosen), np.stack([start, size], axis=1).tobytes()
        )
        done = by.multi_compress_to_buffer(packed, threads=1)
        out[chosen] = [len(done[k]) for k in range(len(chosen))]
        at = end
    return out


def fit_logistic(
    features: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-3, steps: int = 60
) -> np.ndarray:
    """Rows (mean, scale, coefficient) of a ridge logistic regression, the intercept last.

    One class only gives a constant score near that class, no rows at all give 1/2.
    """
    width = features.shape[1]
    if not len(labels):
        return np.stack([np.zeros(width + 1), np.ones(width + 1), np.zeros(width + 1)])
    weights = weights / weights.sum() * len(labels)
    mean = np.average(features, axis=0, weights=weights)
    scale = np.sqrt(np.average((features - mean) ** 2, axis=0, weights=weights)) + 1e-9
    x = np.c_[(features - mean) / scale, np.ones(len(labels))]
    penalty = np.r_[np.full(width, ridge * len(labels)), 1e-2]
    b = np.zeros(width + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + penalty * b
        curve = (x * (weights * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(curve, slope)
        b -= step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return np.stack([np.r_[mean, 0.0], np.r_[scale, 1.0], b])


def logistic(model: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Probability of every row. Terms are added column by column: a matrix product may add
    them in another order for another number of rows, and equal rows must score the same."""
    total = np.full(len(features), model[2, -1])
    for k in range(features.shape[1]):
        total = total + (features[:, k] - model[0, k]) / model[1, k] * model[2, k]
    return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text falls on ``remainder``; an id that is null does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == remainder, F.lit(False))


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int, name: str
) -> tuple[DataFrame, dict[int, int]]:
    """Stored (text, y) of at most ``per_class`` labelled documents of each class, and how many
    labelled documents there are of each.

    Documents are taken in the order of a hash of their id. At most ``2 * per_class`` ids are
    broadcast, so the texts are not shuffled.
    """
    known = (
        labels.filter(F.col(label).isin(0, 1) & learn)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    totals = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    # The hash thins a class out before its first rows are ranked.
    place = F.xxhash64("doc_id", F.lit(label))
    share = F.lit(0.0)
    for y, n in totals.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, 1.2 * per_class / n))).otherwise(share)
    thin = known.filter(F.pmod(place, F.lit(1_000_000)) < share * 1_000_000)
    order = Window.partitionBy("y").orderBy(place)
    chosen = thin.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_class)
    sample = documents.filter("text IS NOT NULL").join(
        F.broadcast(chosen.select("doc_id", "y")), "doc_id"
    )
    return stored(sample.select("text", "y"), name), totals


def class_weights(y: np.ndarray, totals: dict[int, int]) -> np.ndarray:
    """Weights that give a sample the class shares of all labelled documents."""
    counts = {k: max(1, int((y == k).sum())) for k in (0, 1)}
    return np.array([totals.get(int(k), 1) / counts[int(k)] for k in y], float)

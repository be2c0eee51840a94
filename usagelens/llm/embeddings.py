"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine
verification, distributed connected components.

Only vectors with equal labels are compared. Each table cuts the vectors of a label by the
signs of a few random projections; vectors that share a bucket are verified exactly, in
double precision, in blocks. A pair is counted in the first table where both agree, so no
pair needs to leave its task: tasks report, per vector, how many links it has and one edge
to the smallest vector it hangs together with.

Equal vectors are compared once, with their number as weight. The number of sign bits
follows the size of the largest label so that buckets keep their size, and the number of
tables follows the bits so that a pair at the threshold is missed with probability
``MISS`` at most.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component,
or whose label is null, links with nothing and is a component of its own; vectors of
different lengths never link; rows that repeat a vector are vectors of their own and link
with each other; a null vec_id takes part in links but never names a component and is not
kept; an empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from usagelens.llm.common import checked, components, stored

THRESHOLD = 0.93
# Chance at most to miss a pair that is exactly at the threshold.
MISS = 1e-6
# Expected vectors in a bucket, and rows of a block of one.
BUCKET_ROWS, BLOCK_ROWS = 512, 2048
SEED = 20


def plan_tables(largest: int, threshold: float, miss: float) -> tuple[int, int]:
    """(bits, tables) for a label of ``largest`` vectors."""
    bits = max(2, math.ceil(math.log2(max(1, largest) / BUCKET_ROWS))) if largest else 2
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-agree)))


def sign_hashes(vectors: np.ndarray, bits: int, tables: int, seed: int) -> np.ndarray:
    """(rows, tables) of uint32: the signs of ``bits`` projections for each table."""
    planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], tables * bits))
    signs = (vectors @ planes > 0).reshape(len(vectors), tables, bits)
    return (signs * (1 << np.arange(bits, dtype=np.uint32))).sum(axis=2, dtype=np.uint32)


def block_links(
    rows: pd.DataFrame, table: int, first: int, second: int, threshold: float
) -> pd.DataFrame:
    """Links of one block pair of one bucket that no earlier table has."""
    left, right = rows[rows.block == first], rows[rows.block == second]
    own = first == second
    prepared = []
    for side in (left, right):
        x = np.stack(side.embedding.to_numpy()).astype(np.float64) if len(side) else np.empty((0, 1))
        x = x / np.sqrt((x * x).sum(axis=1, keepdims=True)) if len(side) else x
        hashes = [np.frombuffer(h, dtype=np.uint32) for h in side.hashes]
        prepared.append((x, np.stack(hashes) if hashes else np.empty((0, 1), np.uint32)))
    (a, ha), (b, hb) = prepared
    found = []
    if len(left) and len(right):
        for at in range(0, len(a), 512):
            i, j = np.nonzero(a[at : at + 512] @ b.T >= threshold)
            i += at
            keep = i < j if own else np.ones(len(i), bool)
            if table:
                keep[keep] = ~(ha[i[keep], :table] == hb[j[keep], :table]).any(axis=1)
            found.append(np.stack([i[keep], j[keep] + (0 if own else len(a))]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    sides = left if own else pd.concat([left, right])
    node, weight = sides.node.to_numpy(), sides.weight.to_numpy()
    links = np.zeros(len(node), np.int64)
    np.add.at(links, pairs[0], weight[pairs[1]])
    np.add.at(links, pairs[1], weight[pairs[0]])
    root = node.copy()
    while True:
        low = np.minimum(root[pairs[0]], root[pairs[1]])
        after = root.copy()
        np.minimum.at(after, pairs[0], low)
        np.minimum.at(after, pairs[1], low)
        if (after == root).all():
            break
        root = after
    linked = links > 0
    return pd.DataFrame({"node": node[linked], "links": links[linked], "root": root[linked]})


def near_vectors(
    embeddings: DataFrame, threshold: float = THRESHOLD, miss: float = MISS, seed: int = SEED
) -> DataFrame:
    """One row per vector: (vec_id, n_links, component_id, kept)."""
    size = F.size("embedding")
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    nonzero = F.exists("embedding", lambda v: v != 0)
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & (size > 0) & finite & nonzero
    same = F.struct(
        F.xxhash64("label", "embedding").alias("h1"), F.xxhash64("embedding", "label").alias("h2")
    )
    rows = embeddings.select(
        "vec_id", "label", "embedding", F.when(F.coalesce(usable, F.lit(False)), same).alias("same")
    )
    unique = stored(
        rows.filter("same IS NOT NULL")
        .groupBy("same")
        .agg(
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
            F.count(F.lit(1)).alias("weight"),
            F.min("vec_id").alias("smallest"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    dims = F.size("embedding")
    largest = unique.groupBy("label", dims).count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan_tables(largest, threshold, miss)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.empty(len(batch), object)
            lengths = batch.embedding.map(len)
            for length in lengths.unique():
                at = np.flatnonzero(lengths == length)
                x = np.stack(batch.embedding.to_numpy()[at]).astype(np.float64)
                for k, h in zip(at, sign_hashes(x, bits, tables, seed), strict=True):
                    out[k] = h.tobytes()
            yield batch.assign(hashes=out)

    vectors = unique.select("node", "label", "weight", "embedding")
    kinds = StructType(list(vectors.schema.fields)).add("hashes", "binary")
    signed = stored(vectors.mapInPandas(hashed, kinds), "vector-hashes")
    width = 4
    buckets = signed.select(
        "*",
        F.explode(F.sequence(F.lit(0), F.lit(tables - 1))).alias("table"),
    ).withColumn("bucket", F.expr(f"hex(substring(hashes, table * {width} + 1, {width}))"))
    key = ["table", "label", "dims", "bucket"]
    buckets = buckets.withColumn("dims", dims)
    counts = stored(
        buckets.groupBy(key).count().filter("count > 1").withColumn(
            "blocks", F.ceil(F.col("count") / BLOCK_ROWS).cast("int")
        ),
        "vector-buckets",
    )
    placed = (
        buckets.join(checked(counts, 60), key)
        .withColumn("block", (F.pmod(F.xxhash64("node"), F.col("blocks"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .select(*key, "first", "second", "block", "node", "weight", "embedding", "hashes")
    )

    def verify(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table, first, second = group[0], group[4], group[5]
        return block_links(rows, int(table), int(first), int(second), threshold)

    links = stored(
        placed.groupBy(*key, "first", "second").applyInPandas(
            verify, "node long, links long, root long"
        ),
        "vector-links",
    )
    per_node = links.groupBy("node").agg(F.sum("links").alias("links"))
    member = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    smallest = unique.select("node", "smallest")
    named = (
        member.join(smallest, "node")
        .groupBy("component")
        .agg(F.min("smallest").alias("component_id"))
    )
    of_node = (
        unique.select("same", "node", "weight", "smallest")
        .join(per_node, "node", "left")
        .join(member.join(named, "component").select("node", "component_id"), "node", "left")
        .select(
            "same",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "smallest").alias("component_id"),
        )
    )
    return (
        rows.select("vec_id", "same")
        .join(of_node, "same", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )

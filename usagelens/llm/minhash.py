"""Near-dedup by order MinHash, sensitive to edit similarity.

A document is the sequence of its five-word shingles, each labelled with its occurrence
number. For each table the ``PER_KEY`` shingles with the smallest hashes are taken and
written down in the order of the text; documents with equal keys are candidates. A bit
sketch drops candidates that are far from the threshold, and a banded alignment of the two
shingle sequences, bit-parallel, decides: with L shingles aligned in order, the similarity
is L / (n_a + n_b - L), which is the Jaccard similarity of the shingles if their order is
kept. Pairs at ``THRESHOLD`` or more are linked; classes are the connected components.

Documents of equal words are one node from the start. No bucket is spelled out into pairs:
first every node meets one pivot per bucket, then only nodes of a bucket whose components
are still different meet each other.

Words are lower-cased runs of ASCII letters and digits and of all characters beyond ASCII.

Defined cases: a document of one to four words is a single shingle, so it is near only to
documents of equal words; a null text, or one without words, is a class of its own; rows
that repeat a doc_id are documents of their own; the class id is the smallest doc_id of the
class, null if it has none, and the kept row is the one with it, the first of several; an
empty table gives no rows; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from usagelens.llm.common import (
    ROW,
    checked,
    components,
    numbered,
    rows_of,
    small_batches,
    stored,
    temporary,
    with_rows,
    without,
)

SHINGLE, THRESHOLD = 5, 0.8
# A pair at the threshold shares a key of one table with probability 0.8 ** PER_KEY, so all
# tables miss it with probability 4e-5.
PER_KEY, TABLES, FIRST_TABLES = 3, 14, 3
# A coarse sketch of one bit for each of 256 bins, and a fine one of five bits for each of 512.
SKETCH_BITS, FINE_BINS, FINE_SPREADS = 256, 512, 3.5
# Shingles a verifying task keeps for the next pairs.
KEPT_SHINGLES = 4_000_000
SEED = 3
EDGE_SCHEMA = "a long, b long"


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)


class Shingler:
    """Hashes of a text's shingles, vectorised over its bytes."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        self.word = np.zeros(256, bool)
        self.word[0x30:0x3A] = self.word[0x61:0x7B] = self.word[0x80:] = True
        self.grow(1 << 12)
        rng = np.random.default_rng(SEED)
        odd = rng.integers(1, 2**63, TABLES, dtype=np.uint64) | np.uint64(1)
        self.factor, self.flip = odd, rng.integers(1, 2**63, TABLES, dtype=np.uint64)

    def grow(self, size: int) -> None:
        inverse = pow(self.BASE, -1, 1 << 64)
        self.power = np.cumprod(np.full(size, self.BASE, np.uint64))
        self.back = np.cumprod(np.full(size, inverse, np.uint64))

    def shingles(self, text: str | None) -> np.ndarray:
        """One hash per shingle in text order; empty without words."""
        data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) > len(self.power):
            self.grow(2 * len(data))
        edge = np.diff(np.concatenate([[0], self.word[data], [0]]).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            return np.empty(0, np.uint64)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.power[: len(data)], out=total[1:])
        words = mix((total[end] - total[start]) * self.back[start])
        n = max(1, len(words) - SHINGLE + 1)
        out = np.full(n, len(words) if len(words) < SHINGLE else SHINGLE, np.uint64)
        for k in range(min(SHINGLE, len(words))):
            out = mix(out + words[k : k + n] * np.uint64(2 * k + 3))
        return out

    @staticmethod
    def labelled(shingles: np.ndarray) -> np.ndarray:
        """Every shingle with its occurrence number hashed in, so that none repeats."""
        order = np.argsort(shingles, kind="stable")
        ranked = shingles[order]
        new = np.r_[True, ranked[1:] != ranked[:-1]]
        if new.all():
            return shingles
        at = np.arange(len(ranked))
        number = np.empty(len(ranked), np.uint64)
        number[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        return np.where(number > 0, mix(shingles + number * np.uint64(0x9E3779B97F4A7C15)), shingles)

    def keys(self, labelled: np.ndarray) -> list[int]:
        """One order MinHash key per table, as signed longs."""
        out = np.empty(TABLES, np.uint64)
        for t in range(TABLES):
            value = (labelled ^ self.flip[t]) * self.factor[t]
            least = (
                np.argpartition(value, PER_KEY - 1)[:PER_KEY]
                if len(value) > PER_KEY
                else np.arange(len(value))
            )
            key = np.full(1, t, np.uint64)
            for position in np.sort(least):
                key = mix(key + labelled[position])
            out[t] = key[0]
        return out.astype(np.int64).tolist()

    @staticmethod
    def sketch(labelled: np.ndarray) -> list[int]:
        """One bit of the smallest hash in each of 256 bins; an empty bin takes the next one's."""
        ranked = np.sort(mix(labelled ^ np.uint64(0x5851F42D4C957F2D)))
        bins = (ranked >> np.uint64(56)).astype(np.int64)
        first = np.r_[True, bins[1:] != bins[:-1]]
        full, value = bins[first], ranked[first]
        nearest = np.searchsorted(full, np.arange(SKETCH_BITS)) % len(full)
        distance = (full[nearest] - np.arange(SKETCH_BITS)) % SKETCH_BITS
        bits = mix(value[nearest] + distance.astype(np.uint64)) & np.uint64(1)
        return np.packbits(bits.astype(np.uint8)).view(np.int64).tolist()


    @staticmethod
    def fine_sketch(labelled: np.ndarray) -> list[int]:
        """Four bits of the smallest hash in each of 512 bins and whether there is one: five
        planes of 8 longs."""
        ranked = np.sort(mix(labelled ^ np.uint64(0x2545F4914F6CDD1D)))
        bins = (ranked >> np.uint64(55)).astype(np.int64)
        first = np.r_[True, bins[1:] != bins[:-1]]
        value = np.zeros(FINE_BINS, np.uint8)
        value[bins[first]] = (mix(ranked[first]) & np.uint64(15)).astype(np.uint8) | np.uint8(16)
        planes = [np.packbits((value >> k) & 1).view(np.int64) for k in range(5)]
        return np.concatenate(planes).tolist()


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two shingle sequences, or 0 below ``threshold``.

    The longest common subsequence by a bit vector over ``b``. An alignment good enough
    leaves at most ``band`` shingles unmatched, so matches farther off the diagonal than that
    are not looked at.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 0.0
    needed = math.ceil(threshold * total / (1 + threshold) - 1e-9)
    band = total - 2 * needed
    short = min(len(a), len(b))
    if band < 0 or needed > short:
        return 0.0
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[len(a) - rest :][::-1] != b[len(b) - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    left, right = a[head : len(a) - tail].tolist(), b[head : len(b) - tail].tolist()
    matched = head + tail
    if left and right:
        wanted, where = set(left), {}
        for j, value in enumerate(right):
            if value in wanted:
                where[value] = where.get(value, 0) | (1 << j)
        ones = (1 << len(right)) - 1
        state, width = ones, (1 << (2 * band + 1)) - 1
        for i, value in enumerate(left):
            mask = where.get(value)
            if mask:
                mask &= width << (i - band) if i >= band else width >> (band - i)
                used = state & mask
                state = ((state + used) | (state - used)) & ones
        matched += len(right) - state.bit_count()
    similarity = matched / (total - matched)
    return similarity if similarity >= threshold - 1e-12 else 0.0


def hashed(documents: DataFrame) -> DataFrame:
    """Stored (row, doc_id, text, h1, h2, n, keys, sketch, fine), one row per document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            rows = []
            for text in batch.text:
                s = shingler.shingles(text)
                if not len(s):
                    rows.append((None, None, 0, None, None, None))
                    continue
                at = np.arange(1, len(s) + 1, dtype=np.uint64)
                h1, h2 = (int(mix(s * at + c).sum().astype(np.int64)) for c in (at, np.uint64(7)))
                known = shingler.labelled(s)
                sketches = shingler.sketch(known), shingler.fine_sketch(known)
                rows.append((h1, h2, len(s), shingler.keys(known), *sketches))
            out = pd.DataFrame(rows, columns=["h1", "h2", "n", "keys", "sketch", "fine"])
            out["h1"], out["h2"] = out.h1.astype("Int64"), out.h2.astype("Int64")
            yield pd.concat([batch.reset_index(drop=True), out], axis=1)

    source = numbered(documents, "doc_id", "text")
    kinds = StructType(list(source.schema.fields))
    kinds = kinds.add("h1", "long").add("h2", "long").add("n", "integer")
    kinds = kinds.add("keys", ArrayType(LongType())).add("sketch", ArrayType(LongType()))
    kinds = kinds.add("fine", ArrayType(LongType()))
    with small_batches(documents.sparkSession):
        return stored(source.mapInPandas(run, kinds), "minhash")


def close_enough(a: str, b: str) -> Column:
    """Lossless length test and sketch test; the latter lets a pair at the threshold through
    but for four standard deviations."""
    least = F.least(f"{a}.n", f"{b}.n")
    differ = sum(
        (F.bit_count(F.col(f"{a}.sketch")[k].bitwiseXOR(F.col(f"{b}.sketch")[k])) for k in range(4)),
        start=F.lit(0),
    )
    share = (1 - THRESHOLD) / 2
    spread = F.sqrt(F.lit(share * (1 - share)) / F.least(least, F.lit(SKETCH_BITS)))
    allowed = SKETCH_BITS * (share + 4 * spread)
    return (least >= THRESHOLD * F.greatest(f"{a}.n", f"{b}.n")) & (differ <= allowed)


def closer_enough(a: str, b: str) -> Column:
    """The same with the fine sketch: the share of bins that differ, among those that either
    fills, may be ``FINE_SPREADS`` standard deviations above that of a pair at the threshold. The bins
    are drawn without replacement from the shingles of both, which narrows the deviation for
    short texts."""
    words = FINE_BINS // 64
    x, y = F.col(f"{a}.fine"), F.col(f"{b}.fine")

    def differing(k: int) -> Column:
        out = x[k].bitwiseXOR(y[k])
        for plane in range(1, 5):
            out = out.bitwiseOR(x[plane * words + k].bitwiseXOR(y[plane * words + k]))
        return F.bit_count(out)

    differ = sum(map(differing, range(words)), start=F.lit(0))
    either = sum(
        (F.bit_count(x[k].bitwiseOR(y[k])) for k in range(4 * words, 5 * words)), start=F.lit(0)
    )
    union = (F.col(f"{a}.n") + F.col(f"{b}.n")) / (1 + THRESHOLD)
    share = 1 - THRESHOLD
    spread = F.sqrt(
        share * (1 - share) / either * F.greatest(F.lit(0.05), 1 - either / union)
    )
    return close_enough(a, b) & (differ <= either * (share + FINE_SPREADS * spread))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Stored pairs (a, b) of nodes whose texts align.

    Pairs are dealt by ``a``; its text comes once for all its pairs.
    """
    pairs = stored(pairs.distinct(), "minhash-pairs")
    nodes = stored(
        pairs.select(F.col("a").alias("row")).union(pairs.select(F.col("b").alias("row"))).distinct(),
        "minhash-nodes",
    )
    needed = texts.select("row", "text").join(checked(nodes, 16), "row")
    needed = stored(needed, "minhash-texts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        known: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            keep = []
            for a, b, text_a, text_b in zip(batch.a, batch.b, batch.text_a, batch.text_b, strict=True):
                if size > KEPT_SHINGLES:
                    known, size = {}, 0
                for node, text in ((a, text_a), (b, text_b)):
                    if node not in known:
                        known[node] = shingler.shingles(text)
                        size += len(known[node])
                keep.append(aligned(known[a], known[b]) > 0)
            yield batch.loc[keep, ["a", "b"]]

    both = pairs.join(
        needed.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(needed.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    with small_batches(pairs.sparkSession, 64):
        return stored(both.mapInPandas(run, EDGE_SCHEMA), "minhash-edges")


def open_buckets(keyed: DataFrame, unique: DataFrame, member: DataFrame) -> DataFrame:
    """Stored rows of the buckets whose nodes are not all in one component."""
    named = keyed.join(member.select("node", "component"), "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        named.groupBy("t", "key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low != high")
        .select("t", "key")
    )
    rows = named.join(several, ["t", "key"])
    return stored(rows.join(unique.select("node", "fine", "keys"), "node"), "minhash-open")


def first_table() -> Column:
    """Whether no table before the bucket's has the pair in one bucket, too."""
    earlier = (
        ((F.col("x.t") > t) & (F.col("x.keys")[t] == F.col("y.keys")[t])).cast("int")
        for t in range(TABLES - 1)
    )
    return sum(earlier, start=F.lit(0)) == 0


def cross_pairs(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Pairs (a, b) of one bucket and different components that pass the sketch tests."""
    return (
        left.alias("x")
        .join(
            right.alias("y"),
            (F.col("x.t") == F.col("y.t"))
            & (F.col("x.key") == F.col("y.key"))
            & (F.col("x.component") != F.col("y.component"))
            & condition
            & closer_enough("x", "y"),
        )
        .select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: (row, doc_id, class_id, kept), and ``ROW`` if ``documents`` has it."""
    rows = hashed(documents)
    usable = rows.filter("n > 0")
    unique = stored(
        usable.groupBy("h1", "h2").agg(
            F.min("row").alias("node"),
            F.min("n").alias("n"),
            F.first("keys").alias("keys"),
            F.first("sketch").alias("sketch"),
            F.first("fine").alias("fine"),
        ),
        "minhash-nodes",
    )
    keyed = unique.select("node", "n", "sketch", F.posexplode("keys").alias("t", "key"))
    shared = keyed.groupBy("t", "key").agg(
        F.count(F.lit(1)).alias("m"),
        F.min(F.struct(F.xxhash64("node", "t").alias("h"), "node", "n", "sketch")).alias("p"),
    )
    pivots = shared.filter("m > 1").select(
        "t", "key", F.col("p.node").alias("node"), F.col("p.n").alias("n"), F.col("p.sketch").alias("sketch")
    )
    # Every member with the pivot of each of its buckets, already past the cheap tests.
    stars = stored(
        keyed.alias("x")
        .join(
            pivots.alias("y"),
            (F.col("x.t") == F.col("y.t"))
            & (F.col("x.key") == F.col("y.key"))
            & (F.col("x.node") != F.col("y.node"))
            & close_enough("x", "y"),
        )
        .select(
            F.col("x.t").alias("t"),
            F.greatest("x.node", "y.node").alias("a"),
            F.least("x.node", "y.node").alias("b"),
        ),
        "minhash-stars",
    )
    edges = verified(stars.filter(F.col("t") < FIRST_TABLES).select("a", "b"), usable)
    member = components(edges, "minhash-components")

    def apart(pairs: DataFrame) -> DataFrame:
        """Pairs whose nodes are not connected so far."""
        left = member.select(F.col("node").alias("a"), F.col("component").alias("ca"))
        right = member.select(F.col("node").alias("b"), F.col("component").alias("cb"))
        joined = pairs.join(left, "a", "left").join(right, "b", "left")
        return joined.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    more = verified(apart(stars.filter(F.col("t") >= FIRST_TABLES).select("a", "b")), usable)
    edges = edges.union(more)
    member = components(edges, "minhash-components")
    # Buckets that still hold several components get two more pivots, ...
    open_rows = open_buckets(keyed, unique, member)
    pivots = (
        open_rows.groupBy("t", "key")
        .agg(
            *(
                F.min(
                    F.struct(F.xxhash64("node", "t", F.lit(k)).alias("h"), "node", "n", "component", "fine", "sketch")
                ).alias(f"p{k}")
                for k in (1, 2)
            )
        )
        .select("t", "key", F.explode(F.array("p1", "p2")).alias("p"))
        .select("t", "key", "p.*")
    )
    more = verified(cross_pairs(open_rows, pivots, F.lit(True)), usable)
    edges = edges.union(more)
    member = components(edges, "minhash-components")
    # ... and what is left of them meets in full.
    open_rows = open_buckets(keyed, unique, member)
    rest = cross_pairs(open_rows, open_rows, (F.col("x.node") > F.col("y.node")) & first_table())
    rest = rest.join(stars.select("a", "b").distinct(), ["a", "b"], "left_anti")
    edges = stored(edges.union(verified(rest, usable)), "minhash-edges")
    member = components(edges, "minhash-components")
    of_words = (
        unique.select("h1", "h2", "node")
        .join(member, "node", "left")
        .select("h1", "h2", F.coalesce("component", "node").alias("class"))
    )
    placed = (
        rows.select("row", "doc_id", "h1", "h2", *rows_of(rows))
        .join(of_words, ["h1", "h2"], "left")
        .withColumn("class", F.coalesce("class", "row"))
    )
    placed = stored(placed.select("row", "doc_id", "class", *rows_of(placed)), "minhash-classes")
    # A null id ranks after every other.
    first = placed.groupBy("class").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
    )
    return placed.join(first, "class").select(
        "row",
        "doc_id",
        "class_id",
        (F.col("row") == F.col("first.row")).alias("kept"),
        *rows_of(placed),
    )


def deduplicated(documents: DataFrame) -> DataFrame:
    """One document of each class, with all columns of ``documents``.

    The dropped rows are the small side of the join.
    """
    rows = with_rows(documents, "minhash-rows")
    with temporary(documents.sparkSession) as keep:
        dropped = keep(near_duplicates(rows).filter("NOT kept").select(*ROW), "minhash-dropped")
    return without(rows, dropped, documents.columns)

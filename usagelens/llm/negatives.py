"""Hard-negative mining with a distributed multiway hyperplane tree (GNAT style).

Every split node has several split points taken from its own rows, far from each other; a row
goes to the child of the nearest one. The node stores, for every split point and every child,
the range of distances from the point to the child's rows. A search knows its window of
scores, which at given norms is an annulus of distances around the query; a child is left out
if its range from any split point, its own or a sibling's, does not meet the annulus seen from
that point. What remains is scored exactly in the leaves, so nothing is approximate.

Integer inner products s relate to distances d by d² = |a|² + |x|² - 2s; a child also stores
the range of its norms. Rows with equal vectors and labels are one entry of the tree with its
smallest ids, and anchors with equal vectors are searched once.

The tree is built level by level: a level takes nodes with more than ``LEAF_ROWS`` entries,
draws split points per node and deals the rows on in blocks, and no node, table of ranges or
list of queries is collected to one place. A search walks all queries down together, one level
a step, in blocks of queries, and meets the leaves in blocks of entries and of queries. The
first search is for the positives: the scores inside the anchor's own leaf give it a bound.
The second is for the negatives, with one window for every positive score, bounded from below
by the own leaf in the same way.

Defined cases: a row whose id, label or vector is null, or that has a null or non-finite
component, takes no part; vectors of different lengths never meet; an empty vector scores 0;
rows that repeat a vec_id are rows of their own and other rows for each other, and an anchor
that is repeated has its rows as often; rows with equal score and id give equal results; scores
beyond 64 bits become the largest long; an empty table gives no rows; other columns do not
matter.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import checked, stored

SCALE, ANCHOR_EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 5
# The window of a negative's score in percent of the positive's.
LOW, HIGH = 80, 100
# Split points of a node and rows drawn to choose them from, entries of a leaf, and rows or
# queries that meet in one task.
WAYS, DRAWN, LEAF_ROWS, BLOCK_ROWS = 16, 64, 2048, 4096
SEED = 11
# Relative allowance for rounding in distances.
SLACK = 1e-9
# Largest score; a window without a bound goes from the negative of it to it.
LONG = 2**63 - 1


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x) of the rows that take part."""
    finite = F.forall(
        "embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    x = F.transform("embedding", lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return vectors.filter(usable).select(F.col("vec_id").cast("long").alias("vec_id"), "label", x.alias("x"))


def entries(rows: DataFrame) -> DataFrame:
    """Stored (entry, label, x, ids): distinct (label, vector), the smallest ids of each, one
    more than an anchor needs since it may have to leave itself out."""
    order = Window.partitionBy("label", "x").orderBy("vec_id")
    first = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= POSITIVES + 1)
    return stored(
        first.groupBy("label", "x")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("entry", F.monotonically_increasing_id()),
        "negative-entries",
    )


def matrix(x: pd.Series) -> np.ndarray:
    """Vectors of one length as the rows of an integer matrix."""
    return np.stack([np.asarray(v, np.int64) for v in x]) if len(x) else np.empty((0, 0), np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where they hold every sum, else in whole numbers of any
    size, cut to 64 bits."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -LONG, LONG).astype(np.int64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances from the rows of ``a`` to those of ``b``."""
    a, b = a.astype(float), b.astype(float)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0))


def spread(x: np.ndarray, ways: int) -> list[int]:
    """Rows far from each other: each next one is farthest from those taken. Fewer, if the rows
    have fewer different vectors."""
    taken = [0]
    away = distances(x, x[:1])[:, 0]
    while len(taken) < min(ways, len(x)) and away.max() > 0:
        taken.append(int(away.argmax()))
        away = np.minimum(away, distances(x, x[taken[-1:]])[:, 0])
    return taken


def split_points(rows: DataFrame, large: DataFrame, level: int) -> DataFrame:
    """Stored (node, blocks, way, point) for the ``large`` nodes."""
    drawn = Window.partitionBy("node").orderBy(F.xxhash64("entry", F.lit(SEED + level)), "entry")
    kind = "node string, blocks int, way int, point array<long>"
    candidates = (
        rows.join(checked(large, 64), "node")
        .withColumn("drawn", F.row_number().over(drawn))
        .filter(F.col("drawn") <= DRAWN)
        .select("node", "blocks", "x")
    )

    def choose(group: pd.DataFrame) -> pd.DataFrame:
        chosen = spread(matrix(group.x), WAYS)
        points = group.iloc[chosen].rename(columns={"x": "point"})
        return points.assign(way=np.arange(len(chosen)))[["node", "blocks", "way", "point"]]

    return stored(candidates.groupBy("node").applyInPandas(choose, kind), "negative-points")


def dealt(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.col("blocks")).cast("int").alias("block")


def all_blocks() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")


def build(rows: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """(leaves, levels): the entries with their ``leaf``, and for each level its split points
    (node, way, point) and its children (node, way, child, low, high, small, large): ranges of
    the distances to every split point and of the squared norms."""
    label = rows.schema["label"].dataType.simpleString()
    row_kind = f"entry long, label {label}, x array<long>, ids array<long>, node string"
    split_kind = f"{row_kind}, way int, d array<double>, norm double"
    rows = rows.withColumn("node", F.size("x").cast("string"))
    finished, levels = [], []
    while True:
        sizes = stored(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "negative-sizes")
        large = sizes.filter(F.col("n") > LEAF_ROWS).withColumn(
            "blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int")
        )
        finished.append(rows.join(checked(large.select("node"), 64), "node", "left_anti"))
        if large.isEmpty():
            break
        points = split_points(rows, large.select("node", "blocks"), len(levels))
        moving = rows.join(checked(large.select("node", "blocks"), 64), "node")

        def deal(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left):
                return pd.DataFrame(columns=["entry", "label", "x", "ids", "node", "way", "d", "norm"])
            x, right = matrix(left.x), right.sort_values("way")
            d = distances(x, matrix(right.point))
            out = left[["entry", "label", "x", "ids", "node"]].copy()
            out["way"] = d.argmin(1).astype(np.int32)
            out["d"] = list(d)
            out["norm"] = (x.astype(float) ** 2).sum(1)
            return out

        split = stored(
            moving.select("*", dealt("entry"))
            .groupBy("node", "block")
            .cogroup(points.select("*", all_blocks()).groupBy("node", "block"))
            .applyInPandas(deal, split_kind),
            "negative-split",
        )
        far = [F.get("d", F.lit(k)) for k in range(WAYS)]
        ranges = split.groupBy("node", "way").agg(
            F.array_compact(F.array(*[F.min(d) for d in far])).alias("low"),
            F.array_compact(F.array(*[F.max(d) for d in far])).alias("high"),
            F.min("norm").alias("small"),
            F.max("norm").alias("large"),
        )
        child = F.concat_ws(".", "node", "way")
        children = stored(ranges.withColumn("child", child), "negative-ranges")
        levels.append((points.select("node", "way", "point"), children))
        moved = split.select("entry", "label", "x", "ids", "node", child.alias("child"))
        # A node whose rows are all equal has one child; its rows stay where they are.
        single = children.groupBy("node").count().filter("count = 1").select("node")
        finished.append(moved.join(single, "node", "left_semi").withColumn("node", F.col("child")).drop("child"))
        rows = moved.join(single, "node", "left_anti").withColumn("node", F.col("child")).drop("child")
    leaves = finished[0]
    for more in finished[1:]:
        leaves = leaves.unionByName(more)
    return stored(leaves.withColumnRenamed("node", "leaf"), "negative-leaves"), levels


def in_blocks(df: DataFrame, key: str) -> DataFrame:
    """``blocks`` for every value of ``key``, from its stored rows."""
    return df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))


def meeting(x: np.ndarray, low: list, high: list, d: np.ndarray, children: pd.DataFrame) -> np.ndarray:
    """(queries, children): whether some window's annulus meets the child's range of distances
    from every split point. ``d`` holds the distances from the queries to the points."""
    norm = (x.astype(float) ** 2).sum(1)
    small, large = children.small.to_numpy(), children.large.to_numpy()
    near, far = np.stack(children.low.to_numpy()), np.stack(children.high.to_numpy())
    out = np.zeros((len(x), len(children)), bool)
    for k in range(len(x)):
        for lo, hi in zip(np.asarray(low[k], float), np.asarray(high[k], float), strict=True):
            outer = norm[k] + large - 2 * lo
            inner = norm[k] + small - 2 * hi
            ease = SLACK * (norm[k] + large + 1)
            r = np.sqrt(np.maximum(outer + ease, 0))[:, None]
            q = np.sqrt(np.maximum(inner - ease, 0))[:, None]
            gap = 1e-6 * (1 + d[k][None, :])
            # Distances from a split point that a row inside the annulus can have.
            least = np.maximum(d[k][None, :] - r, q - d[k][None, :]) - gap
            most = d[k][None, :] + r + gap
            out[k] |= (outer + ease >= 0) & ((far >= least) & (near <= most)).all(1)
    return out


def walk(queries: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(query, leaf) of all leaves that the windows of ``queries(query, x, low, high)`` may need."""
    at = queries.select("query", F.size("x").cast("string").alias("node"))
    arrived = []
    for points, children in levels:
        at = stored(at, "negative-walk")
        nodes = points.select("node").distinct()
        arrived.append(at.join(checked(nodes, 64), "node", "left_anti"))
        blocks = at.join(checked(nodes, 64), "node").groupBy("node").agg(
            F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")
        )
        blocks = stored(blocks, "negative-walk-blocks")
        asking = at.join(checked(blocks, 64), "node").join(queries, "query").select(
            "query", "node", "x", "low", "high", dealt("query")
        )
        # Points and ranges of a node travel as one list of rows to each of its blocks.
        info = (
            points.withColumn("child", F.lit(None).cast("string"))
            .select("node", "way", "point", "child", *[F.lit(None).cast(t).alias(c) for c, t in RANGES])
            .unionByName(
                children.select(
                    "node", "way", F.lit(None).cast("array<long>").alias("point"), "child", *[c for c, _ in RANGES]
                )
            )
            .join(checked(blocks, 64), "node")
            .select("*", all_blocks())
        )

        def step(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query": [], "node": []})
            known = right[right.child.isna()].sort_values("way")
            below = right[right.child.notna()].sort_values("way")
            x = matrix(left.x)
            d = distances(x, matrix(known.point))
            i, j = np.nonzero(meeting(x, left.low.tolist(), left.high.tolist(), d, below))
            return pd.DataFrame({"query": left["query"].to_numpy()[i], "node": below.child.to_numpy()[j]})

        at = (
            asking.groupBy("node", "block")
            .cogroup(info.groupBy("node", "block"))
            .applyInPandas(step, "query long, node string")
        )
    arrived.append(at)
    out = arrived[0]
    for more in arrived[1:]:
        out = out.unionByName(more)
    return stored(out.select("query", F.col("node").alias("leaf")), "negative-visits")


RANGES = [("low", "array<double>"), ("high", "array<double>"), ("small", "double"), ("large", "double")]
FOUND = "query long, window int, score long, vec_id long, entry long"


def scan(queries: DataFrame, visits: DataFrame, leaves: DataFrame, same_label: bool, most: int) -> DataFrame:
    """The best ``most`` rows of every query and window, (query, window, score, vec_id, entry),
    by score and then id, among the visited leaves.

    ``queries``: (query, label, x, low, high), the windows in two arrays of longs.
    """
    blocks = stored(
        visits.groupBy("leaf")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
        .join(in_blocks(leaves, "leaf").withColumnRenamed("blocks", "parts"), "leaf"),
        "negative-blocks",
    )
    part = F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int").alias("part")
    rows = leaves.join(checked(blocks, 64), "leaf").select(
        "leaf", part, all_blocks(), "entry", "label", "x", "ids"
    )
    asking = (
        visits.join(checked(blocks, 64), "leaf")
        .select("leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), dealt("query"), "query")
        .join(queries, "query")
    )

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {c: [] for c in ("query", "window", "score", "vec_id", "entry")}
        if len(left) and len(right):
            s = products(matrix(left.x), matrix(right.x))
            ids, entry = right.ids.tolist(), right.entry.to_numpy()
            smallest = np.array([i[0] for i in ids], np.int64)
            alike = left.label.to_numpy()[:, None] == right.label.to_numpy()[None, :]
            allowed = alike if same_label else ~alike
            for k, (query, low, high) in enumerate(zip(left["query"], left.low, left.high, strict=True)):
                for window, (lo, hi) in enumerate(zip(low, high, strict=True)):
                    at = np.flatnonzero(allowed[k] & (s[k] >= lo) & (s[k] <= hi))
                    if len(at) > most:
                        at = at[np.lexsort((smallest[at], -s[k, at]))[:most]]
                    found = sorted((-int(s[k, j]), i, int(entry[j])) for j in at for i in ids[j])[:most]
                    for minus, i, e in found:
                        for c, v in zip(out, (query, window, -minus, i, e), strict=True):
                            out[c].append(v)
        return pd.DataFrame(out)

    found = (
        asking.groupBy("leaf", "part", "block")
        .cogroup(rows.groupBy("leaf", "part", "block"))
        .applyInPandas(score, FOUND)
    )
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "vec_id", "entry")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def raised(queries: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """``queries`` with every window's lower bound at the last of ``most`` rows found in it."""
    bounds = (
        found.groupBy("query", "window")
        .agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        .filter(F.col("n") >= most)
        .groupBy("query")
        .agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("least"))
    )
    low = F.transform("low", lambda v, k: F.greatest(v, F.coalesce(F.col("least")[k], F.lit(-LONG))))
    return queries.join(bounds, "query", "left").withColumn("low", F.coalesce(low, "low")).drop("least")


def search(
    queries: DataFrame, own: DataFrame, leaves: DataFrame, levels: list, same_label: bool, most: int
) -> DataFrame:
    """Best rows of every query and window over the whole tree; ``own`` is (query, leaf)."""
    if not levels:
        return stored(scan(queries, own, leaves, same_label, most), "negative-found")
    near = stored(scan(queries, own, leaves, same_label, most), "negative-near")
    bounded = stored(raised(queries, near, most), "negative-queries")
    return stored(scan(bounded, walk(bounded, levels), leaves, same_label, most), "negative-found")


def hard_negatives(vectors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, positive_rank, rank, negative_id, positive_score, negative_score).

    ``vectors``: (vec_id, embedding, label). Anchors are the rows whose id is a multiple of
    ``ANCHOR_EVERY``, positives the best of their label, negatives the best of other labels
    inside the window below the positive's score.
    """
    rows = quantised(vectors)
    every = entries(rows)
    leaves, levels = build(every)
    anchors = stored(
        rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
        .join(every.select("label", "x", "entry"), ["label", "x"])
        .select(F.col("vec_id").alias("anchor_id"), F.col("entry").alias("query"))
        .withColumn("anchor", F.monotonically_increasing_id()),
        "negative-anchors",
    )
    asked = anchors.select("query").distinct()
    start = stored(
        leaves.join(asked, leaves.entry == asked["query"], "left_semi").select(
            F.col("entry").alias("query"),
            "leaf",
            "label",
            "x",
            F.array(F.lit(-LONG)).alias("low"),
            F.array(F.lit(LONG)).alias("high"),
        ),
        "negative-start",
    )
    own = start.select("query", "leaf")
    queries = start.drop("leaf")
    best = search(queries, own, leaves, levels, True, POSITIVES + 1)
    # The anchor itself is left out where it is among them, and one row too many else.
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", F.desc("itself"))
    itself = ((F.col("vec_id") == F.col("anchor_id")) & (F.col("entry") == F.col("query"))).alias("itself")
    positives = stored(
        anchors.join(best, "query")
        .select("anchor", "anchor_id", "query", "score", "vec_id", itself)
        .withColumn("nth", F.sum(F.col("itself").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(~(F.col("itself") & (F.col("nth") == 1)))
        .withColumn("positive_rank", F.row_number().over(order))
        .filter(F.col("positive_rank") <= POSITIVES)
        .select("anchor", "anchor_id", "query", "positive_rank", F.col("vec_id").alias("positive_id"), "score"),
        "negative-positives",
    )
    # One window for each score of a positive; scores below 0 have none that is not empty.
    windows = (
        positives.filter("score >= 0")
        .groupBy("query")
        .agg(F.array_sort(F.collect_set("score")).alias("scores"))
        .select(
            "query",
            "scores",
            F.transform("scores", lambda s: F.ceil(s.cast("decimal(20,0)") * LOW / HIGH).cast("long")).alias("low"),
            F.col("scores").alias("high"),
        )
    )
    seeking = stored(queries.drop("low", "high").join(windows, "query"), "negative-windows")
    found = search(
        seeking.drop("scores"), own.join(seeking.select("query"), "query", "left_semi"), leaves, levels, False, NEGATIVES
    )
    named = found.join(seeking.select("query", "scores"), "query").select(
        "query",
        F.get("scores", F.col("window")).alias("positive_score"),
        F.col("score").alias("negative_score"),
        F.col("vec_id").alias("negative_id"),
        F.row_number()
        .over(Window.partitionBy("query", "window").orderBy(F.desc("score"), "vec_id"))
        .alias("rank"),
    )
    return (
        positives.withColumnRenamed("score", "positive_score")
        .join(named, ["query", "positive_score"])
        .select(
            "anchor_id", "positive_id", "positive_rank", "rank", "negative_id", "positive_score", "negative_score"
        )
    )

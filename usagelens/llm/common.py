"""Helpers shared by the operators: stored intermediates, checked broadcasts, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from usagelens.session import scratch_path

# A side of a join is broadcast only below this many bytes, counted before the join.
BROADCAST_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """At most ``rows`` rows go to Python at once in the jobs run inside the block.

    Texts can be long, and a batch of the usual ten thousand is held several times over.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) < rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs the reading tasks only, and whatever reads the
    result twice does not compute it twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    for paths in _temporary[-1:]:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_temporary: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes, at its end, what was stored inside the block, but for what was stored with the
    function it gives. For blocks whose results are stored, not lazy."""
    kept: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        out = stored(df, label)
        kept.append(_temporary[-1].pop())
        return out

    _temporary.append([])
    try:
        yield keep
    finally:
        for path in _temporary.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        for paths in _temporary[-1:]:
            paths.extend(kept)


def checked(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay below the limit.

    ``df`` must be cheap to count, as a stored table is. Above the limit the join shuffles,
    with the same rows.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


# Columns that name a row of stored files: a hash of the file's path and the place in the file.
ROW = ["file of the row", "place in the file"]


def with_rows(df: DataFrame, label: str) -> DataFrame:
    """``df`` with the columns ``ROW``, to which decisions about rows are joined back.

    They belong to the files. Numbers given while reading would not do: how files are cut
    into partitions can change when executors come and go. What is not read from files that
    number their rows is stored first.
    """

    def named(df: DataFrame) -> DataFrame:
        origin = df.metadataColumn("_metadata")
        return df.withColumns({ROW[0]: F.xxhash64(origin["file_path"]), ROW[1]: origin["row_index"]})

    try:
        return named(df)
    except AnalysisException:
        return named(stored(df, label))


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``df``, ``ROW`` if it has them, and ``row``, a number good for one read."""
    return df.select(F.monotonically_increasing_id().alias("row"), *columns, *rows_of(df))


def rows_of(df: DataFrame) -> list[str]:
    return [c for c in ROW if c in df.columns]


def without(df: DataFrame, dropped: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of ``df``, of ``with_rows``, that the stored ``dropped`` does not name."""
    return df.join(checked(dropped.select(*ROW), 24), ROW, "left_anti").select(*columns)


def text_or_empty(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """Row count and an order-free checksum of an edge table."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], int(row["h"] or 0)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, component), the smallest node.

    Alternating large-star and small-star rounds: each round points every node's larger
    neighbours at its smallest one, then every node and its smaller neighbours at the
    smallest of those. The edge set never grows beyond twice the input, minima are combined
    before the shuffle, and the number of rounds is logarithmic. Every round is a stored
    table. Nodes without an edge do not appear.
    """
    spark = edges.sparkSession
    now = stored(
        edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        label,
    )
    seen = fingerprint(now)
    while seen[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(smallest, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
            .distinct()
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        pointed = large.join(smallest, "a")
        small = (
            pointed.filter("b != m")
            .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .union(smallest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        now = stored(small, label)
        after = fingerprint(now)
        if after == seen:
            break
        seen = after
    if not seen[0]:
        return spark.createDataFrame([], now.schema).toDF("node", "component")
    # At rest every edge is (node, smallest node of its component).
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct()
    )

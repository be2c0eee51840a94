"""Order-dependent operators that stay parallel when one key holds most of the rows.

A window partitioned by a hot key runs in one task. Here the rows are dealt once over range
partitions of (key, order), so a hot key spans as many of them as it needs, and stored in
buckets of one partition each. Windows run inside the partitions, without another shuffle.
Only the first key of a partition can have rows before it elsewhere; what it needs from them
is carried over from one summary row per partition. Input of any size takes this path.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from usagelens.session import scratch_path

# Number of the range partition a row lies in.
SLICE = "_slice"
_ROWS_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``max_rows`` narrow rows; otherwise as it
    is, for a shuffled join. Counts, so ``df`` should be materialised."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def _struct(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(name) for name in names])


def laid_out(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None
) -> DataFrame:
    """``df`` with ``SLICE``: range partitions over (keys, order), numbered in that order.

    This is the one shuffle of the rows. They are stored in the shared folder, bucketed by
    ``SLICE``, so that later jobs see the same partitions and windows inside them need no
    shuffle. ``slices`` defaults to the session's shuffle partitions. The catalog entry that
    buckets need is dropped at once; the files stay for whoever cleans the folder.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *keys, *order).withColumn(SLICE, F.spark_partition_id())
    name = f"spark_catalog.default.ordered_{uuid.uuid4().hex}"
    writer = ranged.write.format("parquet").bucketBy(slices, SLICE)
    writer.option("path", scratch_path(spark, "ordered")).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def _carried(local: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, carry) -> DataFrame:
    """(SLICE, _first, _carried): what ``carry`` makes, for the first key of every partition, of
    ``value`` in the last rows of the partitions before it that end with that key.

    One row per partition goes in and comes out, whatever the number of rows and keys.
    """
    key, place = _struct(keys), _struct([*keys, *order])
    ends = local.groupBy(SLICE).agg(
        F.min(key).alias("_first"), F.max(key).alias("_last"), F.max_by(value, place).alias("_end")
    )
    gives = ends.select(F.col("_last").alias("_key"), SLICE, F.lit(1).alias("_gives"), "_end")
    nothing = F.lit(None).cast(ends.schema["_end"].dataType).alias("_end")
    asks = ends.select(F.col("_first").alias("_key"), SLICE, F.lit(0).alias("_gives"), nothing)
    before = Window.partitionBy("_key").orderBy(SLICE, "_gives")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    answers = asks.unionByName(gives).withColumn("_carried", carry("_end").over(before))
    return answers.where("_gives = 0").select(SLICE, F.col("_key").alias("_first"), "_carried")


def lag_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alias: str,
    slices: int | None = None,
) -> DataFrame:
    """``value`` of the previous row of the same key, NULL on its first row.

    ``order`` must be a total order within a key.
    """
    rows = laid_out(df, keys, order, slices)
    window = Window.partitionBy(SLICE, *keys).orderBy(*order)
    local = rows.select(
        "*",
        F.lag(value).over(window).alias("_local"),
        (F.row_number().over(window) == 1).alias("_is_head"),
    )
    # In a struct, a NULL of the last row differs from having no row.
    carried = _carried(rows, keys, order, F.struct(value), lambda end: F.last(end, ignorenulls=True))
    own = F.when(_struct(keys).eqNullSafe(F.col("_first")), F.col("_carried")[value])
    previous = F.when(F.col("_is_head"), own).otherwise(F.col("_local"))
    # One row per range partition.
    joined = local.join(F.broadcast(carried), SLICE, "left")
    return joined.select(*df.columns, previous.alias(alias))


def _added(a: Column, b: Column, kind: T.DataType) -> Column:
    """``a + b`` in ``kind``. Two decimals of full width would give up a digit behind the point
    for the carry; a digit less before it keeps all of them."""
    if isinstance(kind, T.DecimalType) and kind.precision == T.DecimalType(38).precision:
        kind = T.DecimalType(kind.precision - 1, kind.scale)
    return a.cast(kind) + b.cast(kind)


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    alias: str,
    slices: int | None = None,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key to this one (ROWS frame).

    A scan in two levels: sums run inside the range partitions, and what the first key of a
    partition had before is the sum of the last totals of the partitions that end with it.
    """
    rows = laid_out(df, keys, order, slices)
    window = Window.partitionBy(SLICE, *keys).orderBy(*order).rowsBetween(*_ROWS_SO_FAR)
    local = rows.select("*", F.sum(value).over(window).alias("_local"))
    carried = _carried(local, keys, order, F.col("_local"), F.sum)
    before = F.when(_struct(keys).eqNullSafe(F.col("_first")), F.col("_carried"))
    # The type of the plain window, whatever the sum of sums would have.
    kind = df.select(F.sum(value).alias(alias)).schema[alias].dataType
    so_far = F.coalesce(_added(before, F.col("_local"), kind), "_local", before).cast(kind)
    # One row per range partition.
    joined = local.join(F.broadcast(carried), SLICE, "left")
    return joined.select(*df.columns, so_far.alias(alias))


def running_sum_with_peers(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    alias: str,
    slices: int | None = None,
) -> DataFrame:
    """Running sum in which rows of equal ``order`` count together (default RANGE frame).

    Peers are summed first, with partial aggregation, so the running pass sees one row
    per distinct order value.
    """
    peers = df.groupBy(*keys, order).agg(F.sum(value).alias("_peers"))
    running = running_sum(peers, keys, [order], "_peers", alias, slices)
    marks = [*keys, order]
    running = running.select(*[F.col(m).alias(f"_r_{m}") for m in marks], alias)
    match = [F.col(m).eqNullSafe(F.col(f"_r_{m}")) for m in marks]
    return df.join(running, match, "left").select(*[df[c] for c in df.columns], alias)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    exclude: Sequence[str] = (),
    where: Column | None = None,
) -> DataFrame:
    """The row of each key with the greatest ``order_by``, minus ``exclude`` columns.

    ``where`` is tested after ranking ("the latest row is a delete"). The rank filter is
    applied before the shuffle too, so a hot key sends one row per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order_by])
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1)
    if where is not None:
        ranked = ranked.where(where)
    return ranked.drop("_rank", *exclude)


def page(
    df: DataFrame,
    order: Sequence[str],
    number: int,
    size: int = 10,
    descending: bool = True,
    slices: int | None = None,
) -> tuple[DataFrame, int]:
    """One page of ordered rows and the page count; a page out of range becomes page 0.

    ``order`` must be a total order over columns without NULLs. The counts of the range
    partitions tell which of them hold the page; only those are read again and sorted, so a
    deep page costs what the first one does.
    """
    laid = laid_out(df, [], order, slices)
    # One row per range partition.
    counts = sorted((row[SLICE], row["count"]) for row in laid.groupBy(SLICE).count().collect())
    rows = sum(n for _, n in counts)
    pages = max(1, -(-rows // size))
    if not 0 <= number < pages:
        number = 0
    low, high = number * size, min(rows, (number + 1) * size)
    if descending:
        low, high = rows - high, rows - low
    holding, skipped, at = [], 0, 0
    for part, n in counts:
        if at + n <= low:
            skipped = at + n
        elif at < high:
            holding.append(part)
        at += n
    rising = laid.where(F.col(SLICE).isin(holding)).orderBy(*order)
    wanted = rising.offset(low - skipped).limit(high - low)
    ordering = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return wanted.orderBy(*ordering).select(*df.columns), pages

"""Keeping a target table up to date: append, replace, upsert, history, constraints.

Each operator is a pure function of DataFrames and returns the new target. Writing it is
left to ``sources.sinks``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.temporal import at
from usagelens.operators.ordered import latest_by_key


class ConstraintViolation(ValueError):
    """Rows broke an enforced check constraint."""


def append(target: DataFrame | None, batch: DataFrame) -> DataFrame:
    return batch if target is None else target.unionByName(batch)


def delete_insert(target: DataFrame | None, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Drop target rows whose key occurs in the batch, then add the whole batch.

    Duplicates inside the batch survive. A NULL key matches nothing. The batch keys are
    made distinct before they are shuffled, so a key repeated in the batch costs one row.
    """
    if target is None:
        return batch
    keys = batch.select(*key).distinct()
    return target.join(keys, list(key), "left_anti").select(*target.columns).unionByName(batch)


def upsert(
    target: DataFrame | None, batch: DataFrame, key: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Update matched rows and insert new ones, with the latest batch row of each key."""
    return delete_insert(target, latest_by_key(batch, key, order_by), key)


def high_water_mark(target: DataFrame | None, ts_col: str) -> datetime | None:
    """Greatest ``ts_col``; NULL for a missing or empty target. Brings one row to the driver."""
    if target is None:
        return None
    return target.agg(F.max(ts_col)).first()[0]


def incremental_window(
    target: DataFrame | None,
    ts_col: str,
    lookback: timedelta,
    initial_from: datetime | None = None,
) -> Column:
    """Filter on ``ts_col``: back from the target's newest row, or the initial load.

    An empty target counts as a first run. The bound is a literal so that it reaches the
    Parquet scan.
    """
    newest = high_water_mark(target, ts_col)
    if newest is not None:
        return F.col(ts_col) >= at(newest - lookback)
    if initial_from is not None:
        return F.col(ts_col) >= at(initial_from)
    return F.lit(True)


def cdc_apply(
    target: DataFrame | None,
    landing: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    deleted_col: str,
    ingest_col: str,
) -> DataFrame:
    """Merge landing rows newer than the target, removing keys whose latest row is a delete.

    The mark is taken before the merge. A latest row whose flag is NULL changes nothing.
    """
    newest = high_water_mark(target, ingest_col)
    if newest is not None:
        landing = landing.where(F.col(ingest_col) > at(newest))
    latest = latest_by_key(landing, key, order_by, where=F.col(deleted_col).isNotNull())
    live = latest.where(~F.col(deleted_col))
    if target is None:
        return live
    kept = target.join(latest.select(*key), list(key), "left_anti").select(*target.columns)
    return kept.unionByName(live.select(*target.columns))


def snapshot_check(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime,
) -> DataFrame:
    """Slowly changing history (type 2) by comparing ``check_cols``.

    New keys open a version; a changed key closes its open version at ``as_of`` and opens
    another; a key that disappeared stays open. Running again with the same input changes
    nothing. A NULL key cannot be followed and is an error. One join of the open versions
    against the current rows does all of it.
    """
    missing = F.raise_error(F.lit(f"snapshot key {key} is NULL"))
    kind = current.schema[key].dataType
    current = current.withColumn(key, F.coalesce(key, missing.cast(kind)))
    columns = current.columns
    versioned = [*columns, "scd_id", "updated_at", "valid_from", "valid_to"]
    stamp = at(as_of)

    def opened(get: Callable[[str], Column]) -> Column:
        scd_id = F.md5(
            F.concat_ws("|", F.coalesce(get(key).cast("string"), F.lit("")), F.lit(str(as_of)))
        )
        return F.struct(
            *[get(c).alias(c) for c in columns],
            scd_id.alias("scd_id"),
            stamp.alias("updated_at"),
            stamp.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        )

    if history is None:
        return current.select(opened(F.col).alias("version")).select("version.*")

    was, now = history.where("valid_to is null").alias("was"), current.alias("now")
    joined = was.join(now, F.col(f"was.{key}") == F.col(f"now.{key}"), "full_outer")

    def before(closed: bool) -> Column:
        end = stamp if closed else F.col("was.valid_to")
        return F.struct(
            *[F.col(f"was.{c}").alias(c) for c in versioned[:-1]], end.alias("valid_to")
        )

    after = opened(lambda c: F.col(f"now.{c}"))
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"was.{c}").eqNullSafe(F.col(f"now.{c}"))
    versions = (
        F.when(F.col("was.scd_id").isNull(), F.array(after))
        .when(F.col(f"now.{key}").isNull() | same, F.array(before(closed=False)))
        .otherwise(F.array(before(closed=True), after))
    )
    moved = joined.select(F.explode(versions).alias("version")).select("version.*")
    return history.where("valid_to is not null").select(*versioned).unionByName(moved)


def changed_keys(before: DataFrame, after: DataFrame, key: str, check_cols: Sequence[str]) -> DataFrame:
    """``key, change`` for keys whose rows differ: NEW, CHANGED, MISSING or SAME."""
    b, a = before.alias("b"), after.alias("a")
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"b.{c}").eqNullSafe(F.col(f"a.{c}"))
    change = (
        F.when(F.col(f"b.{key}").isNull(), "NEW")
        .when(F.col(f"a.{key}").isNull(), "MISSING")
        .when(same, "SAME")
        .otherwise("CHANGED")
    )
    joined = b.join(a, F.col(f"b.{key}") == F.col(f"a.{key}"), "full_outer")
    return joined.select(F.coalesce(f"b.{key}", f"a.{key}").alias(key), change.alias("change"))


def active_count(silver: DataFrame, group: str, key: str, alias: str = "active_users") -> DataFrame:
    """Second stage of the latest-state chain: distinct keys per group, recomputed."""
    return silver.groupBy(group).agg(F.count_distinct(key).alias(alias))


def date_range(df: DataFrame, day: str) -> tuple[date, date] | None:
    """First day of ``df`` and the day after its last; None without any."""
    row = df.agg(F.min(day).alias("first"), F.max(day).alias("last")).first()
    return None if row["first"] is None else (row["first"], row["last"] + timedelta(days=1))


def run_microbatches(
    load: Callable[[date, date], None], start: date, end: date, step_days: int = 1
) -> int:
    """Call ``load(from, to)`` for consecutive half-open date ranges; returns how many."""
    batches = 0
    while start < end:
        stop = min(start + timedelta(days=step_days), end)
        load(start, stop)
        start, batches = stop, batches + 1
    return batches


def replace_range(
    target: DataFrame, batch: DataFrame, ts_col: str, start: datetime, end: datetime
) -> DataFrame:
    """Backfill: rows of ``[start, end)`` come from the batch, all others stay."""
    inside = (F.col(ts_col) >= at(start)) & (F.col(ts_col) < at(end))
    outside = ~F.coalesce(inside, F.lit(False))
    return target.where(outside).unionByName(batch.where(inside))


def enforce(
    df: DataFrame, constraints: dict[str, Column], mode: str = "ignore"
) -> tuple[DataFrame, DataFrame]:
    """Check constraints: ``(accepted, rejected)``.

    ``ignore`` accepts everything, ``fail`` raises on the first violation, ``quarantine``
    moves violating rows aside with the names of the constraints they broke. A predicate
    that is NULL passes.
    """
    if mode not in ("ignore", "fail", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(predicate, F.lit(True)), F.lit(name))
                for name, predicate in constraints.items()
            ]
        )
    )
    checked = df.withColumn("violations", broken)
    rejected = checked.where(F.size("violations") > 0)
    if mode == "ignore":
        return df, rejected.where(F.lit(False))
    if mode == "fail":
        first = rejected.select("violations").first()
        if first is not None:
            raise ConstraintViolation(f"violated: {', '.join(first[0])}")
        return df, rejected
    return checked.where(F.size("violations") == 0).drop("violations"), rejected

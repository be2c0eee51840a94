"""Keyed state over streams: latest rows with their changes, counters fed by them, and sessions
whose last interval is still open.

The state of a key lives in Spark's state store; a micro-batch writes what changed and
nothing else. Every sink folder belongs to one query and holds one partition per micro-batch,
overwritten as a whole, so a batch that is run again leaves the same files.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from usagelens.operators.ordered import latest_by_key
from usagelens.sources.sinks import overwrite_partitions
from usagelens.streaming.ingest import triggered

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _keyed_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which state variables need."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


# --- latest rows ------------------------------------------------------------------------


class LatestRow(StatefulProcessor):
    """Value state per key: its newest row. Gives the new and the former row when it changes."""

    def __init__(self, out: Sequence[str], schema: T.StructType, order_by: Sequence[str]) -> None:
        self._out, self._schema = list(out), schema
        self._order = [schema.fieldNames().index(name) for name in order_by]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._newest = handle.getValueState("newest", self._schema)

    def _place(self, values: tuple) -> tuple:
        # As in a descending order, NULL counts as newest.
        return tuple((values[i] is None, 0 if values[i] is None else values[i]) for i in self._order)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = tuple(self._newest.get()) if self._newest.exists() else None
        newest = before
        for row in rows:
            values = tuple(row[name] for name in self._schema.fieldNames())
            if newest is None or self._place(values) > self._place(newest):
                newest = values
        if newest != before:
            self._newest.update(newest)
            former = before if before is not None else (None,) * len(newest)
            yield Row(**dict(zip(self._out, (*key, *newest, before is not None, *former), strict=True)))

    def close(self) -> None:
        pass


def _former(name: str) -> str:
    return f"former_{name}"


def latest_changes(stream: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Stream of changes of the latest row per key, rows arriving in any order: the key, the
    new row, ``was_known``, and the former row as ``former_*``."""
    others = [field for field in stream.schema.fields if field.name not in key]
    state = T.StructType([T.StructField(f.name, f.dataType) for f in others])
    out = T.StructType(
        [T.StructField(k, stream.schema[k].dataType) for k in key]
        + state.fields
        + [T.StructField("was_known", T.BooleanType())]
        + [T.StructField(_former(f.name), f.dataType) for f in others]
    )
    ordered = stream.select(*key, *state.fieldNames())
    processor = LatestRow(out.fieldNames(), state, order_by)
    return ordered.groupBy(*key).transformWithState(processor, out, "Update", "None")


class LatestTable:
    """The latest row per key, and counts of keys per group, both fed by one stream.

    ``changes`` gets the changed keys of a micro-batch, ``counts`` one row for every group
    whose count the batch moved. Neither is ever rewritten.
    """

    def __init__(
        self, spark: SparkSession, root: str, key: Sequence[str], order_by: Sequence[str], group: str | None = None
    ) -> None:
        self._spark, self.root = spark, root.rstrip("/")
        self.key, self.order_by, self.group = list(key), list(order_by), group
        self._changes, self._counts = f"{self.root}/changes", f"{self.root}/counts"

    def feed(self, stream: DataFrame, every: str | None = None) -> StreamingQuery:
        changes = latest_changes(stream, self.key, self.order_by)

        def store(batch: DataFrame, batch_id: int) -> None:
            number = F.lit(batch_id).cast("long")
            columns = [c for c in batch.columns if c in stream.columns]
            batch.persist()
            overwrite_partitions(batch.select(*columns, number.alias("batch_id")), self._changes, "batch_id")
            if self.group is not None:
                moved = self._moved(batch).withColumn("batch_id", number)
                overwrite_partitions(moved, self._counts, "batch_id")
            batch.unpersist()

        writer = changes.writeStream.outputMode("update")
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint").foreachBatch(store)
        with _keyed_store(self._spark):
            return triggered(writer, every).start()

    def _moved(self, changes: DataFrame) -> DataFrame:
        """What a batch of changes adds to the count of every group: a key leaves its former
        group and enters its new one. A NULL is no key."""
        new = F.struct(F.col(self.group).alias("group"), F.lit(1).cast("long").alias("step"))
        old = F.struct(F.col(_former(self.group)).alias("group"), F.lit(-1).cast("long").alias("step"))
        steps = F.when(F.col("was_known"), F.array(new, old)).otherwise(F.array(new))
        named = changes.dropna(subset=self.key)
        moves = named.select(F.inline(steps)).groupBy("group").agg(F.sum("step").alias("step"))
        return moves.where(F.col("step") != 0)

    def read(self) -> DataFrame:
        """The latest rows."""
        changes = self._spark.read.parquet(self._changes)
        return latest_by_key(changes, self.key, self.order_by, exclude=["batch_id"])

    def counts(self, alias: str = "active_users") -> DataFrame:
        """Keys per group, from the counters alone."""
        steps = self._spark.read.parquet(self._counts)
        total = steps.groupBy(F.col("group").alias(self.group)).agg(F.sum("step").alias(alias))
        return total.where(F.col(alias) > 0)


# --- sessions ---------------------------------------------------------------------------


def merged(intervals: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, rows) with intervals that meet made one."""
    out: list[tuple[int, int, int]] = []
    for start, end, n in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2] + n)
        else:
            out.append((start, end, n))
    return out


class Intervals(StatefulProcessor):
    """List state per key: its sessions so far. Gives all of them when a batch changes them;
    a timer clears them once no row can come any more."""

    _STATE = "start long, end long, queries long"

    def __init__(self, out: Sequence[str], gap: int, length: int) -> None:
        self._out, self._gap, self._length = list(out), gap, length

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._known = handle.getListState("sessions", self._STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        known = [tuple(row) for row in self._known.get()] if self._known.exists() else []
        if not known:
            # The stretch is over when the watermark has passed its end.
            stretch = key[-2]
            self._handle.registerTimer(((stretch + 1) * self._length + self._gap) // 1000 + 1)
        now = merged([*known, *((row["_at"], row["_at"] + self._gap, 1) for row in rows)])
        self._known.put(now)
        for interval in now:
            yield Row(**dict(zip(self._out, (*key, *interval), strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._known.clear()
        return iter(())

    def close(self) -> None:
        pass


_MICROSECOND = timedelta(microseconds=1)


class SessionTable:
    """Sessions of a stream's rows per key, open ones included.

    A busy key is spread over sub-keys, by stretch of time and by a hash of the moment, each
    with intervals of its own in the state store. What is read back is merged in two steps:
    inside every stretch, and then, for the few sessions that reach the edge of one, across.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        gap: timedelta = timedelta(seconds=60),
        stretch: timedelta = timedelta(hours=6),
        shards: int = 8,
    ) -> None:
        self._spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self._gap, self._length, self._shards = gap // _MICROSECOND, stretch // _MICROSECOND, shards
        self._intervals = f"{self.root}/intervals"

    def feed(
        self, stream: DataFrame, ts_col: str, late: str = "1 hour", every: str | None = None
    ) -> StreamingQuery:
        timed = stream.withColumn("_ts", F.col(ts_col).cast("timestamp")).withWatermark("_ts", late)
        at = F.unix_micros("_ts")
        keyed = timed.where(F.col("_ts").isNotNull()).select(
            *self.keys,
            F.floor(at / self._length).alias("_stretch"),
            F.pmod(F.xxhash64(at), F.lit(self._shards)).cast("int").alias("_shard"),
            at.alias("_at"),
            "_ts",
        )
        state_key = [*self.keys, "_stretch", "_shard"]
        out = T.StructType(
            [T.StructField(k, keyed.schema[k].dataType) for k in state_key]
            + [T.StructField(c, T.LongType()) for c in ("_start", "_end", "queries")]
        )
        processor = Intervals(out.fieldNames(), self._gap, self._length)
        intervals = keyed.groupBy(*state_key).transformWithState(processor, out, "Update", "EventTime")

        def store(batch: DataFrame, batch_id: int) -> None:
            numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            overwrite_partitions(numbered, self._intervals, "batch_id")

        writer = intervals.writeStream.outputMode("update")
        writer = writer.option("checkpointLocation", f"{self.root}/checkpoint").foreachBatch(store)
        with _keyed_store(self._spark):
            return triggered(writer, every).start()

    def _joined(self, rows: DataFrame, within: Sequence[str]) -> DataFrame:
        """Intervals of the same ``within`` that meet as one."""
        by_start = Window.partitionBy(*within).orderBy("_start", "_end")
        before = by_start.rowsBetween(Window.unboundedPreceding, -1)
        opens = F.coalesce(F.col("_start") > F.max("_end").over(before), F.lit(True))
        numbered = rows.withColumn("_opens", opens.cast("int")).withColumn(
            "_session", F.sum("_opens").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
        )
        return numbered.groupBy(*within, "_session").agg(
            F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("queries").alias("queries")
        ).drop("_session")

    def read(self) -> DataFrame:
        stored = self._spark.read.parquet(self._intervals)
        key = [*self.keys, "_stretch", "_shard"]
        # A sub-key's batch holds all of its sessions: the last batch counts.
        newest = Window.partitionBy(*key).orderBy(F.desc("batch_id"))
        last = stored.withColumn("_rank", F.rank().over(newest)).where("_rank = 1")
        inside = self._joined(last, [*self.keys, "_stretch"])
        low = F.col("_stretch") * self._length
        edge = (F.col("_start") <= low + self._gap) | (F.col("_end") >= low + self._length)
        across = self._joined(inside.where(edge), self.keys)
        columns = [*self.keys, "_start", "_end", "queries"]
        every = inside.where(~edge).select(*columns).unionByName(across.select(*columns))

        def time(column: str) -> Column:
            return F.timestamp_micros(column).cast("timestamp_ntz")

        return every.select(
            *self.keys, time("_start").alias("window_start"), time("_end").alias("window_end"), "queries"
        )

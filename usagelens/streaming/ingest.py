"""Continuous ingest: file streams, landing tables, keyed event logs, latest-state tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from usagelens.functions.temporal import at
from usagelens.operators.incremental import incremental_window
from usagelens.operators.ordered import latest_by_key
from usagelens.sources.sinks import VersionedTable, overwrite_partitions, path_exists


def stream_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: dict[str, str] | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Stream of new Parquet files under ``path``; ``columns`` maps kept columns to names."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(path)
    if columns is None:
        return stream
    return stream.select(*[F.col(old).alias(new) for old, new in columns.items()])


def triggered(writer, every: str | None):
    """Process what is there and stop, or keep running on an interval."""
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def land(
    stream: DataFrame, location: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append the stream's rows as they are to a Parquet landing table."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer.format("parquet").option("path", location), every).start()


# Runs of backfills begin with this.
_BACKFILL = "backfill-"


class EventLog:
    """Append-only log of micro-batches with replace-by-key semantics on read.

    Storing a batch writes only the batch: a partition of its own run and number, overwritten
    as a whole, so a replayed batch leaves the log as it was and a second stream, or one with
    a new checkpoint, overwrites nothing. Reading keeps, per key, all rows of the batch stored
    last in which the key occurs, which is what deleting the batch's keys and inserting the
    batch would have left. ``VersionedTable.swap`` publishes a compacted copy.
    """

    _OWN = ("run", "batch_id", "stored_at")

    def __init__(self, spark: SparkSession, root: str, key: str):
        self._spark = spark
        self.root = root.rstrip("/")
        self.key = key
        self._data = f"{self.root}/log"
        self._marks = f"{self.root}/marks"
        self._cuts = f"{self.root}/cuts"

    def _read(self, path: str) -> DataFrame | None:
        """A table, or None before its first row: batches without rows leave no data file."""
        if not path_exists(self._spark, path):
            return None
        try:
            return self._spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return None

    def store(self, batch: DataFrame, batch_id: int, run: str = "direct", ts_col: str | None = None) -> None:
        """Write one batch; with ``ts_col`` also its newest time, to a table of one row a batch."""
        own = {
            "run": F.lit(run),
            "batch_id": F.lit(batch_id).cast("long"),
            "stored_at": F.lit(time.time_ns()).cast("long"),
        }
        overwrite_partitions(batch.withColumns(own), self._data, ["run", "batch_id"])
        if ts_col is not None:
            mark = batch.agg(F.max(ts_col).alias("newest")).withColumns(own)
            overwrite_partitions(mark, self._marks, ["run", "batch_id"])

    def newest(self, ts_col: str, run: str, batch_id: int) -> DataFrame | None:
        """Newest times of all batches but this one and later ones of its run, as ``ts_col``."""
        marks = self._read(self._marks)
        if marks is None:
            return None
        later = (F.col("run") == run) & (F.col("batch_id") >= batch_id)
        return marks.where(~later).select(F.col("newest").alias(ts_col))

    def backfill(self, batch: DataFrame, ts_col: str, start: datetime, end: datetime) -> None:
        """From now on the rows of ``[start, end)`` are those of ``batch``, beside any stream.

        What a stream stores of the range, before or after, stays hidden, also when it reads
        its overlap again; only a later backfill takes the range over. The rows of a backfill
        count once its cut is written, so one that fails half-way changes nothing.
        """
        inside = (F.col(ts_col) >= at(start)) & (F.col(ts_col) < at(end))
        run = f"{_BACKFILL}{uuid.uuid4().hex}"
        cut = self._spark.range(1).select(
            F.lit(time.time_ns()).cast("long").alias("cut_at"),
            at(start).alias("cut_from"),
            at(end).alias("cut_to"),
            F.lit(ts_col).alias("cut_column"),
            F.lit(run).alias("cut_run"),
        )
        self.store(batch.where(inside), 0, run)
        cut.write.mode("append").parquet(self._cuts)

    def current(self) -> DataFrame | None:
        log = self._read(self._data)
        if log is None:
            return None
        cuts = self._read(self._cuts)
        # One row per backfill.
        done = [] if cuts is None else sorted(cuts.collect(), key=lambda row: row.cut_at)
        published = [row.cut_run for row in done]
        log = log.where(~F.col("run").startswith(_BACKFILL) | F.col("run").isin(published))
        for place, row in enumerate(done):
            inside = (F.col(row.cut_column) >= at(row.cut_from)) & (F.col(row.cut_column) < at(row.cut_to))
            kept = F.col("run").isin(published[place:])
            log = log.where(~F.coalesce(inside, F.lit(False)) | kept)
        place = F.struct("stored_at", "run", "batch_id")
        newest = (
            log.where(F.col(self.key).isNotNull()).groupBy(self.key).agg(F.max(place).alias("_newest"))
        )
        kept = F.col(self.key).isNull() | (place == F.col("_newest"))
        columns = [c for c in log.columns if c not in self._OWN]
        return log.join(newest, self.key, "left").where(kept).select(*columns)


def _run_of(batch: DataFrame) -> str:
    """Id of the streaming query a micro-batch belongs to; it lives as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def ingest_events(
    stream: DataFrame,
    log: EventLog,
    ts_col: str,
    lookback: timedelta | None = timedelta(hours=6),
    every: str | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Keyed replace of pushed event files, batch by batch.

    With a ``lookback``, rows older than that before the newest row of the earlier batches
    are not loaded; that row is looked up in a table of one row per batch. ``None`` loads
    late rows whatever their age.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        run = _run_of(batch)
        if lookback is not None:
            # Earlier batches only: a replay must see the log as the first attempt did.
            marks = log.newest(ts_col, run, batch_id)
            batch = batch.where(incremental_window(marks, ts_col, lookback))
        log.store(batch, batch_id, run, ts_col)

    writer = stream.writeStream.option("checkpointLocation", checkpoint or f"{log.root}/checkpoint")
    return triggered(writer.foreachBatch(store), every).start()


def upsert_windows(
    aggregate: DataFrame, log: EventLog, keys: Sequence[str], every: str | None = None
) -> StreamingQuery:
    """Windowed counts as they stand, open windows included.

    Every micro-batch writes the windows it changed; ``log``, keyed by ``window_key``, keeps
    the last state of each.
    """
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])

    def store(batch: DataFrame, batch_id: int) -> None:
        log.store(batch.withColumn("window_key", key), batch_id, _run_of(batch))

    writer = aggregate.writeStream.outputMode("update").option(
        "checkpointLocation", f"{log.root}/checkpoint"
    )
    return triggered(writer.foreachBatch(store), every).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows a finished query dropped because they came behind the watermark."""
    return sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def refresh_latest(
    stream: DataFrame,
    table: VersionedTable,
    key: Sequence[str],
    order_by: Sequence[str],
    exclude: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Latest-state table kept by a stream; rows may arrive in any order.

    A batch replayed after a failure changes nothing, because the newest row per key wins
    whether or not it is already there.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = batch.drop(*exclude)
        known = table.read()
        everything = batch if known is None else known.unionByName(batch)
        table.swap(latest_by_key(everything, key, order_by))
        table.vacuum()

    writer = stream.writeStream.option("checkpointLocation", f"{table.root}/checkpoint")
    return triggered(writer.foreachBatch(merge), every).start()


def latest_state(stream: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The latest row per key as a streaming aggregate (update or complete mode)."""
    others = [c for c in stream.columns if c not in key]
    newest = F.max_by(F.struct(*others), F.struct(*order_by)).alias("_row")
    return stream.groupBy(*key).agg(newest).select(*key, "_row.*")

import os
import random
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from usagelens.operators.ordered import latest_by_key
from usagelens.session import scratch_path
from usagelens.sources.sinks import VersionedTable
from usagelens.streaming import ingest, keyed, windows

T0 = datetime(2024, 1, 1)
EVENTS = "event_id string, event_timestamp timestamp_ntz, v string"


def push(spark, folder, name, rows, schema=EVENTS):
    """One file per push, with a modification time that keeps the order."""
    target = f"{folder}/{name}"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(target)
    for i, file in enumerate(sorted(os.listdir(target))):
        os.utime(f"{target}/{file}", (1_700_000_000 + int(name) * 60, 1_700_000_000 + int(name) * 60))


def reader(spark, folder, schema=EVENTS):
    shape = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def at(hours):
    return T0 + timedelta(hours=hours)


def test_event_log_replaces_by_key(spark, rows):
    folder, root = scratch_path(spark, "push"), scratch_path(spark, "log")
    push(spark, folder, "1", [("a", at(0), "old"), ("b", at(10), "old"), ("b", at(10), "old2"), (None, at(9), "old")])
    push(spark, folder, "2", [("b", at(11), "new"), ("c", at(5), "new"), ("d", at(3), "too late"), (None, at(9), "new")])
    log = ingest.EventLog(spark, root, "event_id")
    ingest.ingest_events(reader(spark, folder), log, "event_timestamp").awaitTermination()
    expected = sorted([("a", "old"), ("b", "new"), ("c", "new"), (None, "old"), (None, "new")], key=repr)
    assert rows(log.current(), "event_id", "v") == expected
    push(spark, folder, "3", [("a", at(12), "newest")])
    ingest.ingest_events(reader(spark, folder), log, "event_timestamp").awaitTermination()
    assert ("a", "newest") in rows(log.current(), "event_id", "v")
    again = spark.createDataFrame([("a", at(12), "newest")], EVENTS)
    before = rows(log.current())
    log.store(again, 2)   # the same batch once more
    log.store(again, 2)
    assert rows(log.current()) == before


def test_event_log_survives_a_new_checkpoint(spark, rows):
    folder, root = scratch_path(spark, "push"), scratch_path(spark, "log")
    push(spark, folder, "1", [("a", at(1), "x"), ("b", at(2), "x")])
    log = ingest.EventLog(spark, root, "event_id")
    assert log.current() is None
    for name in ("one", "two"):
        stream = ingest.ingest_events(
            reader(spark, folder), log, "event_timestamp", timedelta(minutes=30), checkpoint=f"{root}/{name}"
        )
        stream.awaitTermination()
        assert rows(log.current(), "event_id", "v") == [("a", "x"), ("b", "x")]


def test_backfill_replaces_its_range_only(spark, rows):
    log = ingest.EventLog(spark, scratch_path(spark, "log"), "event_id")
    log.store(spark.createDataFrame([("a", at(1), "x"), ("b", at(5), "x"), ("c", at(9), "x"), (None, at(6), "x")], EVENTS), 0)
    log.backfill(spark.createDataFrame([("d", at(6), "new"), ("a", at(1), "outside")], EVENTS), "event_timestamp", at(5), at(8))
    assert rows(log.current(), "event_id", "v") == [("a", "x"), ("c", "x"), ("d", "new")]
    # What a stream stores of the range later, as by reading its overlap again, stays hidden.
    log.store(spark.createDataFrame([("b", at(5), "later"), ("d", at(6), "later"), ("c", at(9), "later")], EVENTS), 1)
    assert rows(log.current(), "event_id", "v") == [("a", "x"), ("c", "later"), ("d", "new")]
    # A later backfill takes over what it covers; one without its cut does not count.
    log.backfill(spark.createDataFrame([("e", at(7), "second")], EVENTS), "event_timestamp", at(6.5), at(9.5))
    assert rows(log.current(), "event_id", "v") == [("a", "x"), ("d", "new"), ("e", "second")]
    log.store(spark.createDataFrame([("f", at(7), "died")], EVENTS), 0, "backfill-died")
    assert rows(log.current(), "event_id", "v") == [("a", "x"), ("d", "new"), ("e", "second")]


def test_open_windows_are_kept_and_late_rows_counted(spark, rows):
    from usagelens.streaming import windows

    schema = "event_timestamp timestamp_ntz, user_name string, is_success string"
    folder, root = scratch_path(spark, "push"), scratch_path(spark, "windows")

    def load(name, *hours):
        data = [(at(h), "u", "NO") for h in hours]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(folder)
        log = ingest.EventLog(spark, root, "window_key")
        counts = windows.failed_logins(stream, n=1, window="1 hour")
        query = ingest.upsert_windows(counts, log, ["window_start", "user_name"])
        query.awaitTermination()
        return query, log.current()

    load("1", 0.1, 0.2, 5.5)
    query, now = load("2", 5.6, 6.1)
    assert rows(now, "window_start", "failures") == [(at(0), 2), (at(5), 2), (at(6), 1)]
    assert ingest.late_rows(query) == 0
    query, now = load("3", 0.3)
    assert ingest.late_rows(query) == 1 and rows(now, "failures") == [(1,), (2,), (2,)]


def test_event_log_without_lookback_keeps_late_rows(spark, rows):
    folder, root = scratch_path(spark, "push"), scratch_path(spark, "log")
    push(spark, folder, "1", [("a", at(100), "x")])
    push(spark, folder, "2", [("b", at(0), "late")])
    log = ingest.EventLog(spark, root, "event_id")
    ingest.ingest_events(reader(spark, folder), log, "event_timestamp", lookback=None).awaitTermination()
    assert rows(log.current(), "event_id") == [("a",), ("b",)]


def test_latest_table_resolves_out_of_order(spark, rows):
    folder = scratch_path(spark, "push")
    push(spark, folder, "1", [("a", at(5), "five"), ("b", at(1), "one")])
    push(spark, folder, "2", [("a", at(3), "three"), ("b", at(2), "two")])
    table = VersionedTable(spark, scratch_path(spark, "latest"))
    ingest.refresh_latest(reader(spark, folder), table, ["event_id"], ["event_timestamp"]).awaitTermination()
    everything = spark.read.option("recursiveFileLookup", True).parquet(folder)
    assert rows(table.read()) == rows(latest_by_key(everything, ["event_id"], ["event_timestamp"]))
    assert rows(table.read(), "event_id", "v") == [("a", "five"), ("b", "two")]


def test_latest_rows_and_counts_over_micro_batches(spark, rows):
    shape = "id long, grp string, at timestamp_ntz, amount decimal(12,2), big long"
    rng = random.Random(5)
    everything, folder = [], scratch_path(spark, "push")
    table = keyed.LatestTable(spark, scratch_path(spark, "latest"), ["id"], ["at", "big"], group="grp")
    for name in "123":
        batch = [
            (rng.choice([None, *range(12)]), rng.choice(["x", "y", None]), rng.choice([None, at(rng.randint(0, 50))] + [at(3)] * 3),
             Decimal(rng.randint(0, 999)) / 100, 2**60 + len(everything) + i)
            for i in range(40)
        ]
        everything += batch
        push(spark, folder, name, batch, shape)
        # The query goes on from its checkpoint, with the state of the former runs.
        table.feed(reader(spark, folder, shape)).awaitTermination()
        batch_rows = spark.createDataFrame(everything, shape)
        expected = latest_by_key(batch_rows, ["id"], ["at", "big"])
        assert rows(table.read(), *batch_rows.columns) == rows(expected)
        true = expected.where("id IS NOT NULL").groupBy("grp").agg(F.count("*").alias("active_users"))
        assert rows(table.counts()) == rows(true)


def test_latest_rows_written_once_per_change(spark, rows):
    folder, root = scratch_path(spark, "push"), scratch_path(spark, "latest")
    push(spark, folder, "1", [("a", at(5), "five"), ("b", at(1), "one")])
    push(spark, folder, "2", [("a", at(3), "three"), ("b", at(2), "two")])
    table = keyed.LatestTable(spark, root, ["event_id"], ["event_timestamp"])
    table.feed(reader(spark, folder)).awaitTermination()
    assert rows(spark.read.parquet(f"{root}/changes"), "event_id", "v", "batch_id") == [("a", "five", 0), ("b", "one", 0), ("b", "two", 1)]
    assert rows(table.read(), "event_id", "v") == [("a", "five"), ("b", "two")]


def sessions_of(times, gap=60):
    out = []
    for t in sorted(times):
        if out and t <= out[-1][1]:
            out[-1] = (out[-1][0], t + gap, out[-1][2] + 1)
        else:
            out.append((t, t + gap, 1))
    return out


def test_sessions_equal_batch_answer_with_open_ends(spark):
    shape = "warehouse_name string, start_time timestamp_ntz"
    rng, folder = random.Random(6), scratch_path(spark, "push")
    table = keyed.SessionTable(spark, scratch_path(spark, "sessions"), ["warehouse_name"], stretch=timedelta(minutes=10), shards=3)
    seconds = []
    for name in "123":
        # A burst that crosses stretches, and single starts; later files lie later but overlap.
        base = int(name) * 3000
        new = [("hot", base + rng.randint(0, 2500)) for _ in range(120)]
        new += [("hot", base + 100 + 50 * i) for i in range(30)] + [("cold", base + rng.randint(-600, 2500)) for _ in range(8)]
        seconds += new
        push(spark, folder, name, [(w, T0 + timedelta(seconds=t)) for w, t in new], shape)
        table.feed(reader(spark, folder, shape), "start_time").awaitTermination()
        got = sorted((r.warehouse_name, r.window_start, r.window_end, r.queries) for r in table.read().collect())
        expected = sorted(
            (w, T0 + timedelta(seconds=a), T0 + timedelta(seconds=b), n)
            for w in ("hot", "cold")
            for a, b, n in sessions_of([t for x, t in seconds if x == w])
        )
        assert got == expected


def test_intervals_that_meet_are_merged():
    assert keyed.merged([(5, 9, 1), (0, 5, 2), (10, 12, 1), (11, 11, 4)]) == [(0, 9, 3), (10, 12, 5)]


def test_latest_state_aggregate(spark, rows):
    folder = scratch_path(spark, "push")
    push(spark, folder, "1", [("a", at(5), "five"), ("b", at(1), "one")])
    push(spark, folder, "2", [("a", at(3), "three"), ("b", at(2), "two")])
    state = ingest.latest_state(reader(spark, folder), ["event_id"], ["event_timestamp"])
    running = state.writeStream.outputMode("complete").format("memory").queryName("latest_state_t").trigger(availableNow=True).start()
    running.awaitTermination()
    assert rows(spark.table("latest_state_t"), "event_id", "v") == [("a", "five"), ("b", "two")]


def test_hourly_volume_emits_closed_windows(spark):
    folder, out = scratch_path(spark, "push"), scratch_path(spark, "out")
    schema = "ts timestamp_ntz, t string, n long"
    push(spark, folder, "1", [(at(0.1), "A", 3), (at(0.9), "A", 4), (at(1.5), "A", 1), (at(6), "A", 9)], schema)
    stream = windows.hourly_volume(reader(spark, folder, schema), "ts", "t", "n")
    ingest.land(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{out}/data").orderBy("window_start").collect()
    assert [(r.window_start, r.total_rows_inserted, r.n_queries) for r in got] == [(at(0), 7, 2), (at(1), 1, 1)]


def test_column_subset_on_the_way_in(spark, rows):
    folder, out = scratch_path(spark, "push"), scratch_path(spark, "out")
    push(spark, folder, "1", [("a", at(1), "x")])
    shape = spark.createDataFrame([], EVENTS).schema
    stream = ingest.stream_events(spark, f"{folder}/1", shape, {"event_id": "id", "v": "value"})
    ingest.land(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    assert rows(spark.read.parquet(f"{out}/data")) == [("a", "x")]

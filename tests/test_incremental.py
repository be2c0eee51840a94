from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from usagelens.operators import incremental
from usagelens.plans import staging
from usagelens.session import scratch_path
from usagelens.sources.sinks import VersionedTable, overwrite_partitions

T0 = datetime(2024, 1, 1)


def test_delete_insert_keeps_batch_duplicates_and_null_keys(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old")], "id int, v string")
    batch = spark.createDataFrame([(2, "new"), (2, "new2"), (None, "new")], "id int, v string")
    once = incremental.delete_insert(target, batch, ["id"])
    assert rows(once) == sorted([(1, "old"), (None, "old"), (2, "new"), (2, "new2"), (None, "new")], key=repr)


def test_delete_insert_is_idempotent(spark, rows):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "id int, v string")
    batch = spark.createDataFrame([(2, "new"), (2, "new2"), (3, "new")], "id int, v string")
    once = incremental.delete_insert(target, batch, ["id"])
    assert rows(incremental.delete_insert(once, batch, ["id"])) == rows(once)


def test_upsert_takes_latest(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "id int, at int, v string")
    batch = spark.createDataFrame([(2, 5, "late"), (2, 3, "early"), (3, 1, "c")], "id int, at int, v string")
    assert rows(incremental.upsert(target, batch, ["id"], ["at"])) == [(1, 1, "a"), (2, 5, "late"), (3, 1, "c")]


def test_incremental_window_of_empty_target_is_first_run(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(days=9),)], "ts timestamp_ntz")
    for target in (None, df.limit(0)):
        wanted = incremental.incremental_window(target, "ts", timedelta(days=3), T0 + timedelta(days=1))
        assert df.where(wanted).count() == 1
        assert df.where(incremental.incremental_window(target, "ts", timedelta(days=3))).count() == 2
    assert df.where(incremental.incremental_window(df, "ts", timedelta(days=9))).count() == 2


def test_incremental_bound_reaches_the_scan(spark):
    path = scratch_path(spark, "pushed")
    spark.createDataFrame([(T0,), (T0 + timedelta(days=9),)], "ts timestamp_ntz").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.where(incremental.incremental_window(df, "ts", timedelta(days=3)))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-07" in plan


def test_cdc_apply_semantics(spark, rows):
    schema = "id int, v string, synced int, deleted boolean, at timestamp_ntz"
    day = lambda n: T0 + timedelta(days=n)
    target = spark.createDataFrame([(i, "old", 1, False, day(1)) for i in (1, 2, 3, 4, 5)], schema)
    landing = spark.createDataFrame(
        [
            (1, "stale", 9, True, day(0)),   # before the mark
            (2, "x", 2, True, day(2)), (2, "back", 3, False, day(2)),   # deleted, then restored
            (3, "y", 2, False, day(2)), (3, "y", 3, True, day(2)),      # ends deleted
            (4, "z", 2, None, day(2)),       # unknown flag changes nothing
            (6, "new", 1, False, day(3)), (7, "gone", 1, True, day(3)),
        ],
        schema,
    )
    merged = incremental.cdc_apply(target, landing, ["id"], ["synced"], "deleted", "at")
    assert rows(merged, "id", "v") == [(1, "old"), (2, "back"), (4, "old"), (5, "old"), (6, "new")]
    assert rows(incremental.cdc_apply(None, landing, ["id"], ["synced"], "deleted", "at"), "id") == [(2,), (6,)]


USERS = "user_id int, country string, plan string"


def snap(spark, history, data, day):
    current = spark.createDataFrame(data, USERS)
    return incremental.snapshot_check(history, current, "user_id", ["country", "plan"], T0 + timedelta(days=day))


def test_snapshot_versions(spark, rows):
    h = snap(spark, None, [(1, "CH", "a"), (2, "FR", None), (3, "DE", "a")], 0)
    h = snap(spark, h, [(1, "CH", "b"), (2, "FR", None), (4, "US", "a")], 1)
    again = snap(spark, h, [(1, "CH", "b"), (2, "FR", None), (4, "US", "a")], 2)
    assert rows(again) == rows(h)
    h = snap(spark, h, [(1, "CH", "a"), (2, "FR", "x"), (3, "DE", "a"), (4, "US", "a")], 3)
    got = {}
    for r in h.collect():
        got.setdefault(r.user_id, []).append((r.plan, r.valid_from.day, r.valid_to.day if r.valid_to else None))
    assert {k: sorted(v, key=lambda t: t[1]) for k, v in got.items()} == {
        1: [("a", 1, 2), ("b", 2, 4), ("a", 4, None)],
        2: [(None, 1, 4), ("x", 4, None)],
        3: [("a", 1, None)],
        4: [("a", 2, None)],
    }
    assert h.select("scd_id").distinct().count() == h.count()


def test_changed_keys(spark):
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, None)], "k int, v string")
    b = spark.createDataFrame([(2, "y"), (3, None), (4, "z")], "k int, v string")
    got = {r.k: r.change for r in incremental.changed_keys(a, b, "k", ["v"]).collect()}
    assert got == {1: "MISSING", 2: "CHANGED", 3: "SAME", 4: "NEW"}


def test_overwrite_partitions_touches_only_its_own(spark, rows):
    path = scratch_path(spark, "parts")
    overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, "p")
    mine = spark.read.parquet(path).where("p = 'b'").withColumn("v", F.col("v") * 10)
    overwrite_partitions(mine, path, "p")
    assert rows(spark.read.parquet(path)) == [(1, "a"), (20, "b")]


def test_microbatch_ranges():
    seen = []
    assert incremental.run_microbatches(lambda a, b: seen.append((a.day, b.day)), date(2024, 1, 1), date(2024, 1, 8), 3) == 3
    assert seen == [(1, 4), (4, 7), (7, 8)]


def test_versioned_table(spark, rows):
    table = VersionedTable(spark, scratch_path(spark, "versioned"))
    assert table.read() is None
    table.swap(spark.range(3))
    table.swap(table.read().withColumn("id", F.col("id") + 10))   # reads what it replaces
    assert rows(table.read()) == [(10,), (11,), (12,)]
    with pytest.raises(ValueError):
        table.swap(spark.range(1), validate=lambda df: df.count() > 5)
    assert table.read().count() == 3
    table.roll_back()
    assert rows(table.read()) == [(0,), (1,), (2,)]
    for n in (4, 5, 6):
        table.swap(spark.range(n))
    table.vacuum(keep=2)
    assert table.read().count() == 6
    table.roll_back()
    assert table.read().count() == 5
    table.roll_back()
    assert table.read() is None


def test_replace_range_keeps_null_times(spark, rows):
    target = spark.createDataFrame([(1, T0), (2, T0 + timedelta(days=1)), (3, None)], "id int, ts timestamp_ntz")
    batch = spark.createDataFrame([(9, T0 + timedelta(days=1)), (8, T0)], target.schema)
    got = incremental.replace_range(target, batch, "ts", T0 + timedelta(days=1), T0 + timedelta(days=2))
    assert rows(got, "id") == [(1,), (3,), (9,)]


def test_enforce_modes(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id int, amount int")
    rule = {"positive": F.col("amount") > 0}
    good, bad = incremental.enforce(df, rule, "quarantine")
    assert rows(good, "id") == [(1,), (3,)]
    assert [(r.id, r.violations) for r in bad.collect()] == [(2, ["positive"])]
    assert incremental.enforce(df, rule)[0].count() == 3
    with pytest.raises(incremental.ConstraintViolation, match="positive"):
        incremental.enforce(df, rule, "fail")
    assert incremental.enforce(df.where("id <> 2"), rule, "fail")[0].count() == 2


def test_staged_events_replace_by_lookback(spark, rows):
    schema = "value struct<event_id:string,customer_id:bigint,event_type:string,event_timestamp:timestamp_ntz,metadata:struct<channel:string,amount:decimal(10,2)>>"

    def event(key, hours, channel):
        return ((key, 1, "signup", T0 + timedelta(hours=hours), (channel, None)),)

    first = staging.stg_customer_events(spark.createDataFrame([event("a", 0, "old"), event("b", 10, "old")], schema))
    raw = spark.createDataFrame([event("a", 0, "new"), event("b", 10, "new"), event("c", 4, "new"), event("d", 3.9, "new")], schema)
    second = staging.stg_customer_events(raw, first)
    assert rows(second, "event_id", "channel") == [("a", "old"), ("b", "new"), ("c", "new")]


def test_snapshot_refuses_a_null_key(spark):
    from datetime import datetime

    rows = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    with pytest.raises(Exception, match="snapshot key k is NULL"):
        incremental.snapshot_check(None, rows, "k", ["v"], datetime(2024, 1, 1)).collect()

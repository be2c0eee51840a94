import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from usagelens.operators import ordered

SCHEMA = "key string, ts timestamp_ntz, id long, v long"


def skewed(spark, n=3000, seed=1):
    """One key holds a third of the rows, all at the same moment; NULL keys occur."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append(("hot", start, i, rng.randint(0, 9)))
        else:
            key = rng.choice(["a", "b", "c", None])
            ts = start + timedelta(seconds=rng.randint(0, 500))
            rows.append((key, ts, i, rng.choice([None, 1, 2])))
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def keyed():
    return Window.partitionBy("key").orderBy("ts", "id")


def same(one, other):
    return sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, other.collect()), key=repr)


@pytest.mark.parametrize("slices", [1, 2, 7, 40])
def test_lag_equals_plain_window(spark, slices):
    df = skewed(spark)
    cut = ordered.lag_by_key(df, ["key"], ["ts", "id"], "v", "prev", slices=slices)
    assert same(cut, df.withColumn("prev", F.lag("v").over(keyed())))


@pytest.mark.parametrize("slices", [1, 2, 13])
def test_running_sum_equals_plain_window(spark, slices):
    df = skewed(spark, seed=2)
    cut = ordered.running_sum(df, ["key"], ["ts", "id"], "v", "total", slices=slices)
    whole = keyed().rowsBetween(Window.unboundedPreceding, 0)
    assert same(cut, df.withColumn("total", F.sum("v").over(whole)))


def test_range_partitions_split_a_hot_key_evenly(spark):
    df = skewed(spark, 6000)
    laid = ordered.laid_out(df, ["key"], ["ts", "id"], 30)
    sizes = laid.groupBy("_slice").count()
    assert sizes.agg(F.max("count")).first()[0] < 6000 / 30 * 4
    assert laid.where("key = 'hot'").select("_slice").distinct().count() >= 8
    ends = laid.groupBy("_slice").agg(F.min(F.struct("key", "ts", "id")).alias("a"), F.max(F.struct("key", "ts", "id")).alias("b"))
    assert ends.alias("x").join(ends.alias("y"), F.expr("x._slice < y._slice AND x.b >= y.a")).isEmpty()


@pytest.mark.parametrize("operator", [ordered.lag_by_key, ordered.running_sum])
def test_windows_add_no_shuffle_of_the_rows(spark, operator):
    plan = operator(skewed(spark), ["key"], ["ts", "id"], "v", "out", slices=5)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # All shuffles left belong to the summary of one row per range partition.
    exchanges = [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert exchanges and all("_key" in line for line in exchanges), text
    assert "Bucketed: true" in text and "SelectedBucketsCount: 5 out of 5" in text


def test_empty_input(spark):
    empty = skewed(spark).limit(0)
    assert ordered.lag_by_key(empty, ["key"], ["ts", "id"], "v", "prev").collect() == []
    assert ordered.running_sum(empty, ["key"], ["ts", "id"], "v", "total").collect() == []
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("ordered_")]


def test_running_sum_with_peers(spark, rows):
    df = spark.createDataFrame([("c", 1, 10), ("c", 1, 5), ("c", 2, 1), ("d", 1, 7)], "k string, day int, v long")
    got = rows(ordered.running_sum_with_peers(df, ["k"], "day", "v", "total"), "k", "v", "total")
    assert got == [("c", 1, 16), ("c", 10, 15), ("c", 5, 15), ("d", 7, 7)]


def test_latest_by_key_limits_before_the_shuffle(spark):
    df = skewed(spark)
    latest = ordered.latest_by_key(df, ["key"], ["ts", "id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    best = {}
    for r in df.collect():
        if r.key not in best or (r.ts, r.id) > best[r.key][:2]:
            best[r.key] = (r.ts, r.id, r.v)
    assert {r.key: (r.ts, r.id, r.v) for r in latest.collect()} == best


def test_pages_of_any_depth(spark):
    df = spark.range(95).withColumn("ts", F.col("id") % 7)
    everything = df.orderBy(F.desc("ts"), F.desc("id")).collect()
    for number in (0, 3, 8, 9):
        for slices in (1, 30):
            found, pages = ordered.page(df, ["ts", "id"], number, slices=slices)
            assert pages == 10 and found.collect() == everything[number * 10 : number * 10 + 10]
    rising, _ = ordered.page(df, ["ts", "id"], 2, descending=False, slices=7)
    assert rising.collect() == everything[::-1][20:30]
    last, _ = ordered.page(df, ["ts", "id"], 9)
    assert last.count() == 5
    out_of_range, _ = ordered.page(df, ["ts", "id"], 10)
    assert out_of_range.collect() == ordered.page(df, ["ts", "id"], 0)[0].collect()
    assert ordered.page(df.limit(0), ["ts", "id"], 4)[1] == 1


@pytest.mark.parametrize("kind", ["decimal(12,2)", "decimal(38,9)", "int", "double"])
def test_running_sum_has_one_type_and_value_on_both_paths(spark, kind):
    rows = spark.range(400).select(
        (F.col("id") % 3).alias("k"),
        F.col("id").alias("o"),
        (F.col("id") * F.lit(1.123456789).cast("decimal(20,9)")).cast(kind).alias("v"),
    )
    whole = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumn("total", F.sum("v").over(whole))
    cut = ordered.running_sum(rows, ["k"], ["o"], "v", "total", slices=7)
    assert plain.schema["total"].dataType == cut.schema["total"].dataType
    if kind == "double":
        assert {r.o: round(r.total, 6) for r in plain.collect()} == {r.o: round(r.total, 6) for r in cut.collect()}
    else:
        assert {r.o: str(r.total) for r in plain.collect()} == {r.o: str(r.total) for r in cut.collect()}

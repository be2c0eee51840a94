from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from usagelens.operators import incremental, ordered
from usagelens.plans import access

FEW = settings(
    max_examples=4,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
T0 = datetime(2024, 1, 1)
STATE = st.dictionaries(st.integers(1, 5), st.sampled_from(["a", "b", None]), max_size=5)


@FEW
@given(states=st.lists(STATE, min_size=2, max_size=4))
def test_snapshot_invariants(spark, states):
    history = None
    for day, state in enumerate(states):
        current = spark.createDataFrame(list(state.items()), "user_id int, plan string")
        history = incremental.snapshot_check(history, current, "user_id", ["plan"], T0 + timedelta(days=day))
        rows = history.collect()
        history = spark.createDataFrame(rows, history.schema)
        versions = {}
        for r in rows:
            versions.setdefault(r.user_id, []).append(r)
        for key, found in versions.items():
            found.sort(key=lambda r: r.valid_from)
            assert [r.valid_to for r in found[:-1]] == [r.valid_from for r in found[1:]]
            assert found[-1].valid_to is None
        for key, plan in state.items():
            assert versions[key][-1].plan == plan


ROWS = st.lists(st.tuples(st.sampled_from(["h", "h", "h", "x", None]), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=60)


@FEW
@given(data=ROWS, slices=st.integers(2, 9))
def test_sliced_operators_equal_plain_ones(spark, data, slices):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(data)], "k string, t int, id int, v long")
    window = Window.partitionBy("k").orderBy("t", "id")
    whole = window.rowsBetween(Window.unboundedPreceding, 0)
    for operator, plain in ((ordered.lag_by_key, F.lag("v").over(window)), (ordered.running_sum, F.sum("v").over(whole))):
        cut = operator(df, ["k"], ["t", "id"], "v", "out", slices=slices)
        assert sorted(map(repr, df.withColumn("out", plain).collect())) == sorted(map(repr, cut.collect()))


LEVEL = st.sampled_from(["none", "select", "all"])
PLACES = [("U", d, e) for d in ("FINANCE", "HR") for e in ("DEV", "PROD")]


@FEW
@given(current=st.tuples(*[LEVEL] * 4), desired=st.tuples(*[LEVEL] * 4))
def test_applying_the_difference_gives_the_desired_levels(spark, current, desired):
    def frame(levels):
        return spark.createDataFrame([(*p, level) for p, level in zip(PLACES, levels)], "user string, domain string, env string, level string")

    changes = access.grant_changes(frame(current), frame(desired))
    applied = access.apply_changes(frame(current), changes)
    assert sorted(map(tuple, applied.collect())) == sorted(map(tuple, frame(desired).collect()))

import random
import re
from datetime import datetime, timedelta
from decimal import Decimal

from usagelens.plans import alerts, attribution

JAN = datetime(2024, 1, 5)


def metering(spark, *rows):
    data = [(w, ts, Decimal(c), Decimal(c)) for w, ts, c in rows]
    return spark.createDataFrame(
        data, "warehouse_name string, start_time timestamp_ntz, credits_used decimal(38,9), credits_used_compute decimal(38,9)"
    )


def config(spark):
    return spark.createDataFrame(
        [("A", "C1", Decimal("2"), Decimal("80"), True), ("B", "C1", None, Decimal("50"), True), ("C", "C2", Decimal("9"), None, False)],
        "warehouse_name string, cost_center_code string, credit_price_usd decimal(10,4), alert_threshold_pct decimal(5,2), is_active boolean",
    )


def centers(spark):
    return spark.createDataFrame(
        [("C1", "One", "D", Decimal("10"), True)],
        "cost_center_code string, cost_center_name string, department string, budget_monthly_credits decimal(12,2), is_active boolean",
    )


def test_cost_by_center(spark):
    used = metering(spark, ("A", JAN, "1"), ("A", JAN, "2"), ("B", JAN, "1"), ("C", JAN, "1"))
    got = {r.cost_center_code: (float(r.total_credits), float(r.total_cost_usd)) for r in attribution.cost_by_cost_center(used, config(spark), centers(spark)).collect()}
    assert got == {"C1": (4.0, 10.0), None: (1.0, 4.0)}


def test_budget_threshold(spark):
    def alert(credits):
        monthly = attribution.monthly_center_credits(metering(spark, ("A", JAN, credits)), config(spark).where("warehouse_name = 'A'"))
        return attribution.budget_alerts(monthly, centers(spark)).first().is_alert

    assert (alert("7.99"), alert("8")) == (False, True)


def rules(spark):
    return spark.createDataFrame(
        [("%team%", "D1", "C1", "p1", True), ("%team_x%", "D2", "C2", "p2", True), ("%team_y", "D3", "C3", "p3", True), ("%teamwork%", "D4", "C4", "p4", False)],
        "tag_pattern string, domain string, cost_center_code string, pipeline_name string, is_active boolean",
    )


def test_query_tags_by_anchors(spark):
    qh = spark.createDataFrame([("q1", "team-x"), ("q2", "a team"), ("q3", None), ("q4", "teamwork"), ("q5", "none"), ("q6", "team-x")], "query_id string, query_tag string")
    got = attribution.attribute_query_tags(qh, rules(spark))
    assert {r.query_id: r.rule_domain for r in got.collect()} == {"q1": "D2", "q2": "D1", "q3": None, "q4": "D1", "q5": None, "q6": "D2"}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    nothing = attribution.attribute_query_tags(qh, rules(spark).limit(0))
    assert nothing.count() == 6 and nothing.where("rule_domain is not null").count() == 0


def like(pattern, text):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += {"%": ".*", "_": "."}.get(c, re.escape(c))
        i += 1
    return re.fullmatch(out, text, re.DOTALL) is not None


def test_query_tags_equal_all_pairs(spark):
    rng = random.Random(4)
    tags = ["".join(rng.choice("ab%_\\x") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    patterns = sorted(
        {"".join(rng.choice(["a", "b", "ab", "%", "_", "\\%", "\\_", "\\\\", "xbaabax"]) for _ in range(rng.randint(1, 6))) for _ in range(400)}
        | {"%", "___", "_%", "", "%%%%"}
    )
    qh = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(tags)], "query_id string, query_tag string")
    config = spark.createDataFrame(
        [(p, f"D{i}", "C", "p", True) for i, p in enumerate(patterns)],
        "tag_pattern string, domain string, cost_center_code string, pipeline_name string, is_active boolean",
    )
    got = {r.query_tag: r.tag_pattern for r in attribution.attribute_query_tags(qh, config).collect()}
    for tag in tags:
        found = sorted((p for p in patterns if like(p, tag)), key=lambda p: (-len(p), p))
        assert got[tag] == (found[0] if found else None), tag


def test_patterns_that_share_a_long_literal(spark, monkeypatch):
    """Rules of one team differ in how they end: a tag meets those of its own ending, not the team's."""
    tags = spark.range(1000).selectExpr("concat('{\"team\":\"t1\"}/q', id) query_tag")
    patterns = spark.range(1, 400).selectExpr("id rank", "concat('%\"team\":\"t1\"}/%', id) tag_pattern")
    monkeypatch.setattr(attribution.F, "like", lambda text, pattern: attribution.F.lit(True))
    compared = attribution._anchored(patterns, tags).count()
    assert 399 <= compared <= 3 * 1000   # 399,000 with the team as anchor


def test_query_tags_with_anchors_dealt_out(spark, monkeypatch):
    """Neither patterns too many to send nor anchors that share a bucket change the result."""
    rng = random.Random(5)
    tags = sorted({"".join(rng.choice("ab/1") for _ in range(rng.randint(0, 9))) for _ in range(150)})
    patterns = sorted({"".join(rng.choice(["a", "b1", "/", "%", "_"]) for _ in range(rng.randint(1, 5))) for _ in range(150)})
    qh = spark.createDataFrame([(t, t) for t in tags], "query_id string, query_tag string")
    config = spark.createDataFrame(
        [(p, "D", "C", "p", True) for p in patterns],
        "tag_pattern string, domain string, cost_center_code string, pipeline_name string, is_active boolean",
    )
    monkeypatch.setattr(attribution, "SENT", 20)
    monkeypatch.setattr(attribution, "BUCKETS", 4)
    got = {r.query_tag: r.tag_pattern for r in attribution.attribute_query_tags(qh, config).collect()}
    for tag in tags:
        found = sorted((p for p in patterns if like(p, tag)), key=lambda p: (-len(p), p))
        assert got[tag] == (found[0] if found else None), tag


def test_credit_quota(spark, rows):
    used = metering(spark, ("A", JAN, "6"), ("A", JAN + timedelta(hours=3), "5"), ("B", JAN, "10"))
    assert rows(alerts.alert_credit_quota(used, 10), "warehouse_name") == [("A",)]


def test_zero_rows(spark, rows):
    as_of = datetime(2024, 1, 5, 12)
    qh = spark.createDataFrame(
        [("q1", as_of - timedelta(hours=1), 5), ("q2", as_of - timedelta(hours=1), 0), ("q3", as_of - timedelta(hours=5), 9)],
        "query_id string, start_time timestamp_ntz, rows_inserted long",
    )
    writes = spark.createDataFrame([(q, as_of - timedelta(hours=h), t) for q, h, t in (("q1", 1, "A"), ("q2", 1, "B"), ("q3", 5, "C"))], "query_id string, query_start_time timestamp_ntz, full_table_name string")
    assert rows(alerts.alert_zero_rows(qh, writes, as_of)) == [("B",), ("C",)]


LOGINS = "event_timestamp timestamp_ntz, user_name string, is_success string"


def test_failed_logins_across_a_window_edge(spark):
    rows = [(JAN + timedelta(seconds=s), "U", ok) for s, ok in ((290, "NO"), (295, "NO"), (305, "NO"), (310, "YES"), (700, "NO"))]
    got = alerts.alert_failed_logins(spark.createDataFrame([*rows, (None, "U", "NO")], LOGINS), n=3)
    assert [(r.window_start, r.window_end, r.failures) for r in got.collect()] == [
        (JAN + timedelta(seconds=5), JAN + timedelta(seconds=305), 3)
    ]


def test_failed_logins_equal_counting_by_hand(spark):
    rng = random.Random(2)
    rows = [(JAN + timedelta(seconds=rng.randint(0, 6000)), rng.choice("AAAB"), rng.choice(["NO", "NO", "YES"])) for _ in range(600)]
    expected = set()
    for user in "AB":
        at = [ts for ts, name, ok in rows if name == user and ok == "NO"]
        for ts in at:
            n = sum(timedelta() <= ts - other <= timedelta(minutes=1) for other in at)
            if n >= 4:
                expected.add((user, ts - timedelta(minutes=1), ts, n))
    for stretch in (1, 3, 1000):
        got = alerts.alert_failed_logins(spark.createDataFrame(rows, LOGINS), 4, timedelta(minutes=1), stretch)
        assert sorted(map(tuple, got.collect())) == sorted(expected)


def test_simple_limits(spark, rows):
    qh = spark.createDataFrame([("q", "W", "U", JAN, 10), ("r", "W", "U", JAN, 11)], "query_id string, warehouse_name string, user_name string, start_time timestamp_ntz, execution_time_seconds long")
    assert rows(alerts.alert_long_queries(qh, 10), "query_id") == [("r",)]
    tx = spark.createDataFrame([(1, Decimal("9.00")), (2, Decimal("9.01"))], "transaction_id int, transaction_amount_chf decimal(10,2)")
    assert rows(alerts.alert_large_transaction(tx, 9), "transaction_id") == [(2,)]
    total = alerts.serverless_cost_rollup({"X": metering(spark, ("A", JAN, "1"), ("A", JAN, "2")), "Y": metering(spark, ("A", JAN, "4"))})
    assert sorted((r.service, float(r.credits)) for r in total.collect()) == [("X", 3.0), ("Y", 4.0)]

from datetime import datetime

from pyspark.sql import functions as F

from usagelens.plans import access
from usagelens.plans.reports import audit_search

AS_OF = datetime(2024, 1, 31)


def held(spark, *pairs):
    return spark.createDataFrame(list(pairs), "user string, role string")


def levels_of(df, level_col="level"):
    return {(r.user, r.domain, r.env): r[level_col] for r in df.collect()}


def level_frame(spark, *rows):
    return spark.createDataFrame(list(rows), "user string, domain string, env string, level string")


def test_grant_levels(spark):
    roles = held(
        spark, ("A", "FIN_ADMIN_DEV"), ("A", "FIN_READER_DEV"), ("A", "HR_READER"), ("A", "MKT_ANALYST_UAT"),
        ("A", "FIN_ADMIN_DEV"), ("B", "HR_ADMIN"), ("B", "OTHER"),
    )
    users = spark.createDataFrame([("A",), ("B",), ("C",)], "user string")
    got = levels_of(access.domain_grant_levels(roles, users))
    assert len(got) == 3 * 8 * 3
    assert {k: v for k, v in got.items() if v != "none"} == {
        ("A", "FINANCE", "DEV"): "all", ("A", "HR", "PROD"): "select", ("B", "HR", "PROD"): "all",
    }
    active = access.active_domains(access.domain_grant_levels(roles, users))
    assert sorted(map(tuple, active.collect())) == [("A", "FINANCE"), ("A", "HR"), ("B", "HR")]


def all_transitions(spark):
    states = ["none", "select", "all"]
    pairs = [(a, b) for a in states for b in states]
    current = level_frame(spark, *[(f"U{i}", "FINANCE", "DEV", a) for i, (a, _) in enumerate(pairs)])
    desired = level_frame(spark, *[(f"U{i}", "FINANCE", "DEV", b) for i, (_, b) in enumerate(pairs)])
    return pairs, current, desired


def test_changes_statements_and_round_trip(spark):
    pairs, current, desired = all_transitions(spark)
    changes = access.grant_changes(current, desired)
    assert changes.count() == 6
    assert levels_of(access.apply_changes(current, changes)) == levels_of(desired)
    by_move = {
        (r.from_level, r.to_level): (r.change, r.role_assigned, r.comment) for r in changes.collect()
    }
    assert by_move[("none", "select")] == ("Add", "FIN_READER_DEV", "Add grants Reader on FIN_DEV.")
    assert by_move[("all", "none")] == ("Remove", "FIN_ADMIN_DEV", "Remove grants Admin on FIN_DEV.")
    assert by_move[("select", "all")] == ("Update", "FIN_ADMIN_DEV", "Update grants to Admin on FIN_DEV.")
    actions = {}
    for r in access.grant_statements(changes).orderBy("user", "step").collect():
        actions.setdefault(pairs[int(r.user[1:])], []).append(f"{r.action} {r.role}")
    assert actions[("none", "all")] == ["GRANT FIN_ADMIN_DEV", "GRANT FIN_WH_DEV_USER"]
    assert actions[("select", "all")] == ["REVOKE FIN_READER_DEV", "GRANT FIN_ADMIN_DEV"]
    assert actions[("select", "none")] == ["REVOKE FIN_READER_DEV", "REVOKE FIN_ANALYST_DEV", "REVOKE FIN_WH_DEV_USER"]


def test_changes_send_one_row_per_user_and_side(spark):
    users = [f"U{i}" for i in range(50)]
    places = [(d, e) for d in access.DOMAIN_PREFIXES for e in access.ENV_SUFFIXES]
    current = level_frame(spark, *[(u, d, e, "select") for u in users for d, e in places]).coalesce(1)
    desired = level_frame(spark, *[(u, d, e, "all") for u in users for d, e in places]).coalesce(1)
    changes = access.grant_changes(current, desired)
    assert changes.count() == 50 * 24
    plan = changes._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(user" in line for line in exchanges)
    assert plan.count("partial_bit_or") >= 2


def test_missing_places(spark):
    current = level_frame(spark, ("A", "HR", "PROD", "all"))
    desired = level_frame(spark, ("A", "FINANCE", "PROD", "select"))
    change = access.grant_changes(current, desired).collect()
    assert [(r.domain, r.from_level, r.comment) for r in change] == [("FINANCE", "none", "Add grants Reader on FIN.")]


def test_audit_rows(spark):
    _, current, desired = all_transitions(spark)
    updates = access.update_actions(access.grant_changes(current, desired), "OP", "SYSADMIN")
    log = access.audit_log_rows(updates, AS_OF)
    assert log.where("object_type = 'DATABASE'").count() == 6
    assert log.where("object_type = 'WAREHOUSE'").count() == 2   # only where access begins
    assert log.select("action_id").distinct().count() == 8
    created = access.audit_log_rows(access.create_actions(level_frame(spark, ("N", "RETAIL", "UAT", "all")), "OP", "R"), AS_OF)
    assert [(r.object_type, r.role_assigned, r.comment) for r in created.collect()] == [
        ("DATABASE", "RET_ADMIN_UAT", "Created user in RET UAT")
    ]
    people = spark.createDataFrame([("X",)], "user string")
    assert access.audit_log_rows(access.status_actions(people, False, "OP", "R"), AS_OF).count() == 0


def test_clone(spark, rows):
    levels = level_frame(spark, ("S", "HR", "DEV", "all"), ("S", "FINANCE", "DEV", "none"), ("T", "HR", "UAT", "all"))
    new = access.normalised_users(spark.createDataFrame([(" ann, bob ,",), ("ANN",)], "names string"), "names")
    assert rows(access.clone_access(levels, "S", new)) == [("ANN", "HR", "DEV", "all"), ("BOB", "HR", "DEV", "all")]
    assert access.clone_access(levels, "nobody", new).count() == 0
    assert access.created_user_count(access.clone_access(levels, "S", new)).first()[0] == 2


def test_effective_roles_with_cycle(spark, rows):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "role string, inherits string")
    got = rows(access.effective_roles(held(spark, ("U", "b"), ("V", "d")), edges))
    assert got == [("U", "a"), ("U", "b"), ("U", "c"), ("U", "d"), ("V", "d")]


def test_effective_roles_deal_users_before_keeping_rows(spark, rows, monkeypatch):
    """No task hashes the rows of its scan; tasks are as many as rows need; null roles stay."""
    edges = spark.createDataFrame([("a", "b"), ("b", "c")], "role string, inherits string")
    pairs = [(f"U{i}", role) for i in range(40) for role in ("a", "b", "alone", "a")] + [("N", None)]
    expected = sorted({(u, r) for u, _ in pairs[:-1] for r in ("a", "b", "c", "alone")} | {("N", None)}, key=repr)
    monkeypatch.setattr(access, "ROWS_PER_TASK", 20, raising=False)
    got = access.effective_roles(held(spark, *pairs), edges)
    assert rows(got) == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(user"):]
    assert "hashpartitioning(user#" in plan and "HashAggregate" not in below.split("BroadcastExchange")[0]
    # 40 users x (3 + 3 + 2 + 1) rows, and the one of N.
    assert f", {-(-361 // 20)}), REPARTITION_BY_NUM" in plan


def test_deep_chain(spark):
    edges = spark.createDataFrame([(f"r{i}", f"r{i + 1}") for i in range(12)], "role string, inherits string")
    assert access.effective_roles(held(spark, ("U", "r0")), edges).count() == 13


def test_row_filter(spark, rows):
    df = spark.createDataFrame([("FR",), ("US",), ("CH",), (None,)], "c string")
    assert access.row_filter_by_country(df, "c", {"SALES_FULL_ACCESS"}).count() == 4
    assert rows(access.row_filter_by_country(df, "c", {"SALES_READ_FR", "SALES_READ_US"})) == [("FR",), ("US",)]
    assert access.row_filter_by_country(df, "c", set()).count() == 0


def test_tag_values(spark, rows):
    tags = spark.createDataFrame(
        [("o1", "OWNER", "data_team"), ("o2", "OWNER", "x"), ("o3", "COST_CENTER", "any"), ("o4", "UNKNOWN", "y"), ("o5", "DOMAIN", None)],
        "object_name string, tag_name string, tag_value string",
    )
    assert rows(access.tag_value_violations(tags), "object_name") == [("o2",)]


def test_audit_search(spark):
    log = spark.range(25).select(
        F.col("id").alias("action_id"), F.lit("UPDATE_GRANTS").alias("action_type"), F.lit("U").alias("user_name"),
        F.lit("OP").alias("performed_by"), F.lit("R").alias("role_used"), F.lit("DEV").alias("env"), F.lit("HR").alias("domain"),
        F.col("id").cast("string").alias("role_assigned"), F.lit("DATABASE").alias("object_type"), F.lit("").alias("comment"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("action_timestamp"),
    )
    found, pages = audit_search(log, "U", env="DEV", page=2)
    assert pages == 3 and [r.role_assigned for r in found.collect()] == ["4", "3", "2", "1", "0"]
    assert audit_search(log, "U' OR '1'='1")[0].count() == 0


def test_levels_do_not_depend_on_the_block_size(spark, rows, monkeypatch):
    held = spark.createDataFrame(
        [("u", "FIN_ADMIN_DEV"), ("u", "MKT_READER_UAT"), ("v", "ANA_READER"), ("w", "NOBODY")], "user string, role string"
    )
    users = spark.createDataFrame([("u",), ("v",), ("w",), ("x",)], "user string")
    whole = rows(access.domain_grant_levels(held, users))
    monkeypatch.setattr(access, "PLACES_PER_BLOCK", 3)
    assert rows(access.domain_grant_levels(held, users)) == whole

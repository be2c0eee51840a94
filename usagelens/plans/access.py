"""Access grants: levels held, changes wanted, role actions and audit rows implied.

Nothing here executes a grant; operators emit rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.functions.temporal import at
from usagelens.functions.text import constant_rows, user_names
from usagelens.operators.ordered import broadcast_if_small
from usagelens.session import ensure_checkpoint_dir

# Business domains with their role prefix, environments with their role
# suffix (production objects carry none), and the values allowed for object tags.
DOMAIN_PREFIXES = {
    "FINANCE": "FIN",
    "MARKETING": "MKT",
    "ECOMMERCE": "ECO",
    "RETAIL": "RET",
    "LOYALTY": "LOY",
    "MANAGEMENT": "MGMT",
    "SALES": "SAL",
    "HR": "HR",
}
ENV_SUFFIXES = {"DEV": "_DEV", "UAT": "_UAT", "PROD": ""}
TAG_VALUES: dict[str, tuple[str, ...] | None] = {
    "OWNER": (
        "data_team",
        "analytics_team",
        "finance_team",
        "marketing_team",
        "ecommerce_team",
        "retail_team",
        "loyalty_team",
        "platform_team",
    ),
    "DOMAIN": (
        "finance",
        "marketing",
        "ecommerce",
        "retail",
        "analytics",
        "loyalty",
        "management",
    ),
    "COST_CENTER": None,
    "DATA_SENSITIVITY": ("PII", "PCI", "PHI", "NONE"),
    "DATA_CLASSIFICATION": ("CONFIDENTIAL", "INTERNAL", "PUBLIC"),
}

# Role actions per change of level: fixed values. Analyst and warehouse roles go when access ends.
_TRANSITIONS = {
    ("none", "select"): (("GRANT", "READER"), ("GRANT", "WAREHOUSE")),
    ("none", "all"): (("GRANT", "ADMIN"), ("GRANT", "WAREHOUSE")),
    ("select", "all"): (("REVOKE", "READER"), ("GRANT", "ADMIN")),
    ("all", "select"): (("REVOKE", "ADMIN"), ("GRANT", "READER")),
    ("select", "none"): (("REVOKE", "READER"), ("REVOKE", "ANALYST"), ("REVOKE", "WAREHOUSE")),
    ("all", "none"): (("REVOKE", "ADMIN"), ("REVOKE", "ANALYST"), ("REVOKE", "WAREHOUSE")),
}


def _lookup(mapping: Mapping[str, str], key: Column) -> Column:
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), key)


def role_name(domain: Column, env: Column, tier: str) -> Column:
    """Role of a tier (READER, ANALYST, ADMIN or WAREHOUSE) in a domain and environment."""
    prefix, suffix = _lookup(DOMAIN_PREFIXES, domain), _lookup(ENV_SUFFIXES, env)
    if tier == "WAREHOUSE":
        return F.concat(prefix, F.lit("_WH"), suffix, F.lit("_USER"))
    return F.concat(prefix, F.lit(f"_{tier}"), suffix)


# Bits of a long that stand for places.
PLACES_PER_BLOCK = 62


def _level_role(level: Column, domain: Column, env: Column) -> Column:
    return F.when(level == "select", role_name(domain, env, "READER")).otherwise(
        role_name(domain, env, "ADMIN")
    )


def _places(domains: Sequence[str]) -> list[tuple[int, int, str, str]]:
    """(block, bit, domain, environment) of every place."""
    combos = [(d, e) for d in domains for e in ENV_SUFFIXES]
    return [(i // PLACES_PER_BLOCK, 1 << i % PLACES_PER_BLOCK, *combo) for i, combo in enumerate(combos)]


def _per_block(places: list, bit: Column, name: str) -> Column:
    """Bits of a group's rows as one long per block, gathered with partial aggregation."""
    blocks = range(places[-1][0] + 1 if places else 0)
    gathered = [F.coalesce(F.bit_or(F.when(F.col("block") == b, bit)), F.lit(0)) for b in blocks]
    return F.array(*[bits.cast("long") for bits in gathered]).alias(name)


def _has(mask: str, place: Column | None = None) -> Column:
    block, bit = (F.col("block"), F.col("bit")) if place is None else (place["block"], place["bit"])
    return F.coalesce(F.get(mask, block), F.lit(0)).bitwiseAND(bit) != 0


def domain_grant_levels(
    user_roles: DataFrame, users: DataFrame, domains: Sequence[str] = tuple(DOMAIN_PREFIXES)
) -> DataFrame:
    """``all``, ``select`` or ``none`` for every user, domain and environment.

    A user's admin and reader roles become one bit per place, gathered with partial
    aggregation, so a user with very many grants sends two numbers per block of places to the
    shuffle. The places are then spelled out from a constant array.
    """
    places = _places(domains)
    known = [
        (f"{DOMAIN_PREFIXES[d]}_{tier}{ENV_SUFFIXES[e]}", block, bit * (tier == "ADMIN"), bit * (tier == "READER"))
        for block, bit, d, e in places
        for tier in ("ADMIN", "READER")
    ]
    # Two roles per place: a table of constant size.
    bits = user_roles.sparkSession.range(1).select(
        F.inline(constant_rows(["role", "block", "admin", "reader"], known))
    )
    masks = [_per_block(places, F.col(tier), tier) for tier in ("admin", "reader")]
    held = user_roles.join(F.broadcast(bits), "role").groupBy("user").agg(*masks)
    spelled = users.select("user").distinct().join(held, "user", "left").select(
        "user", "admin", "reader", F.inline(constant_rows(["block", "bit", "domain", "env"], places))
    )
    level = F.when(_has("admin"), "all").when(_has("reader"), "select").otherwise("none")
    return spelled.select("user", "domain", "env", level.alias("level"))


def _level_masks(levels: DataFrame, side: str) -> DataFrame:
    """One row per user: the bits of places with level ``all``, with ``select``, with any."""
    places = _places(tuple(DOMAIN_PREFIXES))
    # One row per place: a table of constant size.
    bits = levels.sparkSession.range(1).select(
        F.inline(constant_rows(["block", "bit", "domain", "env"], places))
    )
    level, bit = F.col("level"), F.col("bit")
    return (
        levels.join(F.broadcast(bits), ["domain", "env"])
        .groupBy("user")
        .agg(
            _per_block(places, F.when(level == "all", bit), f"{side}_all"),
            _per_block(places, F.when(level == "select", bit), f"{side}_select"),
            _per_block(places, bit, f"{side}_known"),
        )
    )


def grant_changes(current: DataFrame, desired: DataFrame) -> DataFrame:
    """Levels that differ between ``current`` and ``desired``.

    A place missing from ``current`` counts as ``none``; one missing from ``desired`` is
    left as it is. Of several levels of a user in one place the higher counts. Each side is
    one row of bit masks per user before the two meet; only the places whose bits differ are
    spelled out.
    """
    both = _level_masks(desired, "new").join(_level_masks(current, "old"), "user", "left")
    grid = constant_rows(["block", "bit", "domain", "env"], _places(tuple(DOMAIN_PREFIXES)))

    def of_block(mask: str, block: Column) -> Column:
        return F.coalesce(F.get(mask, block), F.lit(0).cast("long"))

    def differs(place: Column) -> Column:
        def moved(tier: str) -> Column:
            new, old = (of_block(f"{side}_{tier}", place["block"]) for side in ("new", "old"))
            return new.bitwiseXOR(old)

        changed = moved("all").bitwiseOR(moved("select"))
        return changed.bitwiseAND(of_block("new_known", place["block"])).bitwiseAND(place["bit"]) != 0

    masks = [f"{side}_{tier}" for side in ("new", "old") for tier in ("all", "select")]
    spelled = both.select("user", *masks, F.inline(F.filter(grid, differs)))

    def level(side: str) -> Column:
        return F.when(_has(f"{side}_all"), "all").when(_has(f"{side}_select"), "select").otherwise("none")

    moved = spelled.select(
        "user", "domain", "env", level("old").alias("from_level"), level("new").alias("to_level")
    )
    old, new = F.col("from_level"), F.col("to_level")
    domain, env = F.col("domain"), F.col("env")
    change = F.when(old == "none", "Add").when(new == "none", "Remove").otherwise("Update")
    lasting = F.when(new == "none", old).otherwise(new)
    # The words of the comment are fixed values.
    label = F.when(lasting == "select", "Reader").otherwise("Admin")
    verb = (
        F.when(old == "none", "Add grants ")
        .when(new == "none", "Remove grants ")
        .otherwise("Update grants to ")
    )
    tag = F.concat(_lookup(DOMAIN_PREFIXES, domain), _lookup(ENV_SUFFIXES, env))
    return moved.where(old != new).select(
        "user",
        "domain",
        "env",
        "from_level",
        "to_level",
        change.alias("change"),
        _level_role(lasting, domain, env).alias("role_assigned"),
        role_name(domain, env, "WAREHOUSE").alias("wh_role"),
        F.concat(verb, label, F.lit(" on "), tag, F.lit(".")).alias("comment"),
    )


def grant_statements(changes: DataFrame) -> DataFrame:
    """Ordered role actions implied by each change of level."""
    steps = F
    for (old, new), actions in _TRANSITIONS.items():
        listed = constant_rows(["action", "tier"], list(actions))
        happened = (F.col("from_level") == old) & (F.col("to_level") == new)
        steps = steps.when(happened, listed)
    prefix, suffix = F.col("prefix"), F.col("suffix")
    role = F.when(
        F.col("statement.tier") == "WAREHOUSE", F.concat(prefix, F.lit("_WH"), suffix, F.lit("_USER"))
    ).otherwise(F.concat(prefix, F.lit("_"), F.col("statement.tier"), suffix))
    return changes.select(
        "user",
        "domain",
        "env",
        _lookup(DOMAIN_PREFIXES, F.col("domain")).alias("prefix"),
        _lookup(ENV_SUFFIXES, F.col("env")).alias("suffix"),
        F.posexplode(steps).alias("step", "statement"),
    ).select("user", "domain", "env", "step", "statement.action", role.alias("role"))


def apply_changes(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Levels after the changes: applying ``grant_changes(cur, des)`` gives ``des``."""
    place = ["user", "domain", "env"]
    moved = changes.select(*place, F.col("to_level").alias("level"))
    return current.join(moved, place, "left_anti").select(*moved.columns).unionByName(moved)


def update_actions(changes: DataFrame, performed_by: str, role_used: str) -> DataFrame:
    """``UPDATE_GRANTS`` actions for the audit log."""
    return changes.select(
        F.lit("UPDATE_GRANTS").alias("action_type"),
        F.col("user").alias("user_name"),
        F.lit(performed_by).alias("performed_by"),
        F.lit(role_used).alias("role_used"),
        "env",
        "domain",
        "from_level",
        "to_level",
        "role_assigned",
        "wh_role",
        "comment",
    )


def create_actions(levels: DataFrame, performed_by: str, role_used: str) -> DataFrame:
    """``CREATE_USER`` actions for new users' levels. They record no change of level."""
    domain, env = F.col("domain"), F.col("env")
    return levels.where(F.col("level") != "none").select(
        F.lit("CREATE_USER").alias("action_type"),
        F.col("user").alias("user_name"),
        F.lit(performed_by).alias("performed_by"),
        F.lit(role_used).alias("role_used"),
        "env",
        "domain",
        F.lit(None).cast("string").alias("from_level"),
        F.lit(None).cast("string").alias("to_level"),
        _level_role(F.col("level"), domain, env).alias("role_assigned"),
        role_name(domain, env, "WAREHOUSE").alias("wh_role"),
        F.lit("").alias("comment"),
    )


def status_actions(users: DataFrame, enable: bool, performed_by: str, role_used: str) -> DataFrame:
    """Enabling or disabling a user carries no role, so it yields no audit row."""
    verb = "ENABLE" if enable else "DISABLE"
    text = F.concat(F.lit(f"{verb.capitalize()} user "), F.col("user"), F.lit("."))
    return users.select(
        F.lit(f"{verb}_USER").alias("action_type"),
        F.col("user").alias("user_name"),
        F.lit(performed_by).alias("performed_by"),
        F.lit(role_used).alias("role_used"),
        F.lit("ALL").alias("env"),
        F.lit("N/A").alias("domain"),
        F.lit(None).cast("string").alias("from_level"),
        F.lit(None).cast("string").alias("to_level"),
        F.lit("").alias("role_assigned"),
        F.lit("").alias("wh_role"),
        text.alias("comment"),
    )


def audit_log_rows(actions: DataFrame, as_of: datetime) -> DataFrame:
    """Audit rows: one for the database role, one for the warehouse role when access begins.

    A row without a role name is not written, so creating a user logs no warehouse row.
    """
    begins = (F.coalesce("from_level", F.lit("none")) == "none") & F.coalesce(
        F.col("to_level").isin("select", "all"), F.lit(False)
    )
    entry = F.array(
        F.struct(F.lit("DATABASE").alias("object_type"), F.col("role_assigned").alias("role")),
        F.struct(
            F.lit("WAREHOUSE").alias("object_type"),
            F.when(begins, F.col("wh_role")).alias("role"),
        ),
    )
    prefix = F.coalesce(_lookup(DOMAIN_PREFIXES, F.col("domain")), F.col("domain"))
    default = F.concat(F.lit("Created user in "), prefix, F.lit(" "), F.col("env"))
    given = F.coalesce("comment", F.lit(""))
    comment = F.when(F.trim(given) == "", default).otherwise(given)
    detail = F.to_json(
        F.struct(
            F.col("from_level").alias("from"),
            F.col("to_level").alias("to"),
            F.col("role_assigned").alias("role"),
            "wh_role",
        )
    )
    rows = (
        actions.withColumns({"comment": comment, "grants_detail": detail})
        .withColumn("entry", F.explode(entry))
        .where(F.coalesce(F.col("entry.role"), F.lit("")) != "")
    )
    natural_key = [
        "action_type", "user_name", "performed_by", "role_used", "env", "domain",
        F.col("entry.role"), F.col("entry.object_type"), "comment",
    ]
    # Fifteen hexadecimal digits fit a long, and any engine can compute them.
    text = F.concat_ws("|", *natural_key, F.lit(str(as_of)))
    action_id = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return rows.select(
        action_id.alias("action_id"),
        "action_type",
        "user_name",
        "performed_by",
        "role_used",
        "env",
        "domain",
        F.col("entry.role").alias("role_assigned"),
        F.col("entry.object_type").alias("object_type"),
        "grants_detail",
        "comment",
        at(as_of).alias("action_timestamp"),
    )


def normalised_users(lists: DataFrame, column: str) -> DataFrame:
    """One row per distinct name in comma-separated lists."""
    return lists.select(F.explode(user_names(F.col(column))).alias("user")).distinct()


def clone_access(levels: DataFrame, source_user: str, new_users: DataFrame) -> DataFrame:
    """The source user's levels for every new user.

    One user has at most domains x environments levels; these few become a constant that
    is spelled out per new user.
    """
    held = (
        levels.where((F.col("user") == source_user) & (F.col("level") != "none"))
        .select("domain", "env", "level")
        .distinct()
        .collect()
    )
    columns = ["domain", "env", "level"]
    if not held:
        return new_users.select("user", *[F.lit("").alias(c) for c in columns]).where(F.lit(False))
    return new_users.select("user", F.inline(constant_rows(columns, held)))


def active_domains(levels: DataFrame) -> DataFrame:
    return levels.where(F.col("level") != "none").select("user", "domain").distinct()


def created_user_count(rows: DataFrame) -> DataFrame:
    """Distinct users over the environments they were created in."""
    return rows.agg(F.count_distinct("user").alias("users"))


def role_closure(role_edges: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (role, inherited role), direct or not, of the roles in ``held``. Cycles are fine.

    A frontier search: each round extends the pairs found last by one edge and keeps the unseen
    ones. It starts from the held roles, so roles nobody holds cost nothing. A checkpoint per
    round keeps plans short and survives lost executors.
    """
    ensure_checkpoint_dir(role_edges.sparkSession)
    edges = role_edges.select("role", "inherits").distinct().checkpoint()
    steps = edges.select(F.col("role").alias("inherits"), F.col("inherits").alias("next"))
    seen = fresh = edges.join(held.select("role").distinct(), "role", "left_semi").checkpoint()
    while not fresh.isEmpty():
        reached = fresh.join(steps, "inherits").select("role", F.col("next").alias("inherits"))
        fresh = reached.distinct().join(seen, ["role", "inherits"], "left_anti").checkpoint()
        seen = seen.unionByName(fresh)
    return seen


# Rows of a task that makes users' roles distinct.
ROWS_PER_TASK = 1_500_000


def effective_roles(user_roles: DataFrame, role_edges: DataFrame) -> DataFrame:
    """Every role a user holds directly or through inheritance. Users come in last.

    They are dealt out before any of their rows is kept in memory, to as many tasks as the rows
    that follow need: a scan task, however much it reads, passes its rows on.
    """
    spark = user_roles.sparkSession
    ensure_checkpoint_dir(spark)
    held = user_roles.groupBy("role").agg(F.count("*").alias("rows")).checkpoint()
    itself = held.select("role", F.col("role").alias("inherits"))
    # A cycle leads back to the role itself.
    closure = role_closure(role_edges, held).unionByName(itself).distinct().checkpoint()
    width = closure.groupBy("role").agg(F.count("*").alias("width"))
    rows = F.sum(F.col("rows") * F.coalesce("width", F.lit(1)))
    expected = held.join(width, "role", "left").agg(rows).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = user_roles.select("user", "role").repartition(
        max(parts, math.ceil(expected / ROWS_PER_TASK)), "user"
    )
    inherited = dealt.join(broadcast_if_small(closure), "role", "left")
    return inherited.select("user", F.coalesce("inherits", "role").alias("role")).distinct()


def row_filter_by_country(df: DataFrame, column: str, roles: Iterable[str]) -> DataFrame:
    """Rows a session with these roles may see. Role tests fold into constants."""
    held, country = set(roles), F.col(column)
    if "SALES_FULL_ACCESS" in held:
        return df
    visible = [c for role, c in (("SALES_READ_FR", "FR"), ("SALES_READ_US", "US")) if role in held]
    return df.where(country.isin(visible)) if visible else df.where(F.lit(False))


def tag_value_violations(
    object_tags: DataFrame, allowed: Mapping[str, Sequence[str] | None] = TAG_VALUES
) -> DataFrame:
    """Object tags with a value outside the tag's list; tags without a list accept any."""
    broken = F.lit(False)
    for tag, values in allowed.items():
        if values is not None:
            broken = broken | (
                (F.col("tag_name") == tag) & ~F.col("tag_value").isin(list(values))
            )
    return object_tags.where(broken)

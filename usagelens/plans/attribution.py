"""Credits by cost center, budgets and query-tag rules.

The configuration tables come with a purpose but no model that reads them; these jobs are
our reading of that purpose.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from usagelens.functions.numeric import percentage
from usagelens.functions.temporal import trunc_date
from usagelens.functions.text import constant_rows
from usagelens.session import Settings, scratch_path


def _active(config: DataFrame) -> DataFrame:
    return config.where(F.coalesce("is_active", F.lit(True)))


def cost_by_cost_center(
    metering: DataFrame,
    wh_cfg: DataFrame,
    centers: DataFrame,
    cfg: Settings = Settings(),
) -> DataFrame:
    """Credits and cost per cost center, each warehouse at its own credit price."""
    used = metering.groupBy("warehouse_name").agg(F.sum("credits_used_compute").alias("credits"))
    config = _active(wh_cfg).select("warehouse_name", "cost_center_code", "credit_price_usd")
    price = F.coalesce("credit_price_usd", F.lit(cfg.credit_price_usd))
    priced = used.join(config, "warehouse_name", "left").select(
        "cost_center_code", "credits", (F.col("credits") * price).alias("cost")
    )
    per_center = priced.groupBy("cost_center_code").agg(
        F.sum("credits").alias("total_credits"), F.sum("cost").alias("total_cost_usd")
    )
    names = _active(centers).select("cost_center_code", "cost_center_name", "department")
    return per_center.join(names, "cost_center_code", "left").select(
        "cost_center_code", "cost_center_name", "department", "total_credits", "total_cost_usd"
    )


def monthly_center_credits(metering: DataFrame, wh_cfg: DataFrame) -> DataFrame:
    """Credits per cost center and month with the strictest alert threshold of its warehouses."""
    used = metering.groupBy(
        "warehouse_name", trunc_date("month", F.col("start_time")).alias("month")
    ).agg(F.sum("credits_used_compute").alias("credits"))
    config = _active(wh_cfg).select("warehouse_name", "cost_center_code", "alert_threshold_pct")
    return (
        used.join(config, "warehouse_name")
        .groupBy("cost_center_code", "month")
        .agg(
            F.sum("credits").alias("credits"),
            F.min(F.coalesce("alert_threshold_pct", F.lit(80.0))).alias("alert_threshold_pct"),
        )
    )


def budget_alerts(costs: DataFrame, centers: DataFrame) -> DataFrame:
    """Monthly credits against budget; flagged from the threshold share on."""
    budgets = _active(centers).select("cost_center_code", "budget_monthly_credits")
    used = percentage(F.col("credits"), F.col("budget_monthly_credits"))
    return costs.join(budgets, "cost_center_code").select(
        "cost_center_code",
        "month",
        "credits",
        "budget_monthly_credits",
        used.alias("budget_used_pct"),
        F.coalesce(used >= F.col("alert_threshold_pct"), F.lit(False)).alias("is_alert"),
    )


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for what reads it several times."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_RULE_FIELDS = ("tag_pattern", "rule_domain", "cost_center_code", "pipeline_name")


def _ranked_rules(rules: DataFrame) -> DataFrame:
    """One rule per pattern with ``rank``: the longer pattern first, then the alphabetical order.
    Numbers that grow, with gaps, so that the best of several is a plain minimum."""
    renamed = _active(rules).select(
        "tag_pattern", F.col("domain").alias("rule_domain"), "cost_center_code", "pipeline_name"
    )
    first = F.min(F.struct(*_RULE_FIELDS)).alias("rule")
    single = renamed.groupBy("tag_pattern").agg(first).select("rule.*")
    ordered = single.orderBy(F.char_length("tag_pattern").desc(), "tag_pattern")
    return ordered.withColumn("rank", F.monotonically_increasing_id())


# Runs of literal characters of a LIKE pattern, escaped ones included; the parts of one between
# its %, which are listed too; and what stands for one character of a tag.
_LITERALS = r"((?:[^%_\\]|\\.)+)"
_PARTS = r"((?:[^%\\]|\\.)+|%)"
_UNITS = r"(_|\\.|[^%_\\])"
# Characters of an anchor at most, hash buckets that anchors are counted in, and patterns that
# are sent to all tasks.
ANCHOR = 8
BUCKETS = 1 << 19
SENT = 1_000_000


def _plain(literal: Column) -> Column:
    return F.regexp_replace(literal, r"\\(.)", "$1")


def _key(place: Column, offset: Column, piece: Column) -> Column:
    return F.concat(place, offset.cast("string"), F.lit(":"), piece)


def _filed(patterns: DataFrame) -> DataFrame:
    """(tag_pattern, rank, place, offset, size, anchor): every anchor a pattern can be filed under.

    An anchor is a piece of the pattern's literals, of at most ``ANCHOR`` characters. What stands
    before the first % has a place counted from the tag's start (``^``), what stands after the
    last one a place counted from its end (``$``); any other piece stands somewhere (``*``).
    """
    parts = patterns.withColumn("parts", F.regexp_extract_all("tag_pattern", F.lit(_PARTS), 1))
    numbered = parts.select(
        "tag_pattern", "rank", F.size("parts").alias("n"), F.posexplode("parts").alias("i", "part")
    )
    part = F.col("part")
    longest = F.array_max(
        F.transform(
            F.regexp_extract_all(part, F.lit(_LITERALS), 1), lambda run: F.char_length(_plain(run))
        )
    )
    places = F.array_compact(
        F.array(
            F.when(F.col("i") == 0, "^"),
            F.when(F.col("i") == F.col("n") - 1, "$"),
            F.when((F.col("i") > 0) & (F.col("i") < F.col("n") - 1), "*"),
        )
    )
    # A part without literals has no longest run, and ``least`` would pass over the null.
    sized = numbered.select(
        "tag_pattern",
        "rank",
        F.regexp_extract_all(part, F.lit(_UNITS), 1).alias("units"),
        F.when(longest >= 1, F.least(longest, F.lit(ANCHOR))).alias("size"),
        F.explode(places).alias("place"),
    ).where((F.col("part") != "%") & F.col("size").isNotNull())
    starts = F.sequence(F.lit(0), F.size("units") - F.col("size"))
    pieces = sized.withColumn("start", F.explode(starts)).withColumn(
        "piece", F.slice("units", F.col("start") + 1, F.col("size"))
    )
    offset = (
        F.when(F.col("place") == "^", F.col("start"))
        .when(F.col("place") == "$", F.size("units") - F.col("start") - F.col("size"))
        .otherwise(0)
    )
    text = F.concat_ws("", F.transform("piece", _plain))
    return (
        pieces.where(~F.array_contains("piece", "_"))
        .select("tag_pattern", "rank", "place", offset.alias("offset"), "size", text.alias("text"))
        .withColumn("anchor", _key(F.col("place"), F.col("offset"), F.col("text")))
        .drop("text")
        .distinct()
    )


_SHAPE = ["place", "offset", "size"]


def _probes(tags: DataFrame, shapes: list) -> DataFrame:
    """(query_tag, anchor) of all anchors of these shapes that a tag holds."""
    if not shapes:
        return tags.select("query_tag", F.lit("").alias("anchor")).where(F.lit(False))
    place, offset, size = F.col("place"), F.col("offset").cast("int"), F.col("size").cast("int")
    last = F.char_length("query_tag") - offset - size + 1
    starts = (
        F.when(place == "^", F.array(offset + 1))
        .when(place == "$", F.array(last))
        .otherwise(F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
    )
    shaped = tags.select("query_tag", F.inline(constant_rows(_SHAPE, shapes))).where(last >= 1)
    return shaped.select("query_tag", *_SHAPE, F.explode(starts).alias("start")).select(
        "query_tag", _key(place, offset, F.substring("query_tag", F.col("start"), size)).alias("anchor")
    )


def _shapes(filed: DataFrame) -> list:
    """The distinct shapes of anchors with their patterns, fewest first. A shape is a place,
    an offset and a size: as many as patterns have lengths, not as there are patterns."""
    counted = filed.groupBy(*_SHAPE).agg(F.count("*").alias("patterns"))
    return sorted(counted.collect(), key=lambda row: (row["patterns"], *map(str, row)))


def _anchored(patterns: DataFrame, tags: DataFrame) -> DataFrame:
    """(query_tag, rank) of all matches of patterns with a literal character.

    Every pattern is filed under one of its anchors, the one fewest tags hold; tags are counted
    per bucket of anchor hashes, a bounded table. A tag looks up the anchors it holds and is
    compared with the patterns filed there only.
    """
    spark = tags.sparkSession
    filed = _kept(_filed(patterns), "filed")
    choice = F.count("*").over(Window.partitionBy("rank"))
    open_choice = filed.withColumn("anchors", choice).where("anchors > 1")
    bucket = F.pmod(F.xxhash64("anchor"), F.lit(BUCKETS))
    holders = (
        _probes(tags, [row[:3] for row in _shapes(open_choice)])
        .groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("tags"))
    )
    held = filed.withColumn("bucket", bucket).join(F.broadcast(holders), "bucket", "left")
    order = F.struct(F.coalesce("tags", F.lit(0)), -F.col("size"), "anchor")
    rarest = F.min_by(F.struct("tag_pattern", *_SHAPE, "anchor"), order).alias("rarest")
    anchors = _kept(held.groupBy("rank").agg(rarest).select("rank", "rarest.*"), "anchors")
    # Shapes of few patterns, whose anchors many tags hold, go to all tasks.
    sent, dealt, total = [], [], 0
    for row in _shapes(anchors):
        total += row["patterns"]
        (sent if total <= SENT else dealt).append(row[:3])
    found = []
    for shapes, hint in ((sent, F.broadcast), (dealt, lambda df: df)):
        if shapes:
            listed = spark.createDataFrame(shapes, anchors.select(*_SHAPE).schema)
            of_shapes = anchors.join(F.broadcast(listed), _SHAPE, "left_semi")
            here = hint(of_shapes.select("tag_pattern", "rank", "anchor"))
            found.append(_probes(tags, shapes).join(here, "anchor"))
    if not found:
        return patterns.select(F.lit("").alias("query_tag"), "rank").where(F.lit(False))
    matches = reduce(DataFrame.unionByName, found)
    return matches.where(F.like("query_tag", F.col("tag_pattern"))).select("query_tag", "rank")


def _by_length(patterns: DataFrame, tags: DataFrame) -> DataFrame:
    """(query_tag, rank): for every tag the best pattern of wildcards alone, which asks for its
    length only."""
    needed = F.char_length(F.regexp_replace("tag_pattern", "%", ""))
    wild = patterns.where(F.size(F.regexp_extract_all("tag_pattern", F.lit(_LITERALS), 1)) == 0)
    if wild.isEmpty():
        return wild.select(F.lit("").alias("query_tag"), "rank")
    longest = tags.agg(F.max(F.char_length("query_tag"))).first()[0] or 0
    lengths = F.when(
        F.contains("tag_pattern", F.lit("%")), F.sequence(needed, F.greatest(needed, F.lit(longest)))
    ).otherwise(F.array(needed))
    # A row per length of a tag at most.
    per_length = (
        wild.select("rank", F.explode(lengths).alias("_length"))
        .where(F.col("_length") <= longest)
        .groupBy("_length")
        .agg(F.min("rank").alias("rank"))
    )
    held = F.char_length("query_tag") == F.col("_length")
    return tags.join(F.broadcast(per_length), held).select("query_tag", "rank")


def _distinct_tags(qh: DataFrame) -> DataFrame:
    """Dealt out by whole rows first: a scan task that keeps the distinct tags of a large file
    would hold nearly all of them, and dealing by tag alone puts a common one into one task."""
    parts = int(qh.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [name for name, kind in qh.dtypes if "map<" not in kind and "variant" not in kind]
    dealt = qh.select("query_tag", F.xxhash64(*hashed).alias("_row")).repartition(parts, "_row")
    return dealt.where(F.col("query_tag").isNotNull()).select("query_tag").distinct()


def attribute_query_tags(qh: DataFrame, rules: DataFrame) -> DataFrame:
    """Domain, cost center and pipeline of the rule matching a query's tag.

    Of several matching rules the longest pattern wins, then the alphabetically first. The
    distinct tags are matched, whatever the number of rules, and the best rule of each is
    joined to the queries.
    """
    ranked = _kept(_ranked_rules(rules), "rules")
    patterns = ranked.select("tag_pattern", "rank")
    tags = _kept(_distinct_tags(qh), "tags")
    matches = _anchored(patterns, tags).unionByName(_by_length(patterns, tags))
    best = matches.groupBy("query_tag").agg(F.min("rank").alias("rank"))
    matched = best.join(ranked, "rank").drop("rank")
    return qh.join(matched, "query_tag", "left").select(*qh.columns, *_RULE_FIELDS)

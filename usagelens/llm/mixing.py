"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the mix in proportion to its weight. A source whose share would
repeat it more often than ``max_epochs`` is clamped there and the excess goes to the others
by weight, until no share is above its clamp. A source is then repeated whole as often as
its share allows, and the rest of the share is taken from its documents in an order seeded
by ``seed``; the last document of that order that is reached gives only the words missing.

Defined cases: a null text has no words; a null source is a source of its own and ranks
last; a null doc_id is ordered by its size alone; rows that repeat a doc_id are rows of
their own; an empty table gives an empty mix; other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from usagelens.llm.common import (
    ROW,
    checked,
    numbered,
    rows_of,
    stored,
    temporary,
    text_or_empty,
    with_rows,
)

# Weights given to the sources in code point order, over and over.
WEIGHTS = (3, 1, 2)
# Hex digits of the seeded hash that cut a source into buckets for the running sums.
BUCKET_DIGITS = 3


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    padded = F.concat(F.lit(" "), text_or_empty(text), F.lit(" "))
    return (F.size(F.split(padded, r"[ \t-\r]+")) - 2).cast("long")


def long(value: int) -> Column:
    return F.lit(value).cast("long")


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_pct: int = 150,
    max_epochs: int = 2,
) -> DataFrame:
    """(source, source_size, target) by water-filling; ``sizes`` has (source, size).

    One row per source is all that is ranked and clamped. Each round of the filling reads
    three sums; the clamped set only grows, so there are at most as many rounds as sources
    and in practice a handful.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast(
        "long"
    )
    table = stored(
        per_source.withColumn("weight", weight).withColumn(
            "cap", F.col("source_size") * F.lit(max_epochs)
        ),
        "mix-sources",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # The level is budget / (100 * weight left), as whole numbers so that no rounding decides.
    budget, left = total * share_pct, None
    while True:
        above = (
            F.lit(False)
            if left is None
            else F.col("cap") * long(100 * left) < F.col("weight") * long(budget)
        )
        row = table.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0)).alias("cap"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        after = (total * share_pct - 100 * (row["cap"] or 0), row["weight"] or 0)
        if after == (budget, left):
            break
        budget, left = after
        if not left:
            break
    if not left:
        target = F.col("cap").cast("double")
    else:
        target = F.when(
            F.col("cap") * long(100 * left) < F.col("weight") * long(budget),
            F.col("cap").cast("double"),
        ).otherwise((F.col("weight") * long(budget)).cast("double") / F.lit(float(100 * left)))
    return table.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share_pct: int = 150,
    max_epochs: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: (row, doc_id, source, size, source_size, target, taken, copies).

    ``taken`` counts the words the mix takes of the document, repeats included; ``copies``
    is the same in whole documents, the one cut document of a source rounded.

    Texts are read once. What is shuffled is one short row per document. The running sum of
    a source is cut into buckets of its seeded order, so a source that holds most of the
    rows is many tasks; only bucket sums are added up per source.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string")))
    sizes = stored(
        numbered(documents, "doc_id", "source", "text").select(
            "row", "doc_id", "source", word_count(F.col("text")).alias("size"), *rows_of(documents)
        ),
        "mix-sizes",
    )
    targets = checked(source_targets(sizes, weights, share_pct, max_epochs), 200)
    keyed = sizes.withColumn("key", key).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    in_source = Window.partitionBy("source").orderBy("bucket")
    before = (
        keyed.groupBy("source", "bucket")
        .agg(F.sum("size").alias("bucket_size"))
        .withColumn("before_bucket", F.sum("bucket_size").over(in_source) - F.col("bucket_size"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("k"), "before_bucket")
    )
    in_bucket = (
        Window.partitionBy("source", "bucket")
        .orderBy("key", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ordered = keyed.withColumn("inside", F.sum("size").over(in_bucket) - F.col("size"))
    ordered = ordered.join(
        before, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k"))
    ).drop("s", "k")
    ordered = ordered.join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s")
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    rest = F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("long")
    reached = F.col("rest") - F.col("before_bucket") - F.col("inside")
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), reached))
    return (
        ordered.withColumn("whole", whole.cast("long"))
        .withColumn("rest", rest)
        .withColumn("extra", extra)
        .select(
            "row",
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"),
            (
                F.col("whole")
                + F.when((F.col("size") > 0) & (F.col("extra") * 2 >= F.col("size")), 1).otherwise(0)
            )
            .cast("int")
            .alias("copies"),
            *rows_of(documents),
        )
    )


def mixed(documents: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as ``mix`` says, with all its columns.

    Documents and decisions meet by row number, which spreads any source evenly.
    """
    rows = with_rows(documents, "mix-rows")
    with temporary(documents.sparkSession) as keep:
        copies = mix(rows, **settings).filter("copies > 0")
        copies = keep(copies.select(*ROW, F.col("copies").alias("mix copies")), "mix-copies")
    repeated = rows.join(copies, ROW).withColumn(
        "mix copy", F.explode(F.sequence(F.lit(1), F.col("mix copies")))
    )
    return repeated.select(*documents.columns)

"""Line dedup by a segment-partition edit join.

Every line is cut into ``EDITS + 1`` segments. Two lines within ``EDITS`` edits share at
least one segment, at a place that their lengths and the segment's number bound, so a line
probes an index of (number, length, segment) with the few substrings that can match. What
meets is tested by letter counts, which an edit changes by two at most, and then by a banded
edit distance whose band is a bit vector.

A line is the text between line feeds without the white space around it. Lines of the same
text are equal whatever their length; lines of fewer than ``SHORTEST`` characters are linked
to equal lines only. Classes are the connected components of the links; a class keeps its
first line by (doc_id, row, line number), a null doc_id ranking last.

DataFrame functions only, no Python on the executors.

Defined cases: a null or empty text has no lines and blank lines are no lines; repeated rows
are rows of their own, whose lines are equal; an empty table gives no rows; other columns
are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.common import ROW, checked, components, numbered, rows_of, stored, text_or_empty, with_rows

EDITS, SHORTEST = 2, 20
# Letters whose counts are compared; four bits of each count are kept.
COUNTED = "entiaors"


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r\x0b\x0c"))


def split_lines(documents: DataFrame) -> DataFrame:
    """(row, doc_id, line_no, line, h1, h2): one row per line that is not blank."""
    lines = numbered(documents, "doc_id", "text").select(
        "row",
        "doc_id",
        *rows_of(documents),
        F.posexplode(F.split(text_or_empty("text"), "\n")).alias("line_no", "line"),
    ).withColumn("line", trimmed(F.col("line")))
    return lines.filter("line != ''").select(
        "row",
        "doc_id",
        *rows_of(documents),
        "line_no",
        "line",
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit("line"), "line").alias("h2"),
    )


def with_letters(lines: DataFrame) -> DataFrame:
    """``lines`` with ``letters``: four bits of the count of each letter.

    Each letter is taken out of what the last one left, so later steps read less.
    """
    out, last, counts = lines, "line", F.lit(0)
    for k, letter in enumerate(COUNTED):
        out = out.withColumn(f"left{k}", F.replace(F.col(last), F.lit(letter), F.lit("")))
        count = F.octet_length(last) - F.octet_length(f"left{k}")
        counts = counts.bitwiseOR(F.shiftleft(count.bitwiseAND(F.lit(15)), 4 * k))
        last = f"left{k}"
    return out.withColumn("letters", counts).drop(*(f"left{k}" for k in range(len(COUNTED))))


def counts_agree(a: Column, b: Column, edits: int) -> Column:
    """An edit brings one letter in and takes one out at most, so neither the gains nor the
    losses add up to more than ``edits``."""
    gains = losses = F.lit(0)
    for k in range(len(COUNTED)):
        gap = F.shiftright(a, 4 * k).bitwiseAND(F.lit(15)) - F.shiftright(b, 4 * k).bitwiseAND(F.lit(15))
        gap = (gap + 8).bitwiseAND(F.lit(15)) - 8
        gains, losses = gains + F.greatest(gap, F.lit(0)), losses + F.greatest(-gap, F.lit(0))
    return (gains <= edits) & (losses <= edits)


def segment(number: int, length: Column, edits: int) -> tuple[Column, Column]:
    """Start (from 1) and length of a line's segment; later segments take the remainder."""
    count = edits + 1
    base, longer = F.floor(length / count).cast("int"), (length % count).cast("int")
    start = number * base + F.greatest(F.lit(0), number - (count - longer)) + 1
    return start, base + (F.lit(number) >= count - longer).cast("int")


def segment_key(number: int, line: Column, length: Column, start: Column, size: Column) -> Column:
    """Hash of a segment's text. In an ASCII line, characters are bytes, which are cut without
    counting; bytes and text hash alike."""
    cut = F.when(
        F.octet_length(line) == F.col("n"), F.substring(line.cast("binary"), start, size)
    ).otherwise(F.substring(line, start, size).cast("binary"))
    return F.xxhash64(F.lit(number), length, cut)


def index_keys(line: Column, length: Column, edits: int) -> Column:
    keys = []
    for number in range(edits + 1):
        start, size = segment(number, length, edits)
        keys.append(segment_key(number, line, length, start, size))
    return F.array(*keys)


def probe_keys(line: Column, length: Column, edits: int) -> Column:
    """Keys of the substrings that can match a segment of a line ``0 .. edits`` shorter,
    other than the line's own segments, which match as index keys.

    Segment ``number`` may be shifted by as many places as segments lie before it, and, seen
    from the end, by as many as lie behind it.
    """
    keys = []
    for shorter in range(edits + 1):
        other = length - shorter
        for number in range(edits + 1):
            start, size = segment(number, other, edits)
            behind = edits - number
            for shift in range(max(-number, shorter - behind), min(number, shorter + behind) + 1):
                if shorter == shift == 0:
                    continue  # the line's own index key
                keys.append(segment_key(number, line, other, start + shift, size))
    return F.array(*keys)


def edit_distance(a: Column, b: Column, edits: int) -> Column:
    """Distance of two texts up to ``edits``, else null.

    Bit d of mask e says that the first j + d - edits characters of ``a`` are within e edits
    of the first j of ``b``. A character of ``b`` moves all masks at once.
    """
    width = (1 << (2 * edits + 1)) - 1

    def equal(x: Column, character: Column, j: Column) -> Column:
        out = F.lit(0)
        for d in range(2 * edits + 1):
            same = F.coalesce(F.get(x, j + (d - edits)) == character, F.lit(False))
            out = out.bitwiseOR(F.when(same, 1 << d).otherwise(0))
        return out

    def step(state: Column, same: Column) -> Column:
        masks: list[Column] = []
        for e in range(edits + 1):
            mask = state[f"e{e}"].bitwiseAND(same)
            if e:
                before = state[f"e{e - 1}"]
                mask = mask.bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))
                mask = mask.bitwiseOR(F.shiftleft(masks[-1], 1)).bitwiseAND(F.lit(width))
            masks.append(mask)
        return F.struct(*(m.alias(f"e{e}") for e, m in enumerate(masks)))

    first = F.struct(
        *(F.lit(((1 << (e + 1)) - 1) << edits).alias(f"e{e}") for e in range(edits + 1))
    )
    place = F.char_length(a) - F.char_length(b) + edits

    def reached(state: Column) -> Column:
        found = F.lit(None).cast("int")
        for e in range(edits, -1, -1):
            bit = F.getbit(state[f"e{e}"], F.greatest(F.lit(0), F.least(place, F.lit(31))))
            found = F.when(bit == 1, e).otherwise(found)
        return found

    # The one-element array binds the characters of ``a``, which are then split only once.
    masks = F.transform(
        F.array(F.split(a, "")),
        lambda x: F.transform(F.split(b, ""), lambda character, j: equal(x, character, j)),
    )[0]
    distance = F.aggregate(masks, first, step, reached)
    return F.when(F.abs(F.char_length(a) - F.char_length(b)) <= edits, distance)


def places_of(documents: DataFrame) -> DataFrame:
    """Stored (row, doc_id, line_no, h1, h2), one row per line."""
    places = split_lines(documents).select("row", "doc_id", *rows_of(documents), "line_no", "h1", "h2")
    return stored(places, "line-places")


def near_lines(documents: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """Stored links of different line texts within ``edits`` edits: (a, b, distance).

    A text is named by two hashes. Equal lines are combined before the shuffle, so a line of
    most documents is indexed once.
    """
    length = F.char_length("line")
    texts = split_lines(documents).select("line").filter(length >= shortest).distinct()
    prepared = with_letters(texts.withColumn("n", length)).withColumn("h1", F.xxhash64("line"))
    keys = prepared.select(
        "h1",
        "letters",
        F.posexplode(
            F.concat(
                index_keys(F.col("line"), F.col("n"), edits), probe_keys(F.col("line"), F.col("n"), edits)
            )
        ).alias("k", "key"),
    )
    # Index and probe rows go through one shuffle that both sides of the join read. The row
    # number keeps the filter of the index side from being moved below it, which would make
    # two shuffles of one.
    met = (
        keys.withColumn("indexed", F.col("k") <= edits)
        .drop("k")
        .repartition("key")
        .withColumn("number", F.monotonically_increasing_id())
    )
    pairs = stored(
        met.alias("x")
        .join(
            met.filter("indexed AND number >= 0").alias("y").hint("shuffle_hash"),
            (F.col("x.key") == F.col("y.key"))
            & (F.col("x.h1") != F.col("y.h1"))
            & (~F.col("x.indexed") | (F.col("x.h1") > F.col("y.h1")))
            & counts_agree(F.col("x.letters"), F.col("y.letters"), edits),
        )
        .select(F.greatest("x.h1", "y.h1").alias("a"), F.least("x.h1", "y.h1").alias("b"))
        .distinct(),
        "line-pairs",
    )
    names = stored(
        pairs.select(F.col("a").alias("h1")).union(pairs.select(F.col("b").alias("h1"))).distinct(),
        "line-names",
    )
    needed = stored(
        split_lines(documents)
        .join(checked(names, 16), "h1")
        .groupBy("h1", "h2")
        .agg(F.first("line").alias("line")),
        "line-texts",
    )
    name = F.concat(F.hex("h1"), F.lit("-"), F.hex("h2"))
    left = needed.select(F.col("h1").alias("a"), name.alias("name_a"), F.col("line").alias("line_a"))
    right = needed.select(F.col("h1").alias("b"), name.alias("name_b"), F.col("line").alias("line_b"))
    return stored(
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("distance", edit_distance(F.col("line_a"), F.col("line_b"), edits))
        .filter("distance IS NOT NULL")
        .select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), "distance"),
        "line-links",
    )


def line_classes(documents: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """One row per line: (row, doc_id, line_no, class_doc, class_line, kept, n_links).

    The class is named by the doc_id and number of its first line; ``n_links`` counts the
    different texts linked directly to the line's text.
    """
    occurrences = places_of(documents)
    links = near_lines(documents, edits, shortest)
    degree = (
        links.select("a").union(links.select("b")).groupBy(F.col("a").alias("name")).agg(
            F.count(F.lit(1)).alias("n_links")
        )
    )
    member = (
        components(links.select("a", "b"), "line-components")
        .withColumnRenamed("node", "name")
        .join(degree, "name")
        .withColumn("h1", F.conv(F.split_part("name", F.lit("-"), F.lit(1)), 16, -10).cast("long"))
        .withColumn("h2", F.conv(F.split_part("name", F.lit("-"), F.lit(2)), 16, -10).cast("long"))
        .drop("name")
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "line_no")
    texts = occurrences.groupBy("h1", "h2").agg(F.min(place).alias("first"))
    named = stored(texts.join(checked(stored(member, "line-members"), 80), ["h1", "h2"], "left"), "line-texts")
    merged = (
        named.filter("component IS NOT NULL")
        .groupBy("component")
        .agg(F.min("first").alias("class_first"))
    )
    classes = named.join(merged, "component", "left").select(
        "h1",
        "h2",
        F.coalesce("class_first", "first").alias("first"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
    return occurrences.join(classes, ["h1", "h2"]).select(
        "row",
        "doc_id",
        "line_no",
        F.col("first.doc_id").alias("class_doc"),
        F.col("first.line_no").alias("class_line"),
        ((F.col("row") == F.col("first.row")) & (F.col("line_no") == F.col("first.line_no"))).alias("kept"),
        "n_links",
        *rows_of(documents),
    )


def dedup_lines(documents: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """``documents`` without the lines that are not the first of their class.

    Blank lines stay.
    """
    rows = with_rows(documents, "line-rows")
    dropped = (
        line_classes(rows, edits, shortest)
        .filter("NOT kept")
        .groupBy(*ROW)
        .agg(F.collect_set("line_no").alias("line numbers"))
    )
    rest = F.filter(
        F.split("text", "\n"),
        lambda line, k: ~F.coalesce(F.array_contains("line numbers", k), F.lit(False)),
    )
    return (
        rows.join(dropped, ROW, "left")
        .withColumn("text", F.when(F.col("text").isNotNull(), F.array_join(rest, "\n")))
        .select(*documents.columns)
    )

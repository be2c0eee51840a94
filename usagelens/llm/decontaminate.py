"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (term, row, position) for every occurrence of a benchmark term in
the corpus. Lists of the rarest terms of a benchmark window are shifted by their offsets in
the item and intersected; where they meet, the remaining terms of the item are intersected
on the same diagonal, which gives the exact phrase matches. ``proximity_matches`` looks for
the same rare terms near each other in any order.

Words: A-Z are lower-cased, a word is a run of ASCII digits, letters and all characters
beyond ASCII. A window is ``WINDOW`` consecutive words of an item; a shorter item is one
window; an item without words has none.

Defined cases: a null or empty text has no words and no hits; rows that repeat a doc_id, or
have none, are rows of their own; benchmark rows that repeat an item_id are one item in the
counts; an item without an id still marks words but is not counted; an empty corpus or
benchmark gives no hits; other columns are left alone.
"""

from __future__ import annotations

from dataclasses import dataclass

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
    without,
)

WINDOW = 10
# Lists of so many rarest terms of a window are intersected before the rest is looked at.
RAREST = 2
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def padded_words(text: Column) -> Column:
    """Words of a text with an empty string before the first and after the last."""
    text = text_or_empty(text)
    lowered = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )
    return F.split(F.concat(F.lit(" "), lowered, F.lit(" ")), NO_WORD)


@dataclass
class Benchmark:
    """Stored pieces of a benchmark; all are proportional to its words."""

    terms: DataFrame  # item, p, term_id: one row per word, p from 0
    windows: DataFrame  # item, s, n
    vocabulary: DataFrame  # term, term_id
    names: DataFrame  # item, item_id


def read_benchmark(benchmark: DataFrame, window: int = WINDOW) -> Benchmark:
    items = stored(
        benchmark.select(
            F.monotonically_increasing_id().alias("item"),
            "item_id",
            F.filter(padded_words(F.col("text")), lambda w: w != "").alias("words"),
        ),
        "bench-items",
    )
    words = items.select("item", F.posexplode("words").alias("p", "term"))
    vocabulary = stored(
        words.select("term").distinct().withColumn("term_id", F.monotonically_increasing_id()),
        "bench-terms",
    )
    n = F.least(F.size("words"), F.lit(window))
    windows = items.filter(F.size("words") > 0).select(
        "item", F.explode(F.sequence(F.lit(0), F.size("words") - n)).alias("s"), n.alias("n")
    )
    return Benchmark(
        stored(words.join(vocabulary, "term").select("item", "p", "term_id"), "bench-words"),
        stored(windows, "bench-windows"),
        vocabulary,
        items.select("item", "item_id"),
    )


def build_index(documents: DataFrame, bench: Benchmark) -> DataFrame:
    """Stored postings (term_id, row, pos, doc_id), sharded as the documents are read.

    ``pos`` counts words from 1. ``row`` numbers the documents. Every document also has one
    posting without a term: its ``pos`` is the number of its words and it alone carries the
    doc_id. Texts are read once and postings are written where they arise, without a shuffle.
    """
    rows = numbered(documents, "doc_id", "text")
    carried = ["doc_id", *rows_of(rows)]
    words = rows.select("row", *carried, padded_words(F.col("text")).alias("w")).select(
        "row", *carried, F.posexplode("w").alias("pos", "term")
    )
    lookup = checked(bench.vocabulary, 100)
    # One pass: the end marks pass the outer join without a term, other unknown words drop out.
    joined = words.filter("term != '' OR pos > 0").join(lookup, "term", "left")
    end = F.col("term") == ""
    return stored(
        joined.filter(F.col("term_id").isNotNull() | end).select(
            "term_id",
            "row",
            (F.col("pos") - end.cast("int")).alias("pos"),
            *(F.when(end, F.col(c)).alias(c) for c in carried),
        ),
        "postings",
    )


def rarest_terms(index: DataFrame, bench: Benchmark, rarest: int = RAREST) -> DataFrame:
    """(item, s, p, term_id, need): the rarest terms of every window by corpus frequency."""
    frequency = index.filter("term_id IS NOT NULL").groupBy("term_id").agg(
        F.count(F.lit(1)).alias("f")
    )
    covered = bench.windows.select(
        "item", "s", "n", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("p")
    )
    place = Window.partitionBy("item", "s").orderBy("f", "p")
    return stored(
        covered.join(bench.terms, ["item", "p"])
        .join(frequency, "term_id", "left")
        .withColumn("f", F.coalesce("f", F.lit(0)))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= rarest)
        .select("item", "s", "p", "term_id", F.least("n", F.lit(rarest)).alias("need")),
        "bench-rarest",
    )


def phrase_matches(index: DataFrame, bench: Benchmark, rarest: int = RAREST) -> DataFrame:
    """Stored occurrences of windows: (row, item, s, n, start)."""
    anchors = rarest_terms(index, bench, rarest)
    lists = anchors.select("term_id", "item", "p", "need").distinct()
    diagonal = F.col("pos") - F.col("p")
    meetings = stored(
        index.join(checked(stored(lists, "bench-lists"), 40), "term_id")
        .groupBy("row", "item", diagonal.alias("diagonal"))
        .agg(F.count(F.lit(1)).alias("met"), F.max("need").alias("need"))
        .filter("met >= need")
        .select("row", "item", "diagonal"),
        "meetings",
    )
    rows = checked(stored(meetings.select("row").distinct(), "meeting-rows"), 16)
    near = index.filter("term_id IS NOT NULL").join(rows, "row", "left_semi")
    # What must stand where if the item lies on the diagonal: a text that repeats a passage has
    # as many diagonals as repeats, and each asks for the item's words only.
    expected = stored(
        meetings.join(checked(bench.terms, 40), "item").select(
            "row", "item", "diagonal", "p", "term_id", (F.col("diagonal") + F.col("p")).alias("pos")
        ),
        "bench-expected",
    )
    there = near.join(checked(expected, 48), ["row", "pos", "term_id"]).select("row", "item", "diagonal", "p")
    covered = bench.windows.select(
        "item", "s", "n", F.explode(F.sequence(F.col("s"), F.col("s") + F.col("n") - 1)).alias("p")
    )
    covered = checked(stored(covered, "bench-covered"), 40)
    return stored(
        there.join(covered, ["item", "p"])
        .groupBy("row", "item", "diagonal", "s", "n")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter("found = n")
        .select("row", "item", "s", "n", (F.col("diagonal") + F.col("s")).alias("start")),
        "phrases",
    )


def proximity_matches(
    index: DataFrame, bench: Benchmark, span: int = 20, rarest: int = 3
) -> DataFrame:
    """(row, item, s): all rarest terms of a window within ``span`` words, in any order.

    Positions are cut into stretches of ``span`` words and each posting goes to its own
    stretch and the one before, so a match lies whole in one stretch pair.
    """
    anchors = rarest_terms(index, bench, rarest)
    kinds = anchors.groupBy("item", "s").agg(F.countDistinct("term_id").alias("kinds"))
    wanted = anchors.select("term_id", "item", "s").distinct().join(kinds, ["item", "s"])
    stretch = F.floor(F.col("pos") / span)
    hits = index.join(checked(stored(wanted, "bench-near"), 40), "term_id").withColumn(
        "stretch", F.explode(F.array(stretch, stretch - 1))
    )
    found = (
        hits.groupBy("row", "item", "s", "stretch", "kinds")
        .agg(F.collect_set(F.struct("pos", "term_id")).alias("at"))
        .filter(F.size("at") >= F.col("kinds"))
    )

    def complete(first: Column) -> Column:
        inside = F.filter(
            "at", lambda y: (y["pos"] >= first["pos"]) & (y["pos"] < first["pos"] + span)
        )
        return F.size(F.array_distinct(F.transform(inside, lambda y: y["term_id"]))) == F.col("kinds")

    return found.filter(F.exists("at", complete)).select("row", "item", "s").distinct()


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: (row, doc_id, n_words, n_hit, items).

    ``n_hit`` counts the words inside any occurrence of a window, ``items`` is the sorted
    list of the items, as strings, that have one.
    """
    bench = read_benchmark(benchmark, window)
    index = build_index(documents, bench)
    phrases = phrase_matches(index, bench)
    hit = (
        phrases.select("row", "start", "n")
        .distinct()
        .select("row", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos"))
        .distinct()
        .groupBy("row")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    items = (
        phrases.select("row", "item")
        .distinct()
        .join(checked(bench.names, 40), "item")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    )
    ends = index.filter("term_id IS NULL").select(
        "row", "doc_id", F.col("pos").cast("long").alias("n_words"), *rows_of(index)
    )
    return (
        ends.join(hit, "row", "left")
        .join(items, "row", "left")
        .select(
            "row",
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            *rows_of(index),
        )
    )


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without an occurrence of a benchmark window, with all their columns."""
    rows = with_rows(documents, "decontaminate-rows")
    with temporary(documents.sparkSession) as keep:
        hit = contamination(rows, benchmark, window).filter("n_hit > 0").select(*ROW)
        hit = keep(hit, "contaminated")
    return without(rows, hit, documents.columns)

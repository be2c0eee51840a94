import re
import time

from usagelens.llm import decontaminate
from .texts import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(len(v), decontaminate.WINDOW)
        for s in range(len(v) - n + 1) if v else ():
            for p in range(len(w) - n + 1):
                if w[p : p + n] == v[s : s + n]:
                    hit.update(range(p, p + n))
                    found.add(item_id)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def test_contamination_equals_brute_force(spark, hostile, benchmark_table, nothing):
    extra = [
        (30, "Éa éa x " + " ".join(prose(1, 60).split()[12:25]), "en", "a"),
        (31, " ".join(prose(1, 60).split()[12:21]), "en", "a"),
        (32, (" ".join(prose(2, 40).split()[:12]) + ", ") * 3, "en", "a"),
    ]
    docs = hostile.select("doc_id", "text", "lang", "source").union(
        spark.createDataFrame(extra, "doc_id long, text string, lang string, source string")
    )
    items = [(r["item_id"], r["text"]) for r in benchmark_table.collect()]
    got = decontaminate.contamination(docs, benchmark_table).collect()
    true = sorted(map(repr, (brute(r["text"], items) for r in docs.collect())))
    assert sorted(repr((r["n_words"], r["n_hit"], r["items"])) for r in got) == true
    assert decontaminate.contamination(nothing, benchmark_table).collect() == []
    none = decontaminate.contamination(docs, benchmark_table.filter("false")).collect()
    assert len(none) == docs.count() and not any(r["n_hit"] for r in none)


def test_clean_keeps_columns_and_clean_documents(hostile, benchmark_table):
    out = decontaminate.clean(hostile, benchmark_table)
    assert out.columns == hostile.columns
    kept = sorted((r["doc_id"] or -1) for r in out.collect())
    assert kept == [-1, 3, 4, 5, 7, 8, 9, 10, 11]


def test_proximity_finds_the_rare_terms_in_any_order(spark):
    docs = spark.createDataFrame(
        [
            (0, "alpha of the beta and the gamma"),
            (1, "gamma x x beta y y y alpha"),
            (2, "alpha " + "x " * 60 + "beta gamma"),
            (3, "beta gamma"),
        ],
        "doc_id long, text string",
    ).coalesce(1)
    bench = decontaminate.read_benchmark(
        spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    )
    index = decontaminate.build_index(docs, bench)
    names = {r["row"]: r["doc_id"] for r in index.filter("term_id IS NULL").collect()}
    near = decontaminate.proximity_matches(index, bench, span=10)
    assert sorted(names[r["row"]] for r in near.collect()) == [0, 1]


def test_index_keeps_benchmark_terms_only(hostile, benchmark_table):
    bench = decontaminate.read_benchmark(benchmark_table)
    index = decontaminate.build_index(hostile, bench)
    assert index.filter("term_id IS NULL").count() == hostile.count()
    assert index.select("term_id").filter("term_id IS NOT NULL").distinct().count() <= bench.vocabulary.count()


def test_a_long_text_of_one_word_or_passage_costs_its_length(spark):
    passage = " ".join(f"w{k % 4}" for k in range(16))
    docs = spark.createDataFrame(
        [(1, "same " * 100_000), (2, (passage + " ") * 3_000), (3, "other words")], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(7, "same " * 12), (8, passage)], "item_id long, text string")
    start = time.perf_counter()
    rows = decontaminate.contamination(docs, bench).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == [
        (100_000, 100_000, ["7"]), (48_000, 48_000, ["8"]), (2, 0, [])
    ]
    assert time.perf_counter() - start < 120

import importlib.util

from usagelens.llm import compression, decontaminate, minhash, mixing, toxicity
from usagelens.llm.common import stored
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(names, key=lambda n: int(n[2:])) == [f"op{n}" for n in range(1, 14)]
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert importlib.util.find_spec("corpus_pipeline")


def test_stages_in_order_and_their_decisions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "tokens"]
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF), f"test-{name}"))
        if name != "tokens":
            assert tables[-1].columns == docs.columns
    ids = [[r["doc_id"] for r in t.select("doc_id").collect()] for t in tables[:-1]]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    learn = ~compression.held_out(F.col("doc_id"), 4, 2)
    scored = toxicity.score(docs, toxicity.fit(docs, labels, learn), ["doc_id"]).collect()
    assert sorted(ids[1]) == sorted(r["doc_id"] for r in scored if r["score"] < toxicity.PREDICT_FROM)
    assert sorted(ids[2]) == sorted(r["doc_id"] for r in minhash.near_duplicates(tables[1]).filter("kept").collect())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = decontaminate.contamination(tables[2], bench).filter("n_hit = 0").collect()
    assert sorted(ids[3]) == sorted(r["doc_id"] for r in clean)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(tables[3]).collect()}
    assert sorted(ids[4]) == sorted(i for i, n in copies.items() for _ in range(n))
    written = {i for r in tables[5].collect() for i in r["doc_ids"]}
    assert written == set(ids[4])


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_toxic_stage_against_held_out_labels(spark):
    large = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{large}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, large).select("doc_id").distinct()
    toxic = spark.read.parquet(f"{large}/labels.parquet").filter("toxic = 1")
    judged = docs.filter(compression.held_out(F.col("doc_id"), 4, 2)).join(toxic, "doc_id")
    per_lang = {r["lang"]: r["count"] for r in judged.groupBy("lang").count().collect()}
    left = {r["lang"]: r["count"] for r in judged.join(kept, "doc_id").groupBy("lang").count().collect()}
    print("held-out toxic documents", per_lang, "left in the corpus", left)
    assert set(per_lang) == {"en", "fr", "de", "es"}
    assert all(left.get(lang, 0) <= 0.5 * n for lang, n in per_lang.items())

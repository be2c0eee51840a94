import numpy as np
import pytest

from usagelens.llm import shards


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64, 1000, 4097])
def test_permutation_is_one_to_one(size):
    slots = shards.permuted(np.arange(size), size)
    assert sorted(slots.tolist()) == list(range(size))
    other = shards.permuted(np.arange(size), size, key=1)
    assert size < 17 or (slots != other).any()


def written(spark, docs, folder, **settings):
    return shards.write_shards(docs, str(folder), shards.read_vocabulary(), **settings).collect()


def test_round_trip_of_hostile_rows(spark, hostile, tmp_path):
    rows = written(spark, hostile, tmp_path, sequence=64, per_shard=16)
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    sequences = list(shards.read_sequences(str(tmp_path)))
    assert len(sequences) == len(rows) and all(len(s) == 64 for s in sequences)
    stream = np.concatenate([sequences[r["slot"]] for r in sorted(rows, key=lambda r: r["sequence"])])
    stream = stream[: sum(r["n_tokens"] for r in rows)]
    texts, decode = [], shards.encoding(shards.read_vocabulary()).decode
    for part in np.split(stream, np.flatnonzero(stream == shards.END) + 1)[:-1]:
        texts.append(decode(part[:-1].tolist()))
    assert sorted(texts) == sorted(r["text"] or "" for r in hostile.collect())


def test_reading_resumes_and_places_agree(spark, hostile, tmp_path):
    import zlib

    rows = {r["slot"]: r for r in written(spark, hostile, tmp_path, sequence=32, per_shard=8)}
    rest = list(shards.read_sequences(str(tmp_path), 21))
    assert len(rest) == len(rows) - 21
    for slot in (0, 7, 8, 21, len(rows) - 1):
        row = rows[slot]
        data = (tmp_path / f"shard-{row['shard']:06d}.bin").read_bytes()
        piece = data[row["byte_offset"] : row["byte_offset"] + 64]
        assert zlib.crc32(piece) == row["crc32"]
        if slot >= 21:
            assert piece == rest[slot - 21].tobytes()


def test_same_input_gives_the_same_files(spark, hostile, tmp_path):
    for name in ("x", "y"):
        written(spark, hostile, tmp_path / name, sequence=64, per_shard=16)
    x, y = (sorted(p for p in (tmp_path / n).iterdir() if p.name.endswith(".bin")) for n in ("x", "y"))
    assert [p.name for p in x] == [p.name for p in y]
    assert all(a.read_bytes() == b.read_bytes() for a, b in zip(x, y, strict=True))
    assert not [p for p in (tmp_path / "x").iterdir() if p.name.startswith(".shard") and "crc" not in p.name]


def test_order_does_not_depend_on_how_files_are_cut(spark, tmp_path):
    docs = spark.createDataFrame(
        [(k, f"document {k} " * (k % 40)) for k in range(4000)], "doc_id long, text string"
    )
    path = str(tmp_path / "docs")
    docs.repartition(3, "doc_id").write.option("parquet.block.size", "16384").parquet(path)
    name, found = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    for size in ("64m", "20k"):
        spark.conf.set(name, size)
        read = spark.read.parquet(path)
        rows = written(spark, read, tmp_path / size, sequence=64, per_shard=16)
        found.append((read.rdd.getNumPartitions(), sorted((r["slot"], r["crc32"], r["doc_ids"]) for r in rows)))
    spark.conf.set(name, before)
    assert found[0][0] < found[1][0] and found[0][1] == found[1][1]


def test_ids_of_text_and_ranges_of_shards(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(f"id-{k}", "some words " * 20) for k in range(60)] + [(None, "x")], "doc_id string, text string")
    monkeypatch.setattr(shards, "TASK_SHARDS", 3)
    rows = written(spark, docs, tmp_path, sequence=32, per_shard=4)
    assert {i for r in rows for i in r["doc_ids"]} == {f"id-{k}" for k in range(60)}
    assert len({r["shard"] for r in rows}) > 12 and len(list(shards.read_sequences(str(tmp_path)))) == len(rows)


def test_empty_table(spark, nothing, tmp_path):
    assert written(spark, nothing, tmp_path) == []
    assert list(shards.read_sequences(str(tmp_path))) == []

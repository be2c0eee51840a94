"""Token shards in training order.

Documents are tokenised and laid end to end in the order of files and of the rows in them,
each followed by the end mark; the stream is
cut into sequences of a fixed length, the last one filled up with end marks. A keyed Feistel
permutation with cycle-walking gives every sequence a global slot, and range partitions of
the slots write shards of a fixed stride: slot s lies in shard ``s // per_shard`` at byte
``(s % per_shard) * stride``. A reader can stop at a slot and go on from it.

Texts are tokenised once; the tokens are stored, the number of sequences follows from one
sum per stretch of rows read together, and only the cut sequences are shuffled, once, compressed. A shard is written to a
name of its own attempt and then moved, so a repeated task leaves the same file.

Defined cases: a null or empty text gives its end mark alone; rows that repeat a doc_id, or
have none, are documents of their own; an empty table gives no sequence and no shard; other
columns are left alone. Texts that spell a special token are ordinary text.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from usagelens.llm import compression
from usagelens.llm.common import ROW, checked, small_batches, with_rows
from usagelens.session import scratch_path

# Split pattern of the byte-level vocabulary: a fixed value.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
VOCABULARY, END = "/opt/tokenizers/byte_bpe_50k.tiktoken", 50256
SEQUENCE, PER_SHARD = 2048, 4096
KEY, ROUNDS = 20240131, 6
# Starts of so many documents train the dictionary that packs the pieces for the shuffle.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 600, 8192, 112640
# Shards a task writes at most, one after the other.
TASK_SHARDS = 64
PIECE = ["shard", "slot", "number", "at", "doc_ids", "piece"]
MANIFEST = ["slot", "shard", "byte_offset", "sequence", "n_tokens", "doc_ids", "crc32"]


@lru_cache(maxsize=2)
def encoding(vocabulary: bytes):
    """Tokenizer of a rank file's content; built once per Python process."""
    import tiktoken

    ranks = {
        base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())
    }
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def permuted(index: np.ndarray, size: int, key: int = KEY) -> np.ndarray:
    """A keyed permutation of ``range(size)``, applied to ``index``.

    A balanced Feistel network over the smallest even number of bits that covers ``size``;
    what falls outside is sent round again until it falls inside, at most four times on
    average.
    """
    half = np.uint64(max(1, ((max(2, size) - 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for number in range(ROUNDS):
            salt = np.uint64((key * 0x9E3779B97F4A7C15 + number * 0xC2B2AE3D27D4EB4F) % 2**64)
            mixed = (right + salt) * np.uint64(0xFF51AFD7ED558CCD)
            mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(29))) & mask)
        return (left << half) | right

    out = once(index.astype(np.uint64))
    while (outside := out >= np.uint64(size)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def id_kind(documents: DataFrame) -> str:
    """Type of the ids in manifests: whole numbers stay whole numbers, all else is text."""
    whole = documents.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    return "long" if whole else "string"


def tokenised(documents: DataFrame, vocabulary: bytes, end: int = END) -> DataFrame:
    """Stored (file, first, start, n, doc_id, tokens): the stream as little-endian 16-bit ids.

    Documents are read in stretches, rows of one file that follow each other; ``file`` and
    ``first`` (the stretch's first row in it) name one, and ``start`` is the document's place
    among its tokens.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoding(vocabulary).encode_ordinary
        file = first = before = None
        start = 0
        for batch in batches:
            # Small steps bound the memory of a batch of long texts.
            for at in range(0, len(batch), 256):
                rows = batch.iloc[at : at + 256]
                tokens, places = [], []
                for text, where, row in zip(rows.text, rows[ROW[0]], rows[ROW[1]], strict=True):
                    tokens.append(np.array([*(encode(text) if text else ()), end], "<u2"))
                    if where != file or row != before + 1:
                        file, first, start = where, row, 0
                    places.append((file, first, start))
                    start, before = start + len(tokens[-1]), row
                out = pd.DataFrame(places, columns=["file", "first", "start"])
                out["n"] = [len(t) for t in tokens]
                out["doc_id"] = rows.doc_id.to_numpy()
                out["tokens"] = [t.tobytes() for t in tokens]
                yield out

    source = with_rows(documents, "shard-rows").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", *ROW
    )
    stream = source.mapInPandas(
        run, "file long, first long, start long, n long, doc_id string, tokens binary"
    )
    spark = documents.sparkSession
    path = scratch_path(spark, "tokens")
    written = stream.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "9")
    with small_batches(spark):
        written.option("parquet.page.size", str(8 << 20)).parquet(path)
    return spark.read.schema(stream.schema).parquet(path)


def stretch_starts(tokens: DataFrame) -> tuple[DataFrame, int]:
    """(file, first, base) and the number of tokens, in the order of files and rows, however
    the files were cut for reading. One sum per stretch."""
    sums = sorted(
        (row["file"], row["first"], row["n"])
        for row in tokens.groupBy("file", "first").agg(F.sum("n").alias("n")).collect()
    )
    total, bases = 0, []
    for file, first, n in sums:
        bases.append((file, first, total))
        total += n
    return tokens.sparkSession.createDataFrame(bases, "file long, first long, base long"), total


def write_shards(
    documents: DataFrame,
    folder: str,
    vocabulary: bytes,
    sequence: int = SEQUENCE,
    per_shard: int = PER_SHARD,
    key: int = KEY,
    end: int = END,
) -> DataFrame:
    """Write the shards to ``folder`` and return the stored manifest, one row per sequence:
    (slot, shard, byte_offset, sequence, n_tokens, doc_ids, crc32).

    ``n_tokens`` leaves the filling out; ``doc_ids`` are the documents with a token in the
    sequence, in stream order, a missing id left out; ``crc32`` is of the sequence's bytes.
    """
    spark = documents.sparkSession
    tokens = tokenised(documents, vocabulary, end)
    bases, total = stretch_starts(tokens)
    count, stride = -(-total // sequence), 2 * sequence
    shards = -(-count // per_shard)
    # A task writes a range of shards: as many tasks as other shuffles have, more once a task
    # would have to write more than TASK_SHARDS.
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    range_size = max(1, min(TASK_SHARDS, -(-shards // max(1, usual))))
    kind = id_kind(documents)
    as_id = int if kind == "long" else str

    samples = [bytes(r[0]) for r in tokens.select(F.substring("tokens", 1, SAMPLE_BYTES)).limit(SAMPLES).collect()]
    words = compression.train(samples, DICTIONARY_BYTES)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = compression.compressor(words, dict(compression_level=6))
        number, at, parts, ids, rows = -1, 0, [], [], []

        def piece() -> None:
            if parts:
                rows.append((number, at, ids, packer.compress(b"".join(parts))))

        def placed() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=PIECE[2:])
            slot = permuted(out.number.to_numpy(np.int64), count, key)
            return out.assign(slot=slot, shard=slot // per_shard)[PIECE]

        for batch in batches:
            for base, start, n, doc_id, data in zip(
                batch.base, batch.start, batch.n, batch.doc_id, batch.tokens, strict=True
            ):
                first, last = int(base + start), int(base + start + n)
                for q in range(first // sequence, (last - 1) // sequence + 1):
                    lo, hi = max(first, q * sequence), min(last, (q + 1) * sequence)
                    if q != number:
                        piece()
                        number, at, parts, ids = q, lo % sequence, [], []
                    parts.append(data[2 * (lo - first) : 2 * (hi - first)])
                    ids += [] if doc_id is None else [as_id(doc_id)]
                if len(rows) >= 2048:
                    yield placed()
                    rows = []
        piece()
        yield placed()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = fs.FileSystem.from_uri(folder)
        unpack = compression.decompressor(words)
        current, target, name, done = None, None, "", []
        slot, number, held, ids = None, None, [], []

        def finish_sequence() -> None:
            nonlocal slot
            if slot is None:
                return
            data = b"".join(held)
            n = len(data) // 2
            data += np.full(sequence - n, end, "<u2").tobytes()
            target.write(data)
            done.append(
                (slot, current, (slot % per_shard) * stride, number, n, list(dict.fromkeys(ids)), zlib.crc32(data))
            )
            slot = None

        def finish_shard() -> None:
            if target is not None:
                target.close()
                store.move(name, f"{root}/shard-{current:06d}.bin")

        for batch in batches:
            for shard, s, q, doc_ids, piece in zip(
                batch.shard, batch.slot, batch.number, batch.doc_ids, batch.piece, strict=True
            ):
                if s != slot:
                    finish_sequence()
                    if shard != current:
                        finish_shard()
                        current = int(shard)
                        name = f"{root}/.shard-{current:06d}-{uuid.uuid4().hex}"
                        target = store.open_output_stream(name)
                    slot, number, held, ids = int(s), int(q), [], []
                held.append(unpack(piece, 2 * sequence))
                ids += doc_ids.tolist()
            if len(done) >= 4096:
                yield pd.DataFrame(done, columns=MANIFEST)
                done = []
        finish_sequence()
        finish_shard()
        yield pd.DataFrame(done, columns=MANIFEST)

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    pieces = tokens.join(checked(bases, 24), ["file", "first"]).mapInPandas(
        cut, f"shard long, slot long, number long, at int, doc_ids array<{kind}>, piece binary"
    )
    path = scratch_path(spark, "manifest")
    manifest = (
        pieces.repartitionById(
            max(1, -(-shards // range_size)), F.floor(F.col("shard") / range_size).cast("int")
        )
        .sortWithinPartitions("slot", "at")
        .mapInPandas(
            write,
            "slot long, shard long, byte_offset long, sequence long, n_tokens int,"
            f" doc_ids array<{kind}>, crc32 long",
        )
    )
    with small_batches(spark, 1024):
        manifest.write.parquet(path)
    settings = dict(sequence=sequence, per_shard=per_shard, sequences=count, tokens=total, end=end, key=key)
    with store.open_output_stream(f"{root}/shards.json") as out:
        out.write(json.dumps(settings).encode())
    return spark.read.schema(manifest.schema).parquet(path)


def read_sequences(folder: str, start: int = 0) -> Iterator[np.ndarray]:
    """Sequences of a folder of shards in training order from slot ``start`` on.

    One sequence is read at a time.
    """
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/shards.json") as found:
        settings = json.loads(found.read())
    stride, per_shard = 2 * settings["sequence"], settings["per_shard"]
    slot = start
    while slot < settings["sequences"]:
        with store.open_input_file(f"{root}/shard-{slot // per_shard:06d}.bin") as shard:
            shard.seek((slot % per_shard) * stride)
            while slot < settings["sequences"]:
                yield np.frombuffer(shard.read(stride), "<u2")
                slot += 1
                if slot % per_shard == 0:
                    break


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """Content of a rank file, read by the driver; tasks get it with their code."""
    with open(path, "rb") as found:
        return found.read()

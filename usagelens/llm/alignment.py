"""Cross-tokenizer alignment: which tokens of one tokenizer lie on which tokens of another.

Every text is encoded by a byte-level vocabulary (A) and a piece vocabulary (B). A token is a
row of a sparse 0/1 incidence matrix with one column per byte of the text; the product A·Bᵀ
holds, for every pair of tokens that overlap, the number of bytes they share. Byte offsets
where tokens of both sides end cut the tokens into groups; the products of the group-incidence
matrices give the links inside a group. The matrices are CSR arrays built here and multiplied
row by row (Gustavson's scheme): the rows of the right matrix named by a row of the left one
are laid out and equal columns added up. All texts of a batch form one block-diagonal matrix,
and a product is taken in blocks of rows, so a text of any length needs bounded memory.

Texts are encoded once and their ids stored. How often an id pair is linked in the corpus is
added up per task before the shuffle. The commonest pairs, a bounded number, go to all tasks;
every other pair is joined, so the result covers all pairs whatever their number.

Defined cases: a text that is null or empty, or whose tokens do not spell its bytes after a
leading space, has no tokens: all its counts are 0 and its groups are ''. Special tokens spelt
in a text are ordinary text. Rows that repeat a doc_id, or have none, are rows of their own;
an empty table gives no rows; columns of the documents that bear names used here do not matter,
since only the asked-for ones are read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from usagelens.llm.common import small_batches, stored
from usagelens.llm.shards import PATTERN

BYTES_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# The mark that stands for a space in pieces: a fixed value.
SPACE = "▁"
# Entries of a product held at once, pairs a task adds up before it passes them on, and the
# commonest pairs that every task is given (17 bytes each).
BLOCK, HELD_PAIRS, COMMON_PAIRS = 1 << 20, 1 << 20, 1 << 18


@dataclass(frozen=True)
class Vocabularies:
    """Contents of the two vocabulary files."""

    by_bytes: bytes
    by_pieces: bytes


def read_vocabularies(
    by_bytes: str = BYTES_VOCABULARY, by_pieces: str = PIECE_VOCABULARY
) -> Vocabularies:
    """The files are read where the job is started; tasks are given the contents."""
    with open(by_bytes, "rb") as a, open(by_pieces, "rb") as b:
        return Vocabularies(a.read(), b.read())


def printable_bytes() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary: printable Latin
    ones for themselves, the others in turn from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@lru_cache(maxsize=2)
def token_bytes_a(content: bytes) -> dict[bytes, int]:
    """Bytes of every ordinary token and its id."""
    data = json.loads(content)
    special = {t["content"] for t in data["added_tokens"]}
    of = printable_bytes()
    return {bytes(of[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in special}


@lru_cache(maxsize=2)
def encoders(vocabularies: Vocabularies) -> tuple[Callable, Callable]:
    """Functions from texts to lists of ids; built once per Python process."""
    import sentencepiece
    import tiktoken

    # The ids of this vocabulary follow its merges, so they are the ranks as well.
    ranks = token_bytes_a(vocabularies.by_bytes)
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.by_pieces)
    return (
        lambda texts: [own.encode_ordinary(" " + t) for t in texts],
        lambda texts: pieces.encode(texts, num_threads=1),
    )


@lru_cache(maxsize=2)
def token_tables(vocabularies: Vocabularies) -> tuple[list[bytes], list[bytes]]:
    """Bytes of the tokens of A and of B by id."""
    import sentencepiece

    ranks = token_bytes_a(vocabularies.by_bytes)
    a = [b""] * (max(ranks.values()) + 1)
    for token, number in ranks.items():
        a[number] = token
    pieces = sentencepiece.SentencePieceProcessor(model_proto=vocabularies.by_pieces)
    b = []
    for number in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(number)
        byte = pieces.is_byte(number)
        b.append(bytes([int(piece[3:-1], 16)]) if byte else piece.replace(SPACE, " ").encode())
    return a, b


class Csr(NamedTuple):
    """A 0/1 matrix by rows: row r has ones in the columns ``columns[starts[r]:starts[r + 1]]``."""

    starts: np.ndarray
    columns: np.ndarray
    width: int


def bytes_of_tokens(lengths: np.ndarray) -> Csr:
    """Token-byte incidence: tokens of these lengths, laid end to end."""
    starts = np.r_[0, np.cumsum(lengths)]
    return Csr(starts, np.arange(starts[-1]), int(starts[-1]))


def memberships(groups: np.ndarray, width: int) -> Csr:
    """Group incidence: one group for every token."""
    return Csr(np.arange(len(groups) + 1), groups, width)


def transposed(m: Csr) -> Csr:
    rows = np.repeat(np.arange(len(m.starts) - 1), np.diff(m.starts))
    order = np.argsort(m.columns, kind="stable")
    counts = np.bincount(m.columns, minlength=m.width)
    return Csr(np.r_[0, np.cumsum(counts)], rows[order], len(m.starts) - 1)


def product(left: Csr, right: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, columns, values) of the entries of left·right that are not 0, in blocks.

    Row r of the product adds up the rows of ``right`` named by row r of ``left``. A block
    takes rows of ``left`` that name at most ``BLOCK`` entries; a longer row is cut, and its
    parts are added by ``summed``.
    """
    sizes = np.diff(right.starts)[left.columns]
    ends = np.cumsum(sizes)
    rows = np.repeat(np.arange(len(left.starts) - 1), np.diff(left.starts))
    at = 0
    while at < len(sizes):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + BLOCK, side="right")))
        if to < len(sizes) and rows[to] == rows[to - 1] and rows[to - 1] > rows[at]:
            to = int(np.searchsorted(rows, rows[to - 1]))
        n = sizes[at:to]
        first = right.starts[left.columns[at:to]]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        yield summed(np.repeat(rows[at:to], n), right.columns[place], right.width)
        at = to


def summed(rows: np.ndarray, columns: np.ndarray, width: int) -> tuple:
    """Equal places added up, in the order of rows and columns."""
    key = rows * np.int64(width) + columns
    if len(key) and (np.diff(key) < 0).any():
        key = np.sort(key)
    edge = np.flatnonzero(np.r_[True, np.diff(key) != 0]) if len(key) else np.empty(0, int)
    values = np.diff(np.r_[edge, len(key)])
    return key[edge] // width, key[edge] % width, values


def times_vector(m: Csr, vector: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(vector[m.columns])]
    return total[m.starts[1:]] - total[m.starts[:-1]]


class Batch(NamedTuple):
    """Tokens of several texts laid end to end; ``text_a`` and ``text_b`` are their texts."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    lengths_a: np.ndarray
    lengths_b: np.ndarray


@lru_cache(maxsize=2)
def token_lengths(vocabularies: Vocabularies) -> tuple[np.ndarray, np.ndarray]:
    a, b = token_tables(vocabularies)
    return np.array([len(t) for t in a], np.int64), np.array([len(t) for t in b], np.int64)


def unpacked(a: list[bytes], b: list[bytes], sizes: tuple[np.ndarray, np.ndarray]) -> Batch:
    """``sizes``: bytes of every token of either side."""
    ids = [np.frombuffer(b"".join(side), "<i4").astype(np.int64) for side in (a, b)]
    texts = [np.repeat(np.arange(len(side)), [len(x) // 4 for x in side]) for side in (a, b)]
    return Batch(*ids, *texts, sizes[0][ids[0]], sizes[1][ids[1]])


def overlaps(batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token of A, token of B, bytes shared) of all pairs that overlap, A·Bᵀ in blocks."""
    last = None
    left, right = bytes_of_tokens(batch.lengths_a), transposed(bytes_of_tokens(batch.lengths_b))
    for rows, columns, values in product(left, right):
        # A token cut between blocks goes on with the same pair at most.
        if last is not None and len(rows) and (rows[0], columns[0]) == last[:2]:
            values[0] += last[2]
        elif last is not None:
            yield tuple(np.array([x]) for x in last)
        if len(rows):
            yield rows[:-1], columns[:-1], values[:-1]
            last = rows[-1], columns[-1], values[-1]
    if last is not None:
        yield tuple(np.array([x]) for x in last)


def groups(batch: Batch) -> tuple[Csr, Csr]:
    """Group incidence of the tokens of A and of B; a text's end closes a group."""
    ends = np.cumsum(batch.lengths_a), np.cumsum(batch.lengths_b)
    ended = np.zeros((2, int(ends[0][-1]) + 1 if len(ends[0]) else 1), bool)
    ended[0, ends[0]] = ended[1, ends[1]] = True
    # A token's group is the number of cuts before its end.
    cuts = [(ended[0, e] & ended[1, e]).astype(np.int64) for e in ends]
    return tuple(memberships(np.cumsum(c) - c, int(c.sum())) for c in cuts)


def group_links(batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(token of A, token of B, 1) of all pairs of one group, in blocks."""
    of_a, of_b = groups(batch)
    yield from product(of_a, transposed(of_b))


def encoded(documents: DataFrame, vocabularies: Vocabularies, columns: list[str]) -> DataFrame:
    """Stored ``columns`` and the ids of both sides as little-endian 32-bit integers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode_a, encode_b = encoders(vocabularies)
        table_a, table_b = token_tables(vocabularies)
        for batch in batches:
            texts = [t or "" for t in batch.pop("text of the row")]
            packed = []
            for text, a, b in zip(texts, encode_a(texts), encode_b(texts), strict=True):
                whole = (" " + text).encode()
                spelt = text and all(
                    b"".join(map(table.__getitem__, ids)) == whole
                    for table, ids in ((table_a, a), (table_b, b))
                )
                packed.append([np.array(x, "<i4").tobytes() if spelt else b"" for x in (a, b)])
            yield batch.assign(
                **{IDS[0]: [a for a, _ in packed], IDS[1]: [b for _, b in packed]}
            )

    source = documents.select(*columns, F.col("text").alias("text of the row"))
    kind = StructType(
        [f for f in source.schema.fields if f.name != "text of the row"]
    ).add(IDS[0], "binary").add(IDS[1], "binary")
    with small_batches(documents.sparkSession):
        return stored(source.mapInPandas(run, kind), "aligned-tokens")


IDS = ["ids of side A", "ids of side B"]


def links(tokens: DataFrame, vocabularies: Vocabularies, columns: list[str]) -> DataFrame:
    """``columns``, (token_a, token_b, id_a, id_b, n_bytes) of every overlap and
    (.., n_bytes 0) of every pair that shares a group only; tokens count from 0 in their text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = token_lengths(vocabularies)
        for rows in batches:
            for at in range(len(rows)):
                one = rows.iloc[[at]]
                batch = unpacked(one[IDS[0]].tolist(), one[IDS[1]].tolist(), sizes)
                seen = set()
                for kind in (overlaps, group_links):
                    for a, b, n in kind(batch):
                        if kind is overlaps:
                            seen.update(zip(a.tolist(), b.tolist(), strict=True))
                        else:
                            fresh = [p not in seen for p in zip(a.tolist(), b.tolist(), strict=True)]
                            a, b, n = a[fresh], b[fresh], np.zeros(sum(fresh), np.int64)
                        out = pd.DataFrame(
                            {"token_a": a, "token_b": b, "id_a": batch.ids_a[a], "id_b": batch.ids_b[b], "n_bytes": n}
                        )
                        for c in columns:
                            out[c] = [one[c].iloc[0]] * len(out)
                        yield out[[*columns, "token_a", "token_b", "id_a", "id_b", "n_bytes"]]

    kind = StructType([tokens.schema[c] for c in columns])
    for name in ("token_a", "token_b", "id_a", "id_b", "n_bytes"):
        kind = kind.add(name, "long")
    return tokens.select(*columns, *IDS).mapInPandas(run, kind)


def pair_key(batch: Batch, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both ids of a link in one number."""
    return batch.ids_a[a] << np.int64(32) | batch.ids_b[b]


def pair_counts(tokens: DataFrame, vocabularies: Vocabularies) -> DataFrame:
    """Stored (pair, n, best): links of the corpus that hold the pair, and whether no other
    pair of the same B id has more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = token_lengths(vocabularies)
        keys, counts, waiting = np.empty(0, np.int64), np.empty(0, np.int64), []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            every = np.concatenate([keys, *(k for k, _ in waiting)])
            n = np.concatenate([counts, *(c for _, c in waiting)])
            distinct, place = np.unique(every, return_inverse=True)
            return distinct, np.bincount(place, n, len(distinct)).astype(np.int64)

        for rows in batches:
            batch = unpacked(rows[IDS[0]].tolist(), rows[IDS[1]].tolist(), sizes)
            for a, b, _ in overlaps(batch):
                waiting.append(np.unique(pair_key(batch, a, b), return_counts=True))
                if sum(len(k) for k, _ in waiting) > HELD_PAIRS:
                    keys, counts = merged()
                    waiting = []
                    if len(keys) > HELD_PAIRS:
                        yield pd.DataFrame({"pair": keys, "n": counts})
                        keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield pd.DataFrame({"pair": keys, "n": counts})

    counted = tokens.select(*IDS).mapInPandas(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    side_b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    counts = stored(counted.withColumn("b", side_b), "pair-counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return stored(
        counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-ranks"
    )


@lru_cache(maxsize=8)
def spellings_up_to(power: int) -> np.ndarray:
    return np.array([b"%d%s" % (i, s) for i in range(1 << power) for s in SEPARATORS], object)


def spellings(ids: int) -> np.ndarray:
    """Every id below ``ids``, or more, with each separator."""
    return spellings_up_to(ids.bit_length())


def group_text(batch: Batch, of_a: Csr, of_b: Csr, texts: int) -> list[bytes]:
    """For every text its groups as `a1,a2|b1;a3|b2,b3`."""
    last_a = np.diff(of_a.columns, append=-1) != 0
    last_b = np.diff(of_b.columns, append=-1) != 0
    per_a = np.bincount(of_a.columns, minlength=of_a.width)
    per_b = np.bincount(of_b.columns, minlength=of_b.width)
    # A token stands behind all tokens of earlier groups; one of B behind those of A in its own.
    place_a = np.arange(len(of_a.columns)) + (np.cumsum(per_b) - per_b)[of_a.columns]
    place_b = np.arange(len(of_b.columns)) + np.cumsum(per_a)[of_b.columns]
    order = np.empty(len(place_a) + len(place_b), np.int64)
    # One code per token: its id, and which separator follows.
    order[place_a] = batch.ids_a * 3 + np.where(last_a, 1, 0)
    order[place_b] = batch.ids_b * 3 + np.where(last_b, 2, 0)
    spelt = spellings(int(order.max(initial=0)) // 3 + 1)[order]
    ends = np.cumsum(np.bincount(batch.text_a, minlength=texts) + np.bincount(batch.text_b, minlength=texts))
    starts = np.r_[0, ends[:-1]] if texts else ends
    return [b"".join(spelt[i:j].tolist())[:-1] for i, j in zip(starts, ends, strict=True)]


SEPARATORS = (b",", b"|", b";")


class PairTable:
    """The commonest pairs, at most ``COMMON_PAIRS``, with their counts, in a hash table.

    A pair lies in the first free slot from its hash on; ``find`` looks all pairs of a block
    up at once, slot after slot.
    """

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, bests: np.ndarray) -> None:
        self.pairs, self.counts, self.bests = pairs, counts, bests
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        waiting, step = np.arange(len(pairs), dtype=np.int32), 0
        first = self.hashed(pairs)
        while len(waiting):
            at = (first[waiting] + step) & (len(self.slots) - 1)
            free = self.slots[at] < 0
            self.slots[at[free]] = waiting[free]
            waiting = waiting[self.slots[at] != waiting]
            step += 1
        self.steps = step

    def hashed(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """Place of every pair, -1 where it is not in the table."""
        at = self.hashed(pairs)
        out = np.full(len(pairs), -1, np.int64)
        waiting = np.arange(len(pairs)) if len(self.pairs) else np.arange(0)
        for _ in range(self.steps):
            held = self.slots[at[waiting]]
            right = (held >= 0) & (self.pairs[held] == pairs[waiting])
            out[waiting[right]] = held[right]
            waiting = waiting[~right & (held >= 0)]
            if not len(waiting):
                break
            at[waiting] = (at[waiting] + 1) & (len(self.slots) - 1)
        return out


def common_pairs(counts: DataFrame) -> PairTable:
    rows = counts.orderBy(F.desc("n"), "pair").limit(COMMON_PAIRS).toPandas()
    return PairTable(rows.pair.to_numpy(np.int64), rows.n.to_numpy(np.int64), rows.best.to_numpy(bool))


def alignments(
    documents: DataFrame, vocabularies: Vocabularies, columns: list[str]
) -> DataFrame:
    """``columns``, n_a, n_b, n_groups, n_links, n_shared (links of the group products), n_best,
    count_sum, groups_sha256 of every document."""
    spark: SparkSession = documents.sparkSession
    tokens = encoded(documents, vocabularies, columns)
    with small_batches(spark):
        counts = pair_counts(tokens, vocabularies)
        known = spark.sparkContext.broadcast(common_pairs(counts))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sizes = token_lengths(vocabularies)
            common = known.value
            for rows in batches:
                texts = len(rows)
                batch = unpacked(rows.pop(IDS[0]).tolist(), rows.pop(IDS[1]).tolist(), sizes)
                n_links, n_best, total = (np.zeros(texts, np.int64) for _ in range(3))
                rare: list[tuple[np.ndarray, np.ndarray]] = []
                for a, b, _ in overlaps(batch):
                    text, key = batch.text_a[a], pair_key(batch, a, b)
                    place = common.find(key)
                    n_links += np.bincount(text, minlength=texts)
                    found = place >= 0
                    if not found.all():
                        rare.append((text[~found], key[~found]))
                        text, place = text[found], place[found]
                    n_best += np.bincount(text[common.bests[place]], minlength=texts)
                    total += per_text(text, common.counts[place], texts)
                of_a, of_b = groups(batch)
                both = times_vector(of_a, times_vector(transposed(of_b), np.ones(len(batch.ids_b), np.int64)))
                left: list[list] = [[] for _ in range(texts)]
                for text, key in rare:
                    for t, k in zip(text.tolist(), key.tolist(), strict=True):
                        left[t].append(k)
                text_of_group = batch.text_a[np.flatnonzero(np.diff(of_a.columns, prepend=-1))]
                hashes = [
                    hashlib.sha256(g).hexdigest() if g else "" for g in group_text(batch, of_a, of_b, texts)
                ]
                yield rows.assign(
                    n_a=np.bincount(batch.text_a, minlength=texts),
                    n_b=np.bincount(batch.text_b, minlength=texts),
                    n_groups=np.bincount(text_of_group, minlength=texts),
                    n_links=n_links,
                    n_shared=np.bincount(batch.text_a, both, texts).astype(np.int64),
                    n_best=n_best,
                    count_sum=total,
                    groups_sha256=hashes,
                    **{RARE: left},
                )

        numbers = ["n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum"]
        kind = StructType([tokens.schema[c] for c in columns])
        for name in numbers:
            kind = kind.add(name, "long")
        kind = kind.add("groups_sha256", "string").add(RARE, ArrayType(LongType()))
        partial = stored(tokens.mapInPandas(run, kind).withColumn(NUMBER, F.monotonically_increasing_id()), "alignments")
    resolved = (
        partial.select(NUMBER, F.explode(RARE).alias("pair"))
        .groupBy(NUMBER, "pair")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(counts, "pair")
        .groupBy(NUMBER)
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more best"),
            F.sum(F.col("times") * F.col("n")).alias("more count"),
        )
    )
    return partial.drop(RARE).join(resolved, NUMBER, "left").select(
        *columns,
        *numbers[:-2],
        (F.col("n_best") + F.coalesce("more best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def per_text(text: np.ndarray, values: np.ndarray, texts: int) -> np.ndarray:
    """Sums of ``values`` by text; ``text`` never falls."""
    ends = np.searchsorted(text, np.arange(texts + 1))
    total = np.r_[0, np.cumsum(values)]
    return total[ends[1:]] - total[ends[:-1]]


RARE, NUMBER = "pairs to be joined", "number of the row"

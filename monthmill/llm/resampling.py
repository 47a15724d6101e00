"""Importance resampling towards a target: bucketed n-gram counts whose CRCs come from prefixes.

Each text is normalised to its words, one space between them, and scanned once: the CRC-32 of the text up to each word's end is
kept. The CRC of AB is that of A, moved over as many zero bytes as B has, XOR that of B. Moving is linear over GF(2), so the
CRC of any run of words is the one at its end XOR the one at its beginning, moved by the run's length; four tables per power of
two of that length do the moving for all runs of a block at once. No n-gram is ever spelled out or hashed by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import staged

#: Words, and bytes of one text, that a task takes at a time.
BLOCK_WORDS, BLOCK_BYTES = 1 << 19, 1 << 22
POLYNOMIAL = 0xEDB88320


def _word_bytes() -> bytes:
    """A-Z become a-z; letters, digits and all bytes of other scripts stay; the rest parts words."""
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@lru_cache
def _moves() -> tuple[np.ndarray, list[np.ndarray]]:
    """The CRC's byte table, and for each j the tables that move a CRC over 2**j zero bytes, one per byte of it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    ones = np.arange(256, dtype=np.uint32)
    values = np.stack([ones << np.uint32(8 * k) for k in range(4)])
    powers = [table[values & 255] ^ (values >> 8)]
    while len(powers) < 40:
        powers.append(_moved(powers[-1], powers[-1]))
    return table, powers


def _moved(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    return tables[0][crcs & 255] ^ tables[1][(crcs >> 8) & 255] ^ tables[2][(crcs >> 16) & 255] ^ tables[3][crcs >> 24]


def moved(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each CRC, moved over as many zero bytes as its length says."""
    out, (_, powers) = crcs.copy(), _moves()
    for j in range(int(lengths.max(initial=0)).bit_length()):
        some = np.flatnonzero((lengths >> j) & 1)
        out[some] = _moved(powers[j], out[some])
    return out


def run_crcs(words: list[bytes], order: int) -> Iterator[np.ndarray]:
    """For k = 1 … order the CRC-32 of every run of k words joined by spaces, by the number of its first word."""
    table, _ = _moves()
    spaced = [words[0], *(b" " + w for w in words[1:])] if words else []
    ends = np.fromiter(accumulate(spaced, lambda crc, w: crc32(w, crc), initial=0), np.uint32, len(words) + 1)[1:]
    # A word begins after one more byte, the space.
    spaces = ~ends[:-1]
    starts = np.append(np.zeros(min(1, len(words)), np.uint32), ~(table[(spaces ^ 32) & 255] ^ (spaces >> 8)))
    stops = np.cumsum(np.fromiter(map(len, spaced), np.int64, len(words)))
    begins = np.append(np.zeros(min(1, len(words)), np.int64), stops[:-1] + 1)
    for k in range(1, order + 1):
        n = max(0, len(words) - k + 1)
        yield ends[k - 1 :][:n] ^ moved(starts[:n], stops[k - 1 :][:n] - begins[:n])


def _blocks(texts: list[bytes | None], order: int) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """Words, the number of their text, and whether they are new, in blocks.

    A block begins with the last order - 1 words of the one before, which are not new.
    """
    kept, words, owner, new = _word_bytes(), [], [], []
    for number, raw in enumerate(texts):
        text, at = (raw or b"").translate(kept), 0
        while at < len(text):
            cut = text.find(b" ", at + BLOCK_BYTES)
            cut = len(text) if cut < 0 else cut
            some, at = text[at:cut].split(), cut
            words += some
            owner += [number] * len(some)
            new += [True] * len(some)
            if len(words) >= BLOCK_WORDS:
                yield words, np.array(owner), np.array(new)
                old = len(words) - order + 1
                words, owner = words[old:], owner[old:]
                new = [False] * len(words)
    if any(new):
        yield words, np.array(owner), np.array(new)


def text_features(texts: list[bytes | None], order: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (number of the text, bucket) of all features, and of the texts' words."""
    for words, owner, new in _blocks(texts, order):
        owners, found = [], []
        for k, crcs in enumerate(run_crcs(words, order)):
            n = len(crcs)
            whole = np.flatnonzero((owner[:n] == owner[k:][:n]) & new[k:][:n])
            owners.append(owner[whole])
            found.append(crcs[whole] % buckets)
        yield np.concatenate(owners), np.concatenate(found), owner[new]


def bucket_counts(docs: DataFrame, order: int = 3, buckets: int = 10_000) -> DataFrame:
    """bucket and n: the features of all texts. A task hands on one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _ in text_features(batch.column(0).to_pylist(), order, buckets):
                sums += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.record_batch([pa.array(some.astype(np.int32)), pa.array(sums[some])], names=["bucket", "n"])

    counted = docs.select(F.col("text").cast("binary")).mapInArrow(count, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, order: int = 3, buckets: int = 10_000) -> np.ndarray:
    """Per bucket floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))). The driver gets `buckets` numbers."""
    sides = []
    for side in (docs, target):
        counts = np.zeros(buckets)
        for bucket, n in bucket_counts(side, order, buckets).collect():
            counts[bucket] = n
        sides.append(counts)
    s, t = sides
    ratio = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int = 3) -> DataFrame:
    """doc_id, n_words, n_features and weight (the sum of its features' gains) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            sums = np.zeros((3, rows), np.int64)
            for owner, found, words in text_features(batch.column("text").to_pylist(), order, len(shared.value)):
                sums[0] += np.bincount(words, minlength=rows)
                sums[1] += np.bincount(owner, minlength=rows)
                np.add.at(sums[2], owner, shared.value[found])
            yield pa.record_batch([batch.column("doc_id"), *map(pa.array, sums)], names=["doc_id", "n_words", "n_features", "weight"])

    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return columns.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long")


def ranked(rows: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """`rows` with their place in the given order, from 1, without a task that sees all of them.

    Rows are dealt by ranges of the order and written; a range's places follow on the sizes of the ranges before it.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = staged(rows.repartitionByRange(n, *order).withColumn("range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    # One row per range.
    before = sizes.select("range", (F.sum("rows").over(Window.orderBy("range")) - F.col("rows")).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    return dealt.withColumn("place", place).join(before, "range").withColumn(name, F.col("place") + F.col("before")).drop("range", "place", "before")


def resample(
    docs: DataFrame, target: DataFrame, order: int = 3, buckets: int = 10_000, percent: int = 5, min_words: int = 20, seed: int = 42
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; rank is NULL for those not drawn.

    Features are the runs of 1 to `order` words of a text. A document's weight sums their gains (see `gains`), and its score
    adds Gumbel noise from its doc_id. Of the N documents with at least `min_words` words the floor(percent * N / 100) highest
    scores are drawn, ties to the smaller doc_id, then to fewer features and the smaller weight. NULL and empty texts have no
    features and weight 0. A NULL doc_id has the noise of the text '<seed>:' and comes last among ties. Repeated rows count
    and compete each for itself. Other columns are ignored.
    """
    weights = weighed(docs, gains(docs, target, order, buckets), order)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("long")
    scored = staged(weights.withColumn("score", F.col("weight") + noise), "scores")
    long_enough = F.col("n_words") >= min_words
    drawn = scored.where(long_enough).count() * percent // 100
    by = [F.desc(long_enough), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight")]
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank")
    return ranked(scored, by).select("doc_id", "n_words", "n_features", "weight", "score", rank)

"""Phrase collocations: counts of all orders from the longest windows alone.

Every word of a text leads one window: itself and the words after it in its piece, as columns, padded with NULL where the
piece ends. Only these longest windows are counted. A phrase's count is then the sum over all windows that begin with it, so
ROLLUP over the windows' columns gives the counts of all shorter phrases, and no n-grams of other lengths are ever made.
The leads are shifted arrays instead of Spark's `lead`, which would shuffle and sort every single word.

Shuffles. Windows are counted per block of text, sorted, so that neighbours compress, and dealt by their first two words.
There all windows of a pair meet, so a window that is rarer than `min_count` can drop its last words before ROLLUP sums
them (its shorter prefixes keep its count): of the second shuffle only frequent phrases and single words are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import staged

# What ends a piece, what parts words.
PIECE_ENDS, GAPS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"

#: Bytes of text whose windows a task counts together, and whose bytes it takes apart at a time, beside one longer text.
BLOCK, STRETCH = 1 << 23, 1 << 20
#: Parts of a lang whose best phrases are found first.
PARTS = 32


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(GAPS)] = 1
    kinds[list(PIECE_ENDS)] = 2
    return kinds


def _lowered() -> np.ndarray:
    low = np.arange(256, dtype=np.uint8)
    low[ord("A") : ord("Z") + 1] += 32
    return low


def _runs(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Begin and length of runs of texts that hold at most `size` bytes, or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        n = max(1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")) - at)
        yield at, n
        at += n


def _taken_apart(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes and lengths of all words of some texts, one after another, and the number of each one's piece and text."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw if raw is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    kind = _byte_kinds()[data]
    inside = np.append(kind == 0, False)
    opens = np.zeros(len(data) + 1, bool)  # bytes that begin a text
    opens[offsets] = True
    before = np.append(False, inside[:-1])
    starts = np.flatnonzero(inside & (opens | ~before))
    ends = np.flatnonzero(before & (opens | ~inside))
    piece = np.searchsorted(np.flatnonzero(opens[:-1] | (kind == 2)), starts, "right")
    text = np.searchsorted(offsets, starts, "right") - 1
    return _lowered()[data[inside[:-1]]], (ends - starts).astype(np.int32), piece.astype(np.int32), text.astype(np.int32)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words of some texts, as a dictionary array, with the number of each one's piece and text."""
    parts, pieces = [], 0
    for at, n in _runs(texts, STRETCH):
        letters, lengths, piece, text = _taken_apart(pc.fill_null(texts.slice(at, n).cast(pa.large_string()), ""))
        parts.append((letters, lengths, piece + np.int32(pieces), text + np.int32(at)))
        pieces = int(parts[-1][2].max(initial=pieces))
    letters, lengths, piece, text = map(np.concatenate, zip(*parts, strict=True))
    places = np.append(0, np.cumsum(lengths))
    words = pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(places), pa.py_buffer(letters))
    return words.dictionary_encode(), piece, text


def _counted_windows(texts: pa.Array, langs: pa.Array, order: int) -> pa.RecordBatch:
    """pair (the first two words, a tab, the lang), w3 … and n of the distinct windows of some texts; like ones are neighbours."""
    words, piece, text = _words(texts)
    langs = langs.dictionary_encode()
    columns = [langs.indices.to_numpy()[text], words.indices.to_numpy()]
    del text
    for k in range(1, order):
        later = np.full(len(piece), -1, np.int32)
        if k < len(piece):
            later[:-k] = np.where(piece[k:] == piece[:-k], columns[1][k:], -1)
        columns.append(later)
    # One number for each distinct window: its columns as digits, made small again where they would not fit.
    key, size, base = columns[0].astype(np.int64), len(langs.dictionary), len(words.dictionary) + 1
    for column in columns[1:]:
        if size * base >= 1 << 63:
            key = np.unique(key, return_inverse=True)[1]
            size = len(key)
        key *= base
        key += column
        key += 1
        size *= base
    place = np.argsort(key)
    key = key[place]
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    n = np.diff(np.append(heads, len(key)))
    place = place[heads]
    del key, heads, piece

    def spelled(k: int) -> pa.Array:
        at = columns[k][place]
        return words.dictionary.take(pa.array(at, mask=at < 0)).cast(pa.string())

    lead = pc.binary_join_element_wise(spelled(1), spelled(2), " ", null_handling="skip")
    # Words have no tab, and here no lang has one either.
    known = pa.array([lang.replace("%", "%25").replace("\t", "%09") for lang in langs.dictionary.to_pylist()], pa.string())
    pair = pc.binary_join_element_wise(lead, known.take(pa.array(columns[0][place])), "\t")
    rest = [spelled(k) for k in range(3, order + 1)]
    return pa.record_batch([pair, *rest, pa.array(n)], names=["pair", *(f"w{k}" for k in range(3, order + 1)), "n"])


def windows(docs: DataFrame, order: int) -> DataFrame:
    """Counted longest windows of `docs`, per Arrow batch: equal ones of different batches are not yet one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column("text"), pc.fill_null(batch.column("lang"), "und")
            for begin, size in _runs(texts, BLOCK):
                found = _counted_windows(texts.slice(begin, size), langs.slice(begin, size), order)
                for at in range(0, len(found), 1 << 16):
                    yield found.slice(at, 1 << 16)
                del found
                pa.default_memory_pool().release_unused()

    later = "".join(f", w{k} string" for k in range(3, order + 1))
    return docs.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(count, f"pair string{later}, n long")


def phrase_counts(docs: DataFrame, max_words: int = 3, min_count: int = 10) -> DataFrame:
    """lang, phrase, size and f of all phrases of at most `max_words` words that occur at least `min_count` times in their lang.

    A row of size 0 and phrase '' per lang counts its words. Overlapping occurrences count, and none crosses a piece.
    NULL texts are empty, a NULL lang is `und`, repeated rows count again, other columns are ignored. A lang without a word
    has no row.
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    rest = [f"w{k}" for k in range(3, max_words + 1)]
    met = windows(docs, max_words).repartition("pair")
    # The windows of a pair lie in one partition: how often each of their prefixes occurs is known without a shuffle, by one
    # sort. A number in front makes that sort fast.
    known = met.withColumn("hash", F.xxhash64("pair"))
    for k in range(max_words, 1, -1):
        known = known.withColumn(f"n{k}", F.sum("n").over(Window.partitionBy("hash", "pair", *rest[: k - 2])))
    lead, lang = F.substring_index("pair", "\t", 1), F.substring_index("pair", "\t", -1)
    spelled = {2: F.when(F.contains(lead, F.lit(" ")), F.substring_index(lead, " ", -1))} | {k: F.col(f"w{k}") for k in range(3, max_words + 1)}
    kept = [F.when(F.col(f"n{k}") >= min_count, word).alias(f"w{k}") for k, word in spelled.items()]
    folded = known.select(lang.alias("lang"), F.substring_index(lead, " ", 1).alias("w1"), *kept, "n")
    words = [f"w{k}" for k in range(1, max_words + 1)]
    size = " + ".join(f"(1 - grouping({w}))" for w in words)
    rolled = docs.sparkSession.sql(
        f"select lang, {', '.join(words)}, {size} as size, sum(n) as f from {{folded}} "
        f"group by lang, rollup({', '.join(words)}) having {size} = 0 or sum(n) >= {int(min_count)}",
        folded=folded,
    )
    # A prefix whose last word is padding is a shorter phrase, which has its own row.
    padded = F.get(F.array(F.lit(""), *words), F.col("size").cast("int")).isNull()
    lang = F.replace(F.replace("lang", F.lit("%09"), F.lit("\t")), F.lit("%25"), F.lit("%"))
    return rolled.where(~padded).select(lang.alias("lang"), F.concat_ws(" ", *words).alias("phrase"), F.col("size").cast("int").alias("size"), "f")


def _part(words: Column, begin: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, begin, length), " ")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, inside_percent: int = 50, first: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each lang's best phrases.

    Candidates are the phrases of 2 to `max_words` words with a >= `min_count` occurrences. A cut into two parts that occur
    l and r times scores floor(1000000 * a * a / (l * r)); the lowest cut counts, ties to the shorter first part. A candidate
    goes if a longer candidate around it occurs at least `inside_percent` percent as often, whether that one goes or stays.
    Ordered by score, a (both falling) and phrase (UTF-8 bytes); `first` per lang. n is the number of words of the lang.
    Counts are exact to 10^15 (products have 38 digits). See `phrase_counts` for NULLs, empty texts and repeated rows.
    """
    counts = staged(phrase_counts(docs, max_words, min_count), "phrases")
    known = counts.where("size > 0").select("lang", "phrase", "f")
    long = counts.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = long.select("lang", "phrase", "a", "size", "words", cut)
    cuts = cuts.select("lang", "phrase", "a", "k", _part("words", F.lit(1), F.col("k")).alias("left"), _part("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    wide = "decimal(19,0)"
    score = F.expr(f"(cast(a as {wide}) * cast(a as {wide}) * 1000000) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = cuts.select("lang", "phrase", "a", "k", "l", "r", score.alias("score"))
    scored = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # (length, begin) of every shorter run of at least two words.
    runs = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("size") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("size") - m + 1), lambda b: _part(F.col("words"), b, m)),
    ))
    around = long.where("size > 2").select("lang", "a", F.explode(runs).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    left = scored.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * inside_percent))
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    # First the best of parts of each lang, so that no task sees more than PARTS * `first` phrases of one.
    order, part = [F.desc("score"), F.desc("a"), "phrase"], F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    some = left.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= first)
    ranked = some.drop("part").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Document fingerprints by winnowing; only DataFrame functions.

A text's words are hashed and every run of `k` words gets a rolling hash: the cyclic polynomial, whose steps by doubling
(runs of 2 from words, of 4 from runs of 2) touch each word a few times, whatever `k`. Of each window of `w` runs the
smallest hash is chosen, of equal ones the rightmost, again by doubling. Two texts that share `k + w - 1` words in a row
share a chosen hash, and a hash's position says where. In scripts without spaces, and in very long words, each character
is a word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import text_or_empty

BLANKS = " \t\n\x0b\x0c\r"
#: Characters of scripts without spaces: Thai, Lao, Tibetan, Burmese, Khmer, kana and Han. Each is a word.
UNSPACED = r"[\u0E00-\u0FFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u31F0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\uFF66-\uFF9D\x{20000}-\x{3FFFF}]"
#: Of a longer word, as in encoded or minified text, each character is a word.
LONGEST = 32
#: The greatest position; it and all smaller ones take the lower half of a packed run, the upper bits of the hash the other.
_LAST = (1 << 32) - 1


def _rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits))


def _joined(length: int):
    """The hash of a run from those of its first `length` words and of the others."""
    return lambda first, others: _rotated(first, length).bitwiseXOR(others)


def _zipped(items: Column, by: int, combine) -> Column:
    """combine(items[i], items[i + by]) for all i where both are."""
    left = F.greatest(F.size(items) - by, F.lit(0))
    return F.zip_with(F.slice(items, 1, left), F.slice(items, by + 1, left), combine)


def _words(text: Column) -> Column:
    """The words of a text in lower case. Few texts need more than the split."""
    split = lambda x: F.filter(F.split(F.btrim(x, F.lit(BLANKS)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    spaced = split(F.regexp_replace(text, UNSPACED, " $0 "))
    cut = F.flatten(F.transform(spaced, lambda w: F.when(F.length(w) > LONGEST, F.split(w, "")).otherwise(F.array(w))))
    return F.when(F.regexp_like(text, F.lit(f"{UNSPACED}|[^\\x20\\x09-\\x0D]{{{LONGEST + 1}}}")), cut).otherwise(split(text))


def with_winnowed(df: DataFrame, text: Column, name: str, k: int = 4, w: int = 4) -> DataFrame:
    """`df` with column `name`: the chosen (hash, pos) of `text` by position, as array<struct<hash, pos>>.

    `k` is a power of two. A text of fewer than `k` words is one run, fewer than `w` runs are one window, and no words (an
    empty or NULL text) give an empty array. Case and the kind of white space don't count; pos is a word number from 0.
    """
    if k < 1 or k & (k - 1) or w < 1:
        raise ValueError("k must be a power of two and w at least 1")
    words, runs, packed, least = (f"_{name}_{part}" for part in ("words", "runs", "packed", "least"))
    df = df.withColumn(words, _words(F.lower(F.coalesce(text, F.lit("")))))
    df = df.withColumn(runs, F.transform(words, lambda x: F.xxhash64(x)))
    length = 1
    while length < k:
        df = df.withColumn(runs, _zipped(F.col(runs), length, _joined(length)))
        length *= 2
    whole = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(runs, F.when(F.size(runs) > 0, F.col(runs)).otherwise(whole))
    # The smaller of two packed runs has the smaller hash, and of equal hashes the greater position.
    pack = lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 33), 32).bitwiseOR(F.lit(_LAST) - i)
    df = df.withColumn(packed, F.transform(runs, pack)).withColumn(least, F.col(packed))
    length = 1
    while length < w:
        step = min(length, w - length)
        df = df.withColumn(least, _zipped(F.col(least), step, lambda a, b: F.least(a, b)))
        length += step
    one = F.when(F.size(packed) > 0, F.array(F.array_min(packed))).otherwise(F.col(packed))
    df = df.withColumn(least, F.array_distinct(F.when(F.size(packed) >= w, F.col(least)).otherwise(one)))
    place = lambda c: (F.lit(_LAST) - c.bitwiseAND(F.lit(_LAST))).cast("int")
    df = df.withColumn(least, F.transform(least, place))
    chosen = F.transform(least, lambda p: F.struct(F.get(runs, p).alias("hash"), p.alias("pos")))
    return df.withColumn(name, chosen).drop(words, runs, packed, least)


def hashes(fingerprint: Column) -> Column:
    """The set of chosen hashes."""
    return F.array_distinct(F.transform(fingerprint, lambda x: x["hash"]))


def likeness(left: Column, right: Column) -> Column:
    """The share of common hashes among all of two sets; two empty sets are alike."""
    common = F.size(F.array_intersect(left, right))
    every = F.size(left) + F.size(right) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def digest(fingerprint: Column) -> Column:
    """A fingerprint as 32 hex digits; equal texts have equal ones."""
    half = lambda n: F.lower(F.lpad(F.hex(F.xxhash64(fingerprint, F.lit(n))), 16, "0"))
    return F.concat(half(1), half(2))


def with_next(df: DataFrame, key: str, carried: list[str], prepare, spread: int = 4) -> DataFrame:
    """`df` with next_<c> for each carried column: that of the row with the next smaller `key`; after the last, of the first.

    Rows are dealt into ranges of `key` at its approximate quantiles, `spread` per shuffle partition. The first row of each
    range comes as a guest to the range before, so no task sees more than its range. Equal keys go by their carried columns;
    NULL comes last. `prepare` adds columns once the rows have been dealt.
    """
    n = spread * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n)).scalar()
    below = F.size(F.filter(F.coalesce(F.col("_bounds"), F.array().cast(f"array<{dict(df.dtypes)[key]}>")), lambda b: b < F.col(key)))
    dealt = df.withColumn("_bounds", bounds).withColumn("_range", F.when(F.col(key).isNull(), -1).otherwise(below)).drop("_bounds")
    # At most one row per range: the first key of each, and the range that it follows. The greatest key follows the last range.
    heads = dealt.groupBy("_range").agg(F.max(key).alias("_head"))
    order = Window.orderBy("_range")
    after = F.coalesce(F.lead("_range").over(order), F.min("_range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select(F.col("_range").alias("_of"), "_head", after.alias("_to"))
    guests = dealt.join(F.broadcast(heads), (F.col("_range") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_head")))
    guests = guests.withColumn("_range", F.col("_to")).drop("_of", "_head", "_to").withColumn("_guest", F.lit(True))
    rows = dealt.withColumn("_guest", F.lit(False)).unionByName(guests)
    rows = prepare(rows.repartition(n // spread, "_range"))
    window = Window.partitionBy("_range").orderBy("_guest", F.col(key).desc_nulls_last(), *(F.hash(c) for c in carried[:1]), *carried[:1])
    rows = rows.select("*", *(F.lead(c).over(window).alias(f"next_{c}") for c in carried))
    return rows.where(~F.col("_guest")).drop("_guest", "_range")


def edited_fingerprints(docs: DataFrame, k: int = 4, w: int = 4) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next document's are.

    The edited text has its last floor(n / 3) code points replaced by the first as many (or all) of the next document's, by
    descending doc_id; the last document's next is the first. NULL texts are empty. Rows that share a doc_id go by their text, rows
    without one come last; a lone row is its own next. Other columns are ignored.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))

    def own(rows: DataFrame) -> DataFrame:
        return with_winnowed(rows, F.col("text"), "chosen", k, w).withColumn("set", hashes(F.col("chosen"))).withColumn("own", digest(F.col("chosen"))).drop("chosen")

    pairs = with_next(texts, "doc_id", ["text", "set"], own)
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - third), F.substr("next_text", F.lit(1), third))
    pairs = pairs.select("doc_id", n.cast("long").alias("n_chars"), "own", "set", "next_set", edited.alias("edited"))
    pairs = with_winnowed(pairs, F.col("edited"), "chosen", k, w)
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("own").alias("fingerprint"),
        digest(F.col("chosen")).alias("edited_fingerprint"),
        likeness(F.col("set"), hashes(F.col("chosen"))).alias("near_edited"),
        likeness(F.col("set"), F.col("next_set")).alias("near_next"),
    )

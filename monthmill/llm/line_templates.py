"""Line dedup by a template tree of fixed depth; lines whose template recurs in other documents are dropped.

Only DataFrame functions. The tree: words with a digit become a wildcard, then a line goes to the leaf of its number of words
and its `depth` leading words. In a leaf, a line's words are `RUNS` runs (one a word, if it has fewer words), each known by a
hash. Two lines are of one template if at most 3 runs in 16 differ; those are its variable fields.

With d runs allowed to differ, one of d + 1 bands of runs is equal in both lines. So a line meets, for each of its bands,
the first line of its leaf with that band (and, word for word, the first equal line): the template it is compared with.
Sums and minima replace pairs: nothing is collected per template, so one on a third of all lines costs a row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import staged, text_or_empty

WILDCARD = "<*>"
BLANKS = " \t\n\x0b\x0c\r"
RUNS, VARIABLE = 16, 3
#: A line of fewer words is no template by its wildcards alone.
SHORT = 4


def _with_words(each: DataFrame, short: bool) -> DataFrame:
    """`each` with the words of its lines, those with a digit as wildcards. With `short`, lines of fewer than `SHORT` words that
    would be wildcards only keep their words. One column after another, so that each is worked out once; the rarer repairs
    run only where they are needed.
    """
    blanks = F.contains("line", F.lit("  "))
    for blank in BLANKS[1:]:
        blanks = blanks | F.contains("line", F.lit(blank))
    spaced = F.trim(F.when(blanks, F.regexp_replace("line", r"[\x20\x09-\x0D]+", " ")).otherwise(F.col("line")))
    marked = F.when(F.regexp_like("line", F.lit("[0-9]")), F.regexp_replace("line", r"[^ ]*[0-9][^ ]*", WILDCARD)).otherwise(F.col("line"))
    each = each.withColumn("line", spaced).withColumn("marked", marked)
    bare = F.col("marked").isin([" ".join([WILDCARD] * n) for n in range(1, SHORT)]) if short else F.lit(False)
    return each.withColumn("words", F.split(F.when(bare, F.col("line")).otherwise(F.col("marked")), " ")).drop("line", "marked")


def _slices(items: Column, size: Column, parts: Column) -> Column:
    """`items` cut into `parts` runs of nearly equal length, each hashed."""
    begin = lambda i: F.floor(i * size / parts).cast("int")
    return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.hash(F.slice(items, begin(i) + 1, begin(i + 1) - begin(i))))


def _row_key() -> Column:
    """Names equal rows alike: the id and a hash of the text."""
    return F.xxhash64("doc_id", text_or_empty())


def lines(docs: DataFrame, depth: int = 3, min_words: int = 4) -> DataFrame:
    """Every line of at least `min_words` words, never a blank one: doc_id, row, pos (from 0), leaf and runs."""
    each = docs.select("doc_id", _row_key().alias("row"), F.posexplode(F.split(text_or_empty(), "\n")).alias("pos", "line"))
    # A condition on the words would split each line once more, so blank lines go by their text.
    each = each.where(F.regexp_like("line", F.lit(r"[^\x20\x09-\x0D]")))
    words = _with_words(each, min_words < SHORT)
    if min_words > 1:
        words = words.where(F.size("words") >= min_words)
    return words.withColumn("n", F.size("words")).select(
        "doc_id",
        "row",
        "pos",
        F.xxhash64("n", F.slice("words", 1, depth)).alias("leaf"),
        _slices(F.col("words"), F.col("n"), F.least("n", F.lit(RUNS))).alias("runs"),
    )


def _allowed() -> Column:
    return F.floor(F.size("runs") * VARIABLE / RUNS).cast("int")


def repeats(found: DataFrame) -> DataFrame:
    """The lines (row, pos) whose template an earlier document, one of a smaller doc_id, has too."""
    # Equal lines have equal runs, so this names a line and need not be kept.
    found = found.withColumn("whole", F.xxhash64("leaf", "runs"))
    equal = found.groupBy("leaf", "whole").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count_if(F.col("doc_id").isNull()).alias("nameless"))
    recurring = equal.where((F.col("first") < F.col("last")) | (F.col("nameless") > 0) & F.col("first").isNotNull())
    later = F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first"))

    # Only leaves with different lines can hold variable fields.
    mixed = equal.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    distinct = found.join(mixed, "leaf", "left_semi").groupBy("leaf", "whole", "runs").agg(F.min("doc_id").alias("doc_id"))
    bands = _slices(F.col("runs"), F.size("runs"), F.col("allowed") + 1)
    banded = distinct.withColumn("allowed", _allowed()).where("allowed > 0").select("leaf", "whole", "runs", "doc_id", "allowed", F.posexplode(bands).alias("band", "value"))
    key = ["leaf", "allowed", "band", "value"]
    template = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "whole", "runs"))).alias("template")
    templates = banded.groupBy(*key).agg(template).where("template is not null")
    differing = F.size(F.filter(F.zip_with("runs", "template.runs", lambda a, b: a != b), lambda x: x))
    near = banded.join(templates, key).where((F.col("whole") != F.col("template.whole")) & (differing <= F.col("allowed")))
    near = near.select("whole", F.col("template.doc_id").alias("first"))
    first = recurring.select("whole", "first").unionByName(near).groupBy("whole").agg(F.min("first").alias("first"))
    return found.select("whole", "doc_id", "row", "pos").join(first, "whole").where(later).select("row", "pos")


def dedup(docs: DataFrame, depth: int = 3, min_words: int = 4) -> DataFrame:
    """`docs` without the lines that repeat a template of an earlier document, and with n_lines and n_dropped.

    The template's first document keeps it, with all its repeats in that document. Lines are what line feeds part; lines
    of fewer than `min_words` words stay, as do blank lines. A NULL text has no line to drop and stays NULL; an empty one has one empty line.
    Rows without doc_id come after all others. Rows with one doc_id are one document and never repeat each other. Columns
    of the names n_lines and n_dropped are replaced.
    """
    found = staged(lines(docs, depth, min_words), "lines")
    drops = repeats(found).groupBy(F.col("row").alias("_drop_row")).agg(F.collect_set("pos").alias("_drop"))
    parts = F.split(text_or_empty(), "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "_drop"), lambda n: F.get(parts, n))
    out = docs.drop("n_lines", "n_dropped").withColumn("_drop_key", _row_key())
    # Each task holds its share of the drop lists, and need not sort the texts.
    out = out.join(drops.hint("shuffle_hash"), F.col("_drop_key") == F.col("_drop_row"), "left").withColumns(
        {
            "n_lines": F.when(F.col("text").isNotNull(), F.size(parts)).otherwise(0).cast("long"),
            "n_dropped": F.coalesce(F.size("_drop"), F.lit(0)).cast("long"),
            "text": F.when(F.col("_drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return out.drop("_drop_key", "_drop_row", "_drop")

"""From raw documents to packed training sequences, one stage after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import line_templates, packing, quality, simhash
from monthmill.llm.common import staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts. It learns from the labelled ones among `docs`."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines, short ones too, of templates that an earlier document has; one that loses all its wording goes."""
    out = line_templates.dedup(docs, min_words=1)
    left = (F.col("n_dropped") == 0) | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return out.where(left).select(*(n_chars if c == "n_chars" else c for c in docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints differ in at most 3 bits."""
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the classifier, nor the hash function, nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

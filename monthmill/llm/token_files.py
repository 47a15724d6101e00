"""Token counts of the documents in flat token files without an index, by a scan for separators.

A file is nothing but token ids of fixed width, each document's followed by an end-of-document id. Files are read in blocks of
equal size by as many tasks as there are blocks; a block's separators are found by one vector comparison. A document that
crosses blocks is stitched by a prefix scan over the blocks of its file, in two levels (groups of blocks, then blocks), so
that a file of any length is no single task's work.

Files are written and read through the file system that the folder's URI names, so any shared store will do. A writing task
that is run again writes a file of another name; the manifest, which Spark commits, knows the one that counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthmill.llm import byte_bpe
from monthmill.llm.common import shared_dir, staged


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, width: int = 2) -> DataFrame:
    """Write the ids of every text to `folder`, one file per task, and give the manifest: file, ordinal, doc_id.

    `width` is the bytes of an id. The manifest has the order of the documents in each file, and no place in it. A NULL
    text is empty: its separator follows the one before. Repeated rows are written as often as they come. The tokenizer's
    added tokens are ordinary text here: the id of one that is also the separator would cut its document in two.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    if end_id >= 1 << 8 * width:
        raise ValueError("the end-of-document id doesn't fit the width")
    end = int(end_id).to_bytes(width, "little")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, name, ordinal, out = byte_bpe.load(tokenizer).encode, f"{uuid.uuid4().hex}.tokens", 0, None
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}")
            for text in batch["text"]:
                ids = np.frombuffer(encode(text or ""), "<u4")
                if len(ids) and ids.max() >= 1 << 8 * width:
                    raise ValueError("a token id doesn't fit the width")
                out.write(ids.astype(kind).tobytes() + end)
            numbers = np.arange(ordinal, ordinal + len(batch))
            ordinal += len(batch)
            yield pd.DataFrame({"file": name, "ordinal": numbers, "doc_id": batch["doc_id"]})
        if out is not None:
            out.close()

    # Ids travel as text, since pandas would make floats of a column of longs with a NULL.
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    manifest = rows.mapInPandas(write, "file string, ordinal long, doc_id string")
    return staged(manifest.withColumn("doc_id", F.col("doc_id").cast("long")), "manifest")


def blocks_of(spark: SparkSession, folder: str, files: DataFrame, width: int, block_tokens: int) -> DataFrame:
    """file, block, begin and tokens of every block of the `files` (column file) in `folder`; a torn last id is left out."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.tokens").load(folder)
    listed = listed.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.floor(F.col("length") / width).alias("size"))
    sizes = listed.join(files.select("file").distinct(), "file", "left_semi").where("size > 0")
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(block_tokens).cast("long")))
    rows = sizes.select("file", "size", begin.alias("begin"))
    tokens = F.least(F.lit(block_tokens), F.col("size") - F.col("begin"))
    return rows.select("file", F.floor(F.col("begin") / block_tokens).alias("block"), "begin", tokens.alias("tokens"))


def separators(blocks: DataFrame, folder: str, end_id: int, width: int) -> DataFrame:
    """`blocks` with `ends`: the places in the file, in ids, of the separators in each block."""
    kind = {2: "<u2", 4: "<u4"}[width]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.itertuples(index=False):
                with store.open_input_file(f"{base}/{row.file}") as file:
                    ids = np.frombuffer(file.read_at(int(row.tokens) * width, int(row.begin) * width), kind)
                ends = np.flatnonzero(ids == end_id) + row.begin
                yield pd.DataFrame({"file": [row.file], "block": [row.block], "begin": [row.begin], "tokens": [row.tokens], "ends": [ends]})

    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.repartition(n, "file", "block")
    return dealt.mapInPandas(find, "file string, block long, begin long, tokens long, ends array<long>")


def stitched(found: DataFrame, group: int = 1024) -> DataFrame:
    """file, ordinal, start and n_tokens of every document; what follows the last separator of a file is one, if anything does."""
    found = found.withColumn("n", F.size("ends")).withColumn("last", F.array_max("ends")).withColumn("group", F.floor(F.col("block") / group))
    groups = found.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    before = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    carried = groups.select("file", "group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("docs"), F.coalesce(F.max("last").over(before), F.lit(-1)).alias("end"))
    before = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = found.withColumn("docs_in", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("end_in", F.max("last").over(before))
    rows = inside.join(carried, ["file", "group"]).select("file", "ends", (F.col("docs") + F.col("docs_in")).alias("docs"), F.coalesce("end_in", "end").alias("end"))
    each = rows.select("file", "docs", "end", "ends", F.posexplode("ends").alias("pos", "at"))
    start = F.when(F.col("pos") == 0, F.col("end")).otherwise(F.get("ends", F.col("pos") - 1)) + 1
    each = each.select("file", (F.col("docs") + F.col("pos")).alias("ordinal"), start.alias("start"), "at")
    whole = found.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"), F.sum("tokens").alias("at"))
    return each.unionByName(whole.where("start < at")).select("file", "ordinal", "start", (F.col("at") - F.col("start")).alias("n_tokens"))


def scan(spark: SparkSession, folder: str, files: DataFrame, end_id: int, width: int = 2, block_tokens: int = 1 << 21) -> DataFrame:
    """file, ordinal, start and n_tokens (without the separator) of every document in the `files` of `folder`."""
    blocks = blocks_of(spark, folder, files, width, block_tokens)
    return stitched(staged(separators(blocks, folder, end_id, width), "separators"))


def token_counts(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2, block_tokens: int = 1 << 21) -> DataFrame:
    """doc_id and n_tokens of every row of `docs`, counted in flat token files that are written first.

    An empty or NULL text has none. Repeated rows, and rows without doc_id, are counted as often as they come; an empty table
    writes no file and gives no row; columns beside doc_id and text are ignored.
    """
    spark = docs.sparkSession
    folder = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    manifest = write_token_files(docs, folder, tokenizer, end_id, width)
    if manifest.isEmpty():
        return manifest.select("doc_id", F.lit(0).cast("long").alias("n_tokens"))
    counted = scan(spark, folder, manifest, end_id, width, block_tokens)
    return manifest.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens")

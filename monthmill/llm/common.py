"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of `documents`, which every stage but the last of a pipeline hands on.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. A session without one, as in tests, gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = "file://" + tempfile.mkdtemp(prefix="monthmill-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back, so that lost executors repeat nothing before it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` with its lineage cut, in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def hex16(column: Column) -> Column:
    """A bigint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] = ()) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df

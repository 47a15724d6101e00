"""Spark session settings and the staging folder shared by all executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from .schemas import SELDOM_REPEATED


def build_session(app_name: str = "monthmill", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans in this package rely on.

    Without ``master`` the one given to spark-submit is used.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A chain of joins on the same keys is only split if an extra shuffle is allowed.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    # The JVM never compiles methods over 8,000 bytes; wide rows run faster unfused than interpreted.
    builder = builder.config("spark.sql.codegen.hugeMethodLimit", "8000")
    # Plans here have hundreds of columns; recording a call site for each doubles the time to build them.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever store its URI names, if it is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession, root: str) -> Iterator[str]:
    """A fresh folder below ``root``, which all executors must reach; it goes when the block ends."""
    path = f"{root.rstrip('/')}/stage-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        delete_folder(spark, path)


def parquet_options(columns: list[str]) -> dict[str, str]:
    """How a Parquet table of these columns is written: columns whose values seldom repeat without a dictionary."""
    return {"compression": "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in columns if c in SELDOM_REPEATED}


def stage(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the files.

    Cuts the lineage at a layer boundary, so that a lost executor costs one
    layer and not the whole chain, and later scans read only their columns.
    """
    path = f"{root}/{name}"
    df.write.mode("overwrite").options(**parquet_options(df.columns)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def at_once(*jobs: Callable) -> list:
    """Run independent Spark jobs side by side, so that the tail of one leaves no core idle.

    They keep the caller's job group, scheduler pool and other local properties.
    """
    if not jobs:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(inherit(job)) for job in jobs]]

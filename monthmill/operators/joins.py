"""Inner joins on shared keys, whose hot keys are split while the query runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

#: Settings without which a key with a large share of the rows on either side would stay in one task.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A chain of joins on the same keys is only split if an extra shuffle is allowed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def join_all(sides: list[DataFrame], on: list[str]) -> DataFrame:
    """``sides[0] JOIN sides[1] JOIN … USING (on)``, inner, with adaptive skew splitting switched on.

    The optimizer picks broadcast or sort-merge from real sizes; a partition much larger than the others is read in
    pieces, on both sides if both are large. No job runs before the result is asked for.
    """
    for key, value in SKEW_SETTINGS.items():
        sides[0].sparkSession.conf.set(key, value)
    return reduce(lambda left, right: left.join(right, on), sides)


def lay_by_keys(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` below ``path`` as a table of the catalog whose files are buckets of ``keys``, and read it back.

    Tables of as many buckets of the same keys join and group by them without a shuffle, as often as they are read; what
    each of them costs is this one. ``buckets`` should make files of some hundred MB. A hot key fills its bucket, which
    cannot be split: such tables are for ``join_all``.
    """
    laid = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    laid.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)

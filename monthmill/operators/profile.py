"""Profiles and data-quality reports, each a DataFrame.

Values of the whole table (minimum, quartiles, bandwidth) enter as scalar
subqueries, so no row is collected and nothing is cross joined.
"""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quantiles import quantiles

QUARTILES = {"q1": 0.25, "q3": 0.75}


def row_counts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("row_count"))


def value_counts(df: DataFrame, column: str, ascending: bool = False) -> DataFrame:
    """Rows per non-NULL value, by frequency; equal counts in order of value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    first = F.asc("row_count") if ascending else F.desc("row_count")
    return counts.orderBy(first, F.asc(column))


def value_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with ``min_<column>`` and ``max_<column>`` for each column."""
    return df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """The rows at the greatest value of ``column``."""
    return df.where(F.col(column) == df.agg(F.max(column)).scalar())


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by the given columns, and by all others after them, so that they are always the same."""
    return df.orderBy(*order, *(c for c in df.columns if c not in order)).limit(n)


def rows_not_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """The rows whose text does not have the given format, NULL included."""
    return df.where(~F.coalesce(F.col(column).cast("string").rlike(pattern), F.lit(False)))


def null_report(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Number and percentage of NULLs per column, only for columns that have any.

    One scan counts all columns; an empty table gives no rows.
    """
    by = by or []
    columns = [c for c in df.columns if c not in by]
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return (
        counts.unpivot([*by, "_total"], columns, "column_name", "null_count")
        .where(F.col("null_count") > 0)
        .withColumn("null_pct", F.col("null_count") / F.col("_total") * 100)
        .drop("_total")
    )


def iqr_outliers(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    """The rows further than ``k`` interquartile ranges outside the quartiles."""
    q = quantiles(df, {column: QUARTILES}, linear=True)
    q1, q3 = F.col(f"{column}_q1"), F.col(f"{column}_q3")
    low = q.select(q1 - k * (q3 - q1)).scalar()
    high = q.select(q3 + k * (q3 - q1)).scalar()
    value = F.col(column)
    return df.where((value < low) | (value > high))


def bin_counts(df: DataFrame, column: str, width: int = 10, upper: int = 120, rest: str = "Others") -> DataFrame:
    """Rows per bin ``0-9``, ``10-19``, … below ``upper``; all else, NULL included, in ``rest``.

    Bins are closed on the left. Every bin is listed in order, also with count 0.
    """
    starts = range(0, upper, width)
    value = F.col(column)
    start = F.when((value >= 0) & (value < upper), (F.floor(value / width) * width).cast("int")).otherwise(upper)
    labels = [f"{s}-{s + width - 1}" for s in starts] + [rest]
    counts = df.groupBy(start.alias("_start")).agg(F.count(F.lit(1)).alias("_n"))
    sums = counts.agg(
        *[F.coalesce(F.sum(F.when(F.col("_start") == s, F.col("_n"))), F.lit(0)).alias(l) for s, l in zip([*starts, upper], labels)]
    )
    rows = [F.struct(F.lit(i).alias("position"), F.lit(l).alias("bin"), F.col(l).alias("row_count")) for i, l in enumerate(labels)]
    return sums.select(F.inline(F.array(*rows))).orderBy("position")


def histogram(df: DataFrame, column: str, bins: int | str = 10) -> DataFrame:
    """Equal-width bins from the least to the greatest value, the last one closed.

    ``bins="auto"`` takes the narrower of the Freedman-Diaconis and Sturges
    widths, and at least 1 for whole numbers. Empty bins are listed with 0.
    """
    whole = dict(df.dtypes)[column] in ("tinyint", "smallint", "int", "bigint")
    values = df.select(F.col(column).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    bounds = values.agg(F.min("_v").alias("low"), F.max("_v").alias("high"), F.count(F.lit(1)).alias("n")).where("n > 0")
    number = _auto_bins(df, column, whole) if bins == "auto" else F.lit(int(bins))
    flat = F.col("low") == F.col("high")
    spec = bounds.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        number.cast("int").alias("bins"),
    )
    low, high, count = (spec.select(c).scalar() for c in ("low", "high", "bins"))
    place = F.floor((F.col("_v") - low) / (high - low) * count).cast("int")
    counted = values.groupBy(F.least(place, count - 1).alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    edge = (F.col("high") - F.col("low")) / F.col("bins")
    spine = spec.select(
        F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"), "low", edge.alias("width")
    )
    return (
        spine.join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * F.col("width")).alias("bin_low"),
            (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("bin_high"),
            F.coalesce("_n", F.lit(0)).alias("row_count"),
        )
        .orderBy("bin")
    )


def _auto_bins(df: DataFrame, column: str, whole: bool) -> Column:
    q = quantiles(df, {column: QUARTILES}, linear=True)
    spread = q.select(F.col(f"{column}_q3") - F.col(f"{column}_q1")).scalar()
    n = F.col("n").cast("double")
    reach = F.col("high") - F.col("low")
    sturges = reach / (F.log2(n) + 1)
    freedman = 2 * spread / F.pow(n, F.lit(1 / 3))
    width = F.when(freedman > 0, F.least(freedman, sturges)).otherwise(sturges)
    if whole:
        width = F.greatest(width, F.lit(1.0))
    return F.greatest(F.coalesce(F.ceil(F.try_divide(reach, width)), F.lit(1)), F.lit(1))


#: Bins per bandwidth of a density. With a bin's count and first two moments the error of a point is below 2e-11 of the kernel.
BINS_PER_BANDWIDTH = 1024


def density(df: DataFrame, column: str, points: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density on an even grid, with Scott's bandwidth.

    The grid reaches ``cut`` bandwidths beyond the least and greatest value. Rows only meet a fine grid of bins, whose counts
    and moments combine map-side; the kernels are summed over the bins that hold anything, each by its Taylor series around
    the bin's middle. So a row costs the same for any number of points, and what is shuffled does not grow with the rows.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    base = values.agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.count(F.lit(1)).cast("double").alias("n"),
        F.stddev_samp("v").alias("sd"),
    ).withColumn("h", F.col("sd") * F.pow("n", F.lit(-0.2)))
    spec = base.where("h > 0").select(
        "n",
        "h",
        (F.col("low") - cut * F.col("h")).alias("start"),
        ((F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (points - 1)).alias("step"),
    )
    n, h, start, step = (spec.select(c).scalar() for c in ("n", "h", "start", "step"))
    # From here on in bandwidths from the first grid point.
    placed = values.select(((F.col("v") - start) / h).alias("u")).select("u", F.floor(F.col("u") * BINS_PER_BANDWIDTH).alias("bin"))
    middle = (F.col("bin") + 0.5) / BINS_PER_BANDWIDTH
    off = F.col("u") - middle
    bins = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"), F.sum(off).alias("m1"), F.sum(off * off).alias("m2"))
    near = bins.select(middle.alias("u"), "rows", "m1", "m2", (step / h).alias("s"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    z = F.col("u") - F.col("point") * F.col("s")
    kernels = F.exp(-z * z / 2) * (F.col("rows") - z * F.col("m1") + (z * z - 1) / 2 * F.col("m2"))
    sums = near.groupBy("point").agg(F.sum(kernels).alias("sum"))
    return (
        sums.where("sum is not null")
        .select("point", (start + F.col("point") * step).alias("x"), (F.col("sum") / (n * h * sqrt(2 * pi))).alias("density"))
        .orderBy("point")
    )

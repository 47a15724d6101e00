"""Mergeable quantile sketches: one small column per snapshot, from which quantiles of any window of snapshots follow.

``quantiles`` is exact and reads the rows again for every question. A KLL sketch keeps a sample whose size depends on its
accuracy alone; sketches merge without the rows and without losing accuracy. So months are sketched once, when they are
built, and a year's median costs twelve small rows. Sketches combine map-side, so a snapshot with most rows is no bottleneck.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a sketch: about 3 * ACCURACY values of 8 bytes for any number of rows.
ACCURACY = 4096


def rank_error(accuracy: int = ACCURACY) -> float:
    """How far, as a share of the rows, a returned value's rank lies from the wanted one, with 99 % confidence."""
    return 2.296 / accuracy**0.9021


def quantile_sketches(df: DataFrame, columns: list[str], by: list[str], accuracy: int = ACCURACY) -> DataFrame:
    """One row per group with a column ``<column>_sketch`` for each column. NULL and NaN are left out; a group of nothing else has NULL."""
    def values(c):
        v = F.col(f"`{c}`").cast("double")
        return F.when(~F.isnan(v), v)

    return df.groupBy(*by).agg(
        *[F.when(F.count(values(c)) > 0, F.kll_sketch_agg_double(values(c), F.lit(accuracy))).alias(f"{c}_sketch") for c in columns]
    )


def merge_sketches(sketches: DataFrame, columns: list[str], by: list[str], accuracy: int = ACCURACY) -> DataFrame:
    """The same for groups of groups: as if all their rows had been sketched together. NULLs among the sketches are left out."""
    some = [F.when(F.count(f"`{c}_sketch`") > 0, F.kll_merge_agg_double(f"`{c}_sketch`", F.lit(accuracy))).alias(f"{c}_sketch") for c in columns]
    return sketches.groupBy(*by).agg(*some)


def sketch_quantiles(sketches: DataFrame, wanted: dict[str, dict[str, float]], by: list[str]) -> DataFrame:
    """``<column>_<name>`` per wanted quantile, as ``quantiles`` names them, and ``<column>_n``; NULL and 0 where there are no values.

    A value is one of the column's own, and its rank lies within ``rank_error`` of the wanted one.
    """
    out = []
    for c, named in wanted.items():
        sketch = F.col(f"`{c}_sketch`")
        out += [F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))).alias(f"{c}_{name}") for name, p in named.items()]
        out.append(F.coalesce(F.kll_sketch_get_n_double(sketch), F.lit(0)).cast("long").alias(f"{c}_n"))
    return sketches.select(*by, *out)

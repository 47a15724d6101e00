"""Ratios, clipping, flags and ordinal scales."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


MAX_INT = 2**31 - 1


def whole_ratio(a: Column, b: Column) -> Column:
    """``ceil(a / b)`` as int, held to the range of int; NULL where b is 0 or NULL."""
    ratio = F.ceil(F.try_divide(a.cast("double"), b.cast("double")))
    held = F.greatest(F.least(ratio, F.lit(MAX_INT)), F.lit(-MAX_INT - 1))
    return F.when(ratio.isNotNull(), held).try_cast("int")


def fill_and_clip(c: Column, fill: Column, upper: Column) -> Column:
    """NULL becomes ``fill``; the result is held between 0 and ``upper``.

    ``least`` and ``greatest`` rank NaN above every number, so NaN ends at
    ``upper``. Both skip NULL, so a missing ``upper`` leaves the value alone.
    """
    filled = F.coalesce(c, fill)
    return F.when(filled.isNotNull(), F.least(F.greatest(filled, F.lit(0).cast("float")), upper))


def at_least(c: Column, threshold) -> Column:
    """1 where the value reaches the threshold, else 0 (also for NULL)."""
    return F.when(c >= threshold, 1).otherwise(0)


def scale_by_value(c: Column, scale: dict[str, int]) -> Column:
    return _first_match((c == text, rank) for text, rank in scale.items())


def scale_by_pattern(c: Column, scale: dict[str, int]) -> Column:
    """Ranks by SQL LIKE patterns; the first that matches wins."""
    return _first_match((c.like(pattern), rank) for pattern, rank in scale.items())


def scale_by_part(c: Column, scale: dict[str, int]) -> Column:
    """Ranks by contained text; the first that matches wins."""
    return _first_match((c.contains(part), rank) for part, rank in scale.items())


def row_sum(columns: list[str]) -> Column:
    return reduce(add, [F.col(c) for c in columns])


def total_months(years: Column, months: Column) -> Column:
    return F.try_add(F.try_multiply(years, F.lit(12)), months)


def _first_match(pairs) -> Column:
    return F.coalesce(*[F.when(hit, rank) for hit, rank in pairs])

"""Renames, schema enforcement and column subsets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the columns that exist; other names are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def enforce(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast the columns named in ``types``; text that does not fit becomes NULL.

    Columns absent from the data are skipped. ``strict`` also puts the columns
    in the order of ``types`` and drops all others.
    """
    present = df.columns
    names = [c for c in types if c in present] if strict else present
    return df.selectExpr(*[f"try_cast(`{c}` as {types[c]}) as `{c}`" if c in types else f"`{c}`" for c in names])


def lay_by(df: DataFrame, first: str, more: list[str]) -> DataFrame:
    """The rows in ranges of ``first``, one that is frequent cut further by ``more``. Grouping by these and other columns needs no shuffle then."""
    return df.repartitionByRange(*(F.col(f"`{c}`") for c in [first, *more]))


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """All columns but ``names``; the match is case-sensitive, absent names are ignored."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in names])


def rows_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: its position, type and number of non-NULL values."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    types = {field.name: field.dataType.simpleString() for field in df.schema}
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col(c).alias("non_null"),
        )
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*rows)))

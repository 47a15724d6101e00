"""One-hot and multi-hot encoding by one grouped aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import snake_case, split_list


#: Values that may become columns; more would be no schema any more.
MOST_VALUES = 10_000


def vocabulary(df: DataFrame, column: str, most: int = MOST_VALUES) -> list[str]:
    """The sorted distinct non-NULL values of a column. They become columns, so the driver has to know them.

    More than ``most`` are refused, before they all reach the driver.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return sorted(row[0] for row in found)


def one_hot(df: DataFrame, column: str, values: list[str], prefix: str) -> DataFrame:
    """Replace ``column`` by 0/1 columns ``<prefix><value in lower case>``.

    Rows equal but for ``column`` become one row. A conditional ``max`` per
    value needs one shuffle, a pivot two. Values equal but for their case share a column.
    """
    keys = [c for c in df.columns if c != column]
    spellings: dict[str, list[str]] = {}
    for value in values:
        spellings.setdefault(value.lower(), []).append(value)
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(column).isin(same), 1).otherwise(0)).alias(prefix + v) for v, same in spellings.items()]
    )


def multi_hot(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Replace a comma-separated list by 0/1 columns, one per wanted entry.

    Rows equal but for ``column`` become one row that has the entries of all.
    Entries outside ``values`` are ignored, but their row stays. The list is
    tested in place instead of exploded, so no row is multiplied.
    """
    keys = [c for c in df.columns if c != column]
    listed = df.withColumn(column, split_list(F.col(column)))
    return listed.groupBy(*keys).agg(
        *[F.max(F.when(F.array_contains(column, v), 1).otherwise(0)).alias(snake_case(v)) for v in values]
    )

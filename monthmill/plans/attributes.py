"""Customer attributes: text repair and one-hot occupations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, keep_matching, letters_only, strip_underscores
from ..operators.encode import one_hot, vocabulary
from ..operators.shape import enforce, lay_by, rename
from ..schemas import ATTRIBUTE_RENAMES, ATTRIBUTE_TYPES, SNAPSHOT, SSN_FORMAT


OCCUPATION_PREFIX = "occupation_"


def clean_attributes(bronze: DataFrame) -> DataFrame:
    """Age without underscores, occupation as letters, malformed SSNs and blanks as NULL."""
    return rename(bronze, ATTRIBUTE_RENAMES).withColumns(
        {
            "age": blank_to_null(strip_underscores(F.col("age"))),
            "occupation": blank_to_null(letters_only(F.col("occupation"))),
            "ssn": blank_to_null(keep_matching(F.col("ssn").cast("string"), SSN_FORMAT)),
        }
    )


def silver_attributes(bronze: DataFrame, occupations: list[str] | None = None, by_snapshot: bool = False) -> DataFrame:
    """Typed attributes with a 0/1 column per occupation.

    One vocabulary serves all snapshots, so the schema never drifts from month
    to month. Without ``occupations`` it is read from the data first. ``by_snapshot`` lays the rows by snapshot in the one
    shuffle that the grouping needs anyway, for a write without another; ``bronze`` is then read twice, first for the ranges.
    """
    cleaned = clean_attributes(bronze)
    if occupations is None:
        occupations = vocabulary(cleaned, "occupation")
    if by_snapshot:
        cleaned = lay_by(cleaned, SNAPSHOT, [c for c in cleaned.columns if c not in (SNAPSHOT, "occupation")])
    return enforce(one_hot(cleaned, "occupation", occupations, OCCUPATION_PREFIX), ATTRIBUTE_TYPES)

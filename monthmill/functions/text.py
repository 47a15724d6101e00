"""Text repair on columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_underscores(c: Column) -> Column:
    return F.translate(c.cast("string"), "_", "")


def strip_token(c: Column, token: str) -> Column:
    """Remove a literal token; what remains may be the empty string, not NULL."""
    return F.replace(c.cast("string"), F.lit(token), F.lit(""))


def letters_only(c: Column) -> Column:
    return F.regexp_replace(c.cast("string"), "[^a-zA-Z]", "")


def keep_matching(c: Column, pattern: str) -> Column:
    """The value where it has the given format, else NULL."""
    return F.when(c.rlike(pattern), c)


def blank_to_null(c: Column) -> Column:
    text = c.cast("string")
    return F.when(~text.rlike(r"^\s*$"), text)


def split_list(c: Column) -> Column:
    return F.split(c, r",\s*")


def number_before(c: Column, unit: str) -> Column:
    """The digits in front of a unit word, as int; NULL where the unit is absent."""
    return F.regexp_extract(c, rf"(\d+)\s{unit}", 1).try_cast("int")


def snake_case(name: str) -> str:
    return re.sub(r"[\s-]+", "_", name.lower())

"""Month and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Months a date may be moved without leaving the range of the date type.
MAX_MONTHS = 60_000_000


def months_before(day: Column, months: Column) -> Column:
    """``day`` moved back by a number of months, held to the month's end."""
    return F.when(months.between(-MAX_MONTHS, MAX_MONTHS), F.add_months(day, -months))


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def month_starts(first: Column, last: Column) -> Column:
    """Array of month starts, from the month of ``first`` up to and including ``last``."""
    return F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month"))

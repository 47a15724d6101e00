"""Loan snapshots, credit labels and bad rates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import MAX_MONTHS, days_between, months_before
from ..functions.numeric import MAX_INT, at_least, whole_ratio
from ..operators.shape import enforce, rename
from ..schemas import LABEL_COLUMNS, LOAN_RENAMES, LOAN_TYPES


def silver_loans(bronze: DataFrame, renames: dict[str, str] = LOAN_RENAMES) -> DataFrame:
    """Typed loan snapshots with month on book, missed installments and days past due.

    Missed installments are the amount overdue over the amount due, rounded
    up. Every numeric NULL becomes 0. A loan overdue without an amount due has
    no first missed date, and so no days past due. One that has missed more installments than
    a date can go back has no first missed date either, but the most days past due that an int holds. A
    projection, no shuffle.
    """
    typed = enforce(rename(bronze, renames), LOAN_TYPES)
    filled = typed.withColumns(
        {
            "mob": F.col("installment_num"),
            "installments_missed": whole_ratio(F.col("overdue_amt"), F.col("due_amt")),
        }
    ).fillna(0)
    missed = F.col("installments_missed")
    dated = filled.withColumn(
        "first_missed_date", F.when(missed > 0, months_before(F.col("snapshot_date"), missed))
    )
    return dated.withColumn(
        "dpd",
        F.when(
            F.col("overdue_amt") > 0,
            F.when(missed > MAX_MONTHS, MAX_INT).otherwise(days_between(F.col("snapshot_date"), F.col("first_missed_date"))),
        ).otherwise(0),
    )


def gold_labels(silver: DataFrame, dpd: int = 30, mob: int = 6) -> DataFrame:
    """One label per loan at month ``mob``: 1 if at least ``dpd`` days past due."""
    customer = "Customer_ID" if "Customer_ID" in silver.columns else "customer_id"
    return (
        silver.where(F.col("mob") == mob)
        .withColumns({"label": at_least(F.col("dpd"), dpd), "label_def": F.lit(f"{dpd}dpd_{mob}mob")})
        .select(*[customer if c == "customer_id" else c for c in LABEL_COLUMNS])
    )


def bad_rate_by_mob(
    silver: DataFrame, dpd: int = 30, started_before: str | None = "2024-01-01", installment: int | None = None
) -> DataFrame:
    """Share of loans at least ``dpd`` days past due, by month on book."""
    if started_before:
        silver = silver.where(F.col("loan_start_date") < F.lit(date.fromisoformat(started_before)))
    if installment is not None:
        silver = silver.where(F.col("installment_num") == installment)
    return silver.groupBy("mob").agg(F.avg(at_least(F.col("dpd"), dpd)).alias("bad_rate")).orderBy("mob")

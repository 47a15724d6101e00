"""Customer financials: repair, imputation, clipping and encodings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import (
    fill_and_clip,
    row_sum,
    scale_by_part,
    scale_by_pattern,
    scale_by_value,
    total_months,
)
from ..functions.text import blank_to_null, number_before, snake_case, strip_token, strip_underscores
from ..operators.encode import multi_hot
from ..operators.quantiles import quantiles
from ..operators.shape import enforce, lay_by, rename
from ..schemas import (
    BLANK_COLUMNS,
    CREDIT_MIX_SCALE,
    FINANCIAL_RENAMES,
    FINANCIAL_TYPES,
    FIXED_CAPS,
    GARBAGE_TOKEN,
    LOAN_KINDS,
    NO_LOAN_TYPE,
    QUANTILE_CLIPPED,
    SNAPSHOT,
    SPENDING_SCALE,
    TRANSACTION_SCALE,
    UNDERSCORE_COLUMNS,
    UPPER_QUANTILE,
)

NUMERIC = [*QUANTILE_CLIPPED, *FIXED_CAPS]


def clean_financials(bronze: DataFrame, strip_and: bool = False) -> DataFrame:
    """Text repair, then the 14 numeric columns as float; a missing loan list gets a name.

    The last entry of a list such as ``A, and B`` counts only with ``strip_and``.
    """
    df = rename(bronze, FINANCIAL_RENAMES)
    fixed = {c: F.col(c).cast("string") for c in df.columns if c in BLANK_COLUMNS}
    fixed |= {c: strip_underscores(F.col(c)) for c in UNDERSCORE_COLUMNS}
    fixed |= {c: blank_to_null(fixed[c]) for c in BLANK_COLUMNS}
    fixed |= {c: fixed.get(c, F.col(c)).try_cast("float") for c in NUMERIC}
    fixed["payment_behaviour"] = strip_token(F.col("payment_behaviour"), GARBAGE_TOKEN)
    kinds = fixed["type_of_loan"]
    if strip_and:
        kinds = F.regexp_replace(kinds, r",\s*and\s+", ", ")
    fixed["type_of_loan"] = F.coalesce(kinds, F.lit(NO_LOAN_TYPE))
    return df.withColumns(fixed)


def financial_statistics(cleaned: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """Per snapshot: the median of each numeric column and the upper cap of eight of them; ``keep`` as in ``quantiles``."""
    wanted = {c: {"median": 0.5} for c in NUMERIC}
    for c in QUANTILE_CLIPPED:
        wanted[c]["cap"] = UPPER_QUANTILE
    return quantiles(cleaned.select(SNAPSHOT, *NUMERIC), wanted, [SNAPSHOT], keep=keep)


def impute_and_clip(cleaned: DataFrame, statistics: DataFrame) -> DataFrame:
    """NULLs become the snapshot's median; values are held between 0 and the column's cap."""
    joined = cleaned.join(statistics, SNAPSHOT, "left")

    def held(c):
        cap = F.lit(FIXED_CAPS[c]).cast("float") if c in FIXED_CAPS else F.col(f"{c}_cap")
        return fill_and_clip(F.col(c), F.col(f"{c}_median"), cap).alias(c)

    return joined.select(*[held(c) if c in NUMERIC else c for c in cleaned.columns])


def count_loan_types(clipped: DataFrame) -> DataFrame:
    """0/1 per loan type; their sum replaces the reported number of loans."""
    hot = multi_hot(clipped, "type_of_loan", LOAN_KINDS).fillna(0)
    return hot.withColumn("loan_type_count_sum", row_sum([snake_case(k) for k in LOAN_KINDS])).withColumn(
        "num_of_loan", F.col("loan_type_count_sum")
    )


def encode_financials(df: DataFrame) -> DataFrame:
    """Ordinal scales and the length of the credit history in months."""
    behaviour, age = F.col("payment_behaviour"), F.col("credit_history_age")
    return df.withColumns(
        {
            "credit_mix_encoded": scale_by_value(F.col("credit_mix"), CREDIT_MIX_SCALE),
            "credit_history_years": number_before(age, "Years"),
            "credit_history_months": number_before(age, "Months"),
            "credit_history_months_total": total_months(number_before(age, "Years"), number_before(age, "Months")),
            "spending_level_encoded": scale_by_pattern(behaviour, SPENDING_SCALE),
            "transaction_value_encoded": scale_by_part(behaviour, TRANSACTION_SCALE),
        }
    )


def silver_financials(
    bronze: DataFrame,
    strip_and: bool = False,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
    by_snapshot: bool = False,
) -> DataFrame:
    """The typed financial table of all given snapshots.

    Medians and caps are those of each snapshot, taken from the values before
    clipping. Rows equal but for their loan list become one row. ``keep`` may write a table and
    read it back: the cleaned rows, so that the text is parsed once and the statistics scan narrow columns, and the
    statistics with the ranges they are found in, so that the optimizer knows their size and broadcasts them if they are small.
    ``by_snapshot`` lays the rows by snapshot in the one shuffle that the loan lists need anyway, for a write without another.
    """
    cleaned = keep(clean_financials(bronze, strip_and), "cleaned")
    clipped = impute_and_clip(cleaned, keep(financial_statistics(cleaned, keep), "statistics"))
    if by_snapshot:
        # Not by floats, of which a grouping takes 0.0 and -0.0 for one.
        text = [c for c, t in clipped.dtypes if t == "string" and c not in ("customer_id", "type_of_loan")]
        clipped = lay_by(clipped, SNAPSHOT, ["customer_id", *text])
    types = {**FINANCIAL_TYPES, **{snake_case(k): "int" for k in LOAN_KINDS}}
    return enforce(encode_financials(count_loan_types(clipped)), types, strict=True)

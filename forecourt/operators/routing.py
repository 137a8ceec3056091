"""Routing of rows by validity rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.fixed_values import BUSINESS_KEY, REJECTION_COLUMN, YEAR_RANGE
from forecourt.functions import is_filled


def listing_rules(year_range: tuple[int, int] = YEAR_RANGE) -> dict[str, Column]:
    """Reason -> condition under which a listing is rejected."""
    low, high = year_range
    return {
        "missing_vin": ~is_filled(BUSINESS_KEY),
        "invalid_year": F.col("year").isNull() | ~F.col("year").between(low, high),
        "negative_mileage": F.col("mileage") < 0,
    }


def mark_rejections(df: DataFrame, rules: Mapping[str, Column],
                    reason_column: str = REJECTION_COLUMN) -> DataFrame:
    """Add the ``reason;reason;`` text of all rules a row breaks (empty if none)."""
    parts = [F.when(broken, F.lit(f"{reason};")).otherwise(F.lit(""))
             for reason, broken in rules.items()]
    return df.withColumn(reason_column, F.concat(*parts))


def split_rejected(marked: DataFrame, reason_column: str = REJECTION_COLUMN
                   ) -> tuple[DataFrame, DataFrame]:
    """(accepted without the reason column, rejected with it)."""
    clean = F.col(reason_column) == ""
    return marked.where(clean).drop(reason_column), marked.where(~clean)


def quarantine(df: DataFrame, rules: Mapping[str, Column] | None = None
               ) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, quarantined) by ``rules``; together they are all rows.

    Both sides are lazy filters over ``df``: stage it first when it is costly.
    """
    return split_rejected(mark_rejections(df, listing_rules() if rules is None else rules))

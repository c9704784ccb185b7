"""Loans with what their earlier application says about them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import blank_when, flag
from riskloom.operators.joins import enrich

# The "no date" sentinel and the yield groups that are counted.
NO_DATE = 365243
YIELD_GROUPS = ["high", "low_normal", "low_action"]


def with_application(loans: DataFrame, prev: DataFrame, dates: list[str]) -> DataFrame:
    """Loans with the attributes of their (raw) earlier application."""
    rows = enrich(loans, prev, "SK_ID_PREV")
    return rows.withColumns(
        {
            **{f"NAME_YIELD_GROUP_{g}": flag(F.col("NAME_YIELD_GROUP") == g) for g in YIELD_GROUPS},
            **{c: blank_when(c, NO_DATE) for c in dates},
        }
    )

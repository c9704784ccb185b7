"""Earlier applications at this lender."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import blank_when, flag, member_flag, one_hot, ratio
from riskloom.operators.aggregate import Slice, aggregate_slices, heavy_keys, read_spec

KEY = "SK_ID_CURR"

# The "no date" sentinel and the columns that use it.
NO_DATE = 365243
DATE_COLUMNS = [
    "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE",
    "DAYS_LAST_DUE_1ST_VERSION",
    "DAYS_LAST_DUE",
    "DAYS_TERMINATION",
]

# Categories with a 0/1 column of their own, and the weekend.
YIELD_GROUPS = ["XNA", "high", "low_action", "low_normal", "middle"]
GOODS_CATEGORIES = ["XNA", "Mobile", "Consumer Electronics", "Computers"]
WEEKEND = ["SUNDAY", "SATURDAY"]

# Statistics per source column.
STATS = read_spec(
    """
    AMT_ANNUITY             | max mean
    AMT_APPLICATION         | max mean
    AMT_CREDIT              | max mean
    APP_CREDIT_PERC         | max mean
    AMT_DOWN_PAYMENT        | max mean
    AMT_GOODS_PRICE         | max mean
    HOUR_APPR_PROCESS_START | max mean
    RATE_DOWN_PAYMENT       | max mean
    DAYS_DECISION           | max mean
    CNT_PAYMENT             | mean sum
    CREDIT_TO_ANNUITY_RATIO | min max mean
    CREDIT_TO_GOODS_RATIO   | min max mean
    NAME_YIELD_GROUP_high       | mean
    NAME_YIELD_GROUP_low_action | mean
    NAME_YIELD_GROUP_low_normal | mean
    NAME_YIELD_GROUP_middle     | mean
    NAME_YIELD_GROUP_XNA        | mean
    NAME_GOODS_CATEGORY_XNA                  | mean
    NAME_GOODS_CATEGORY_Mobile               | mean
    NAME_GOODS_CATEGORY_Consumer Electronics | mean
    NAME_GOODS_CATEGORY_Computers            | mean
    NAME_TYPE_SUITE_Unaccompanied | mean
    IS_WEEKEND_APPR               | mean
    """
)


def loans(prev: DataFrame) -> DataFrame:
    """Row-level features; only the last application of each contract counts."""
    last = prev.where(F.col("FLAG_LAST_APPL_PER_CONTRACT") == "Y")
    last = last.withColumns({c: blank_when(c, NO_DATE) for c in DATE_COLUMNS})
    return last.withColumns(
        {
            "CREDIT_TO_ANNUITY_RATIO": ratio("AMT_CREDIT", "AMT_ANNUITY"),
            "CREDIT_TO_GOODS_RATIO": ratio("AMT_GOODS_PRICE", "AMT_CREDIT"),
            "APP_CREDIT_PERC": ratio("AMT_APPLICATION", "AMT_CREDIT"),
            **one_hot("NAME_YIELD_GROUP", YIELD_GROUPS, "NAME_YIELD_GROUP"),
            **one_hot("NAME_GOODS_CATEGORY", GOODS_CATEGORIES, "NAME_GOODS_CATEGORY"),
            "IS_WEEKEND_APPR": member_flag("WEEKDAY_APPR_PROCESS_START", WEEKEND),
            "NAME_TYPE_SUITE_Unaccompanied": flag(F.col("NAME_TYPE_SUITE") == "Unaccompanied"),
        }
    )


def slices() -> list[Slice]:
    status, kind = F.col("NAME_CONTRACT_STATUS"), F.col("NAME_CONTRACT_TYPE")
    # Prefixes (some without a separator) and the rows each stands for.
    return [
        Slice("p_", None, STATS),
        Slice("p_approved", status == "Approved", STATS),
        Slice("p_refused", status == "Refused", STATS),
        Slice("p_cash", kind == "Cash loans", STATS),
        Slice("p_cunsumer", kind == "Consumer loans", STATS),
    ]


def features(prev: DataFrame, without: Collection[str] = ()) -> DataFrame:
    return aggregate_slices(loans(prev), KEY, slices(), without, heavy_keys(prev, KEY))

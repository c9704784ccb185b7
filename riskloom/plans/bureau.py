"""Credits reported by other lenders, with their monthly balances."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import blank_when, code_value, ratio
from riskloom.operators.aggregate import Slice, aggregate, aggregate_slices, heavy_keys, read_spec
from riskloom.operators.groups import median_by
from riskloom.operators.joins import attach_small, enrich

KEY = "SK_ID_CURR"

# Days past due that a monthly status stands for.
STATUS_DAYS = {"C": 0, "X": 0, "0": 0, "1": 15, "2": 45, "3": 75, "4": 105, "5": 135}

# Statistics per source column.
BALANCE_STATS = read_spec(
    """
    MONTHS_BALANCE | min max size
    DPD            | min max mean std
    """
)
STATS = read_spec(
    """
    DAYS_CREDIT            | count mean
    CREDIT_DAY_OVERDUE     | mean sum
    DAYS_CREDIT_ENDDATE    | mean
    DAYS_ENDDATE_FACT      | mean
    AMT_CREDIT_MAX_OVERDUE | mean sum
    CNT_CREDIT_PROLONG     | mean sum
    AMT_CREDIT_SUM         | mean sum
    AMT_CREDIT_SUM_DEBT    | mean sum
    AMT_CREDIT_SUM_LIMIT   | mean sum
    AMT_CREDIT_SUM_OVERDUE | mean sum
    CREDIT_TYPE            | nunique
    DAYS_CREDIT_UPDATE     | mean
    AMT_ANNUITY            | mean sum
    BB_DPD_MEAN            | mean max
    BB_MONTHS_BALANCE_MIN  | min
    BB_MONTHS_BALANCE_MAX  | max
    BB_MONTHS_BALANCE_SIZE | mean sum
    ENDDATE_DIFF           | mean
    AMT_CREDIT_SUM_RATIO   | mean max
    DAYS_CREDIT_PLAN       | mean sum
    AMT_CREDIT_DEBT_PERC   | mean min max
    AMT_CREDIT_DEBT_DIFF   | mean sum
    """
)


def credits(bureau: DataFrame) -> DataFrame:
    """Row-level features of a reported credit."""
    b = bureau.withColumns(
        {
            "AMT_CREDIT_SUM": blank_when("AMT_CREDIT_SUM", 0),
            "AMT_CREDIT_SUM_DEBT": blank_when("AMT_CREDIT_SUM_DEBT", 0),
        }
    )
    medians = median_by(b, "CREDIT_TYPE", "AMT_CREDIT_SUM", "MEAN_AMT_CREDIT_BY_CREDIT_TYPE")
    return attach_small(b, medians, "CREDIT_TYPE").withColumns(
        {
            "ENDDATE_DIFF": F.col("DAYS_ENDDATE_FACT") - F.col("DAYS_CREDIT_ENDDATE"),
            "DAYS_CREDIT_PLAN": F.col("DAYS_CREDIT_ENDDATE") - F.col("DAYS_CREDIT"),
            "AMT_CREDIT_SUM_RATIO": ratio("AMT_CREDIT_SUM", "MEAN_AMT_CREDIT_BY_CREDIT_TYPE"),
            "AMT_CREDIT_DEBT_PERC": ratio("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM"),
            "AMT_CREDIT_DEBT_DIFF": F.col("AMT_CREDIT_SUM_DEBT") - F.col("AMT_CREDIT_SUM"),
            "AMT_CREDIT_ANNUITY_PERC": ratio("AMT_ANNUITY", "AMT_CREDIT_SUM"),
        }
    )


def balances(bureau_balance: DataFrame) -> DataFrame:
    """Monthly balances summed up per credit."""
    rows = bureau_balance.withColumn("DPD", code_value("STATUS", STATUS_DAYS))
    stats = aggregate(rows, "SK_ID_BUREAU", BALANCE_STATS)
    return stats.select("SK_ID_BUREAU", *[F.col(f"`{fn}({c})`").alias(f"BB_{c}_{fn.upper()}") for c, fn in BALANCE_STATS])


def credits_with_balances(bureau: DataFrame, bureau_balance: DataFrame) -> DataFrame:
    return enrich(credits(bureau), balances(bureau_balance), "SK_ID_BUREAU")


def slices() -> list[Slice]:
    status, kind, day = F.col("CREDIT_ACTIVE"), F.col("CREDIT_TYPE"), F.col("DAYS_CREDIT")
    # Prefixes and the rows each stands for.
    return [
        Slice("b_", None, STATS),
        Slice("b_active_", status == "Active", STATS),
        Slice("b_closed_", status == "Closed", STATS),
        Slice("b_consumer_", kind == "Consumer credit", STATS),
        Slice("b_credit_", kind == "Credit card", STATS),
        Slice("b_car_", kind == "Car loan", STATS),
        Slice("b_mortage_", kind == "Mortgage", STATS),
        Slice("b_micro_", kind == "Microloan", STATS),
        Slice("b_720_", day >= -720, STATS),
        Slice("b_365_", day >= -365, STATS),
    ]


def features(bureau: DataFrame, bureau_balance: DataFrame, without: Collection[str] = ()) -> DataFrame:
    """One row per applicant with any reported credit."""
    return aggregate_slices(credits_with_balances(bureau, bureau_balance), KEY, slices(), without, heavy_keys(bureau, KEY))

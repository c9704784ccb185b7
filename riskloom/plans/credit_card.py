"""Monthly balances of credit cards."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import blank_when, flag, ratio
from riskloom.operators.aggregate import Slice, aggregate_slices, heavy_keys, read_spec
from riskloom.operators.joins import attach
from riskloom.plans import active

KEY = "SK_ID_CURR"
LOAN = "SK_ID_PREV"
MONTH = "MONTHS_BALANCE"
DEBT = "SUM(AMT_DEBT_ACTIVE_LOAN_CREDIT)"
RECENT = -12

# Statistics per source column, over all months and over the last
# 12 and 6.
STATS = read_spec(
    """
    MONTHS_BALANCE             | count mean
    SK_DPD                     | sum max
    SK_DPD_DEF                 | sum max
    AMT_INST_MIN_REGULARITY    | mean
    AMT_PAYMENT_CURRENT        | mean
    CNT_DRAWINGS_ATM_CURRENT   | mean
    CNT_DRAWINGS_CURRENT       | mean
    CNT_DRAWINGS_POS_CURRENT   | mean
    CNT_INSTALMENT_MATURE_CUM  | mean
    AMT_DRAWINGS_CURRENT       | mean
    AMT_DRAWINGS_OTHER_CURRENT | mean
    AMT_DRAWINGS_POS_CURRENT   | mean
    AMT_DRAWINGS_ATM_CURRENT   | mean
    AMT_BALANCE_PER_LMT        | max mean
    AMT_CREDIT_LIMIT_ACTUAL    | mean
    """
)
STATS_12 = read_spec(
    """
    AMT_BALANCE_PER_LMT     | max mean
    AMT_CREDIT_LIMIT_ACTUAL | mean
    """
)
STATS_6 = read_spec(
    """
    AMT_BALANCE_PER_LMT     | min max
    AMT_CREDIT_LIMIT_ACTUAL | mean
    """
)
ACTIVE_STATS = read_spec(
    """
    DAYS_FIRST_DUE              | mean
    CNT_PAYMENT                 | mean
    AMT_ANNUITY                 | sum
    AMT_GOODS_PRICE             | sum
    NAME_YIELD_GROUP_high       | mean
    NAME_YIELD_GROUP_low_normal | mean
    NAME_YIELD_GROUP_low_action | mean
    AMT_CREDIT_SUM_DEBT_CREDIT  | sum
    """
)


def months(card: DataFrame) -> DataFrame:
    """A limit of 0 means unknown; a balance of 0 is left out of the ratio."""
    card = card.withColumn("AMT_CREDIT_LIMIT_ACTUAL", blank_when("AMT_CREDIT_LIMIT_ACTUAL", 0))
    return card.withColumn(
        "AMT_BALANCE_PER_LMT", ratio(blank_when("AMT_BALANCE", 0), "AMT_CREDIT_LIMIT_ACTUAL")
    )


def slices() -> list[Slice]:
    month = F.col(MONTH)
    return [
        Slice("credit_", None, STATS + [(MONTH, "size")]),
        Slice("credit12_", month >= -12, STATS_12),
        Slice("credit6_", month >= -6, STATS_6),
    ]


def loan_states(card: DataFrame) -> DataFrame:
    """One row per card from one pass over the months.

    The latest known limit over the lowest one; the latest balance; whether the
    card is still in use.
    """
    limit = F.col("AMT_CREDIT_LIMIT_ACTUAL")
    ends = card.where(F.col(LOAN).isNotNull()).groupBy(LOAN).agg(
        F.max(F.struct(MONTH, "AMT_BALANCE", KEY)).alias("last"),
        F.max(F.when(limit.isNotNull(), F.struct(MONTH, limit.alias("limit")))).alias("known"),
        F.min(limit).alias("lowest"),
        F.max(flag(F.col("NAME_CONTRACT_STATUS") == "Completed")).alias("completed"),
    )
    return ends.select(
        LOAN,
        F.col("last")[KEY].alias(KEY),
        F.col("last")["AMT_BALANCE"].alias("AMT_CREDIT_SUM_DEBT_CREDIT"),
        ratio(F.col("known")["limit"], "lowest").alias("CREDIT_LIMIT_LAST_BY_MIN"),
        ((F.col("completed") == 0) & (F.col("last")[MONTH] >= RECENT)).alias("is_active"),
    )


def loan_features(card: DataFrame, prev: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Per applicant: changes of limits, and totals over the cards in use."""
    slices = [
        Slice("credit_prev_", None, [("CREDIT_LIMIT_LAST_BY_MIN", "mean")]),
        Slice("credit_active_", F.col("is_active"), ACTIVE_STATS),
    ]
    rows = active.with_application(loan_states(card), prev, ["DAYS_FIRST_DUE"])
    out = aggregate_slices(rows, KEY, slices, heavy=heavy_keys(card, KEY) if heavy is None else heavy)
    return out.withColumnRenamed("credit_active_sum(AMT_CREDIT_SUM_DEBT_CREDIT)", DEBT)


def features(card: DataFrame, prev: DataFrame, without: Collection[str] = ()) -> DataFrame:
    rows, heavy = months(card), heavy_keys(card, KEY)
    sliced = aggregate_slices(rows, KEY, slices(), without, heavy).withColumnRenamed(f"credit_size({MONTH})", "CC_COUNT")
    return attach(sliced, loan_features(rows, prev, heavy), KEY)

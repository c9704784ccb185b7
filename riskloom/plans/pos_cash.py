"""Monthly balances of cash and point-of-sale loans."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import flag, member_flag, ratio
from riskloom.operators.aggregate import Slice, aggregate_slices, feature_name, heavy_keys, read_spec
from riskloom.operators.joins import attach
from riskloom.plans import active

KEY = "SK_ID_CURR"
LOAN = "SK_ID_PREV"
MONTH = "MONTHS_BALANCE"
DEBT = "SUM(AMT_DEBT_ACTIVE_LOAN_POS)"

# The statuses of a contract that runs regularly, the recent
# period in months, and statistics per source column.
REGULAR = ["Active", "Completed", "Signed", "Approved"]
RECENT = -12
STATS = read_spec(
    """
    MONTHS_BALANCE   | count mean
    SK_DPD           | sum max
    SK_DPD_DEF       | sum max
    REGULAR_CONTRACT | sum
    """
)
AHEAD = read_spec(
    """
    CNT_INSTALMENT_AHEAD       | min max
    CNT_INSTALMENT_AHEAD_RATIO | min
    """
)
AHEAD_RECENT = read_spec(
    """
    RECENT_AHEAD       | min max
    RECENT_AHEAD_RATIO | mean max
    """
)
AHEAD_NAMES = {
    "RECENT_AHEAD": "CNT_INSTALMENT_AHEAD",
    "RECENT_AHEAD_RATIO": "CNT_INSTALMENT_AHEAD_RATIO",
}
ACTIVE_STATS = read_spec(
    """
    DAYS_LAST_DUE_1ST_VERSION   | mean
    DAYS_FIRST_DUE              | mean
    CNT_PAYMENT                 | mean
    AMT_ANNUITY                 | sum
    AMT_GOODS_PRICE             | sum
    NAME_YIELD_GROUP_high       | mean
    NAME_YIELD_GROUP_low_normal | mean
    NAME_YIELD_GROUP_low_action | mean
    AMT_CREDIT_SUM_DEBT_POS     | sum
    """
)
REPRESENTATIVE = [
    "CNT_PAYMENT",
    "CREDIT_TO_GOODS_RATIO",
    "DAYS_DECISION",
    "AMT_ANNUITY",
    "NAME_TYPE_SUITE",
    "PRODUCT_COMBINATION",
    "NAME_YIELD_GROUP",
]


def months(pos: DataFrame) -> DataFrame:
    return pos.withColumn("REGULAR_CONTRACT", member_flag("NAME_CONTRACT_STATUS", REGULAR))


def slices() -> list[Slice]:
    return [Slice("pos_", None, STATS), Slice("pos12_", F.col(MONTH) >= RECENT, STATS)]


def loan_states(pos: DataFrame) -> DataFrame:
    """One row per loan from one pass over the months.

    Planned (oldest) and actual (latest) number of instalments, over all months
    and over the recent ones; whether the loan is still running; how many
    instalments are left.
    """
    value = "CNT_INSTALMENT"
    row = F.struct(MONTH, value, KEY)
    recent = F.when(F.col(MONTH) >= RECENT, row)
    ends = pos.where(F.col(LOAN).isNotNull()).groupBy(LOAN).agg(
        F.min(row).alias("first"),
        F.max(row).alias("last"),
        F.min(recent).alias("first12"),
        F.max(recent).alias("last12"),
        F.min("CNT_INSTALMENT_FUTURE").alias("CNT_INSTALMENT_FUTURE"),
        F.max(flag(F.col("NAME_CONTRACT_STATUS") == "Completed")).alias("completed"),
    )
    return ends.select(
        LOAN,
        F.col("last")[KEY].alias(KEY),
        "CNT_INSTALMENT_FUTURE",
        F.col("first12").isNotNull().alias("is_recent"),
        ((F.col("completed") == 0) & (F.col("last")[MONTH] >= RECENT)).alias("is_active"),
        *_ahead("first", "last", value, "CNT_INSTALMENT_AHEAD"),
        *_ahead("first12", "last12", value, "RECENT_AHEAD"),
    )


def _ahead(first: str, last: str, value: str, name: str) -> list[Column]:
    planned, actual = F.col(first)[value], F.col(last)[value]
    return [(planned - actual).alias(name), ratio(actual, planned).alias(f"{name}_RATIO")]


def loans(pos: DataFrame, prev: DataFrame) -> DataFrame:
    """Loan states with the earlier application and, for the debt, its annuity."""
    rows = active.with_application(loan_states(pos), prev, ["DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION"])
    return rows.withColumns(
        {
            "AMT_CREDIT_SUM_DEBT_POS": F.col("AMT_ANNUITY") * F.col("CNT_INSTALMENT_FUTURE"),
            "CREDIT_TO_GOODS_RATIO": ratio("AMT_GOODS_PRICE", "AMT_CREDIT"),
        }
    )


def loan_features(pos: DataFrame, prev: DataFrame, heavy: DataFrame | None = None) -> DataFrame:
    """Per applicant: plans cut short, totals over running loans, and the running
    loan with the largest annuity."""
    best = F.max(F.struct(F.col("AMT_ANNUITY").alias("_by"), LOAN, *REPRESENTATIVE))
    slices = [
        Slice("pos_", None, AHEAD),
        Slice("pos12_", F.col("is_recent"), AHEAD_RECENT),
        Slice("pos_active_", F.col("is_active"), ACTIVE_STATS, {"_best": best}),
    ]
    out = aggregate_slices(loans(pos, prev), KEY, slices, heavy=heavy_keys(pos, KEY) if heavy is None else heavy)
    names = {feature_name("pos12_", fn, c): feature_name("pos12_", fn, AHEAD_NAMES[c]) for c, fn in AHEAD_RECENT}
    names[feature_name("pos_active_", "sum", "AMT_CREDIT_SUM_DEBT_POS")] = DEBT
    out = out.withColumnsRenamed(names)
    return out.select("*", *[F.col("_best")[c].alias("p" + c) for c in REPRESENTATIVE]).drop("_best")


def features(pos: DataFrame, prev: DataFrame, without: Collection[str] = ()) -> DataFrame:
    heavy = heavy_keys(pos, KEY)
    return attach(aggregate_slices(months(pos), KEY, slices(), without, heavy), loan_features(pos, prev, heavy), KEY)

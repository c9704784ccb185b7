"""Instalment payments: lateness, split payments and gaps."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import gated, positive_part, ratio
from riskloom.operators.aggregate import Slice, aggregate_slices, heavy_keys, read_spec
from riskloom.operators.joins import attach, enrich
from riskloom.operators.ordered import attach_group, gap_stats, payment_gaps

KEY = "SK_ID_CURR"
LOAN = "SK_ID_PREV"
INSTALMENT = ["SK_ID_PREV", "NUM_INSTALMENT_NUMBER", "NUM_INSTALMENT_VERSION"]

# Statistics per source column, over all time and over the last
# 365 and 180 days.  The payment interval of the 365-day map is in RECENT_GAPS.
STATS = read_spec(
    """
    NUM_INSTALMENT_VERSION | nunique
    DPD                    | max mean sum min std
    DBD                    | max mean sum min std
    PAYMENT_PERC           | max mean var min std
    PAYMENT_DIFF           | max mean var min std
    AMT_INSTALMENT         | max mean sum min std
    AMT_PAYMENT            | min max mean sum std
    DAYS_ENTRY_PAYMENT     | max mean sum std
    DPD_with_prev          | min
    DPD_without_prev       | min
    DPD_RATIO              | min mean
    N_PAYMENTS             | max
    """
)
STATS_365 = read_spec(
    """
    AMT_PAYMENT        | sum
    PAYMENT_PERC       | mean min var std
    AMT_INSTALMENT     | max sum std
    PAYMENT_DIFF       | max mean var std
    DPD                | max mean sum std
    DBD                | mean
    DAYS_ENTRY_PAYMENT | mean
    """
)
STATS_180 = read_spec(
    """
    AMT_PAYMENT        | sum min max std mean
    PAYMENT_PERC       | mean min var std
    AMT_INSTALMENT     | mean sum
    PAYMENT_DIFF       | max mean
    DPD                | max mean sum std
    DBD                | max mean sum std
    DAYS_ENTRY_PAYMENT | sum
    """
)
RECENT_GAPS = ("ins365_", "DAYS_ENTRY_PAYMENT_INTERVAL", -365)


def loan_kinds(prev: DataFrame, card: DataFrame) -> DataFrame:
    """Contract type and card flag per loan, in one table so that the payments are joined once."""
    cards = card.select(LOAN).where(F.col(LOAN).isNotNull()).distinct().withColumn("is_credit", F.lit(1))
    return prev.select(LOAN, "NAME_CONTRACT_TYPE").join(cards, [LOAN], "full")


def payments(installments: DataFrame, prev: DataFrame, card: DataFrame) -> DataFrame:
    """Row-level features of a payment.

    Several payments may settle one instalment.  Lateness is split into loans
    where an earlier part came before the due date and where none did.
    """
    due, paid = F.col("DAYS_INSTALMENT"), F.col("DAYS_ENTRY_PAYMENT")
    amount, asked = F.col("AMT_PAYMENT"), F.col("AMT_INSTALMENT")
    rows = installments.withColumns(
        {
            # a whole number; a floating-point join key would cost an extra shuffle
            "NUM_INSTALMENT_VERSION": F.col("NUM_INSTALMENT_VERSION").cast("bigint"),
            "DPD": positive_part(paid - due),
            "DBD": positive_part(due - paid),
        }
    )
    on_time = F.col("DPD") == 0
    rows = attach_group(
        rows,
        INSTALMENT,
        N_PAYMENTS=F.count(amount),
        FIRST_PAYMENT=F.min(paid),
        AMT_PAYMENT_SUM_ON_SCHEDULE=F.sum(F.when(on_time, F.coalesce(amount, F.lit(0.0)))),
    )
    rows = enrich(rows, loan_kinds(prev, card), LOAN)
    rows = rows.withColumn("is_credit", F.coalesce(F.col("is_credit"), F.lit(0)))
    without, with_ = gated("DPD", F.col("FIRST_PAYMENT") < due)
    on_schedule = F.when(on_time, 0).otherwise(1) * F.col("AMT_PAYMENT_SUM_ON_SCHEDULE")
    return rows.withColumns(
        {
            "PAYMENT_PERC": ratio(amount, asked),
            "PAYMENT_DIFF": asked - amount,
            "DPD_without_prev": without,
            "DPD_with_prev": with_,
            "DPD_RATIO": F.coalesce(ratio(on_schedule, amount), F.lit(0.0)),
        }
    )


def slices() -> list[Slice]:
    kind, paid = F.col("NAME_CONTRACT_TYPE"), F.col("DAYS_ENTRY_PAYMENT")
    # Prefixes and the rows each stands for.
    return [
        Slice("ins_", None, STATS),
        Slice("ins_consumer_", kind == "Consumer loans", STATS),
        Slice("ins_cash_", kind == "Cash loans", STATS),
        Slice("ins_credit_", F.col("is_credit") == 1, STATS),
        Slice("ins365_", paid >= -365, STATS_365),
        Slice("ins180_", paid >= -180, STATS_180),
    ]


def recent_gaps(installments: DataFrame) -> DataFrame:
    """Intervals between payments; each reaches back to the previous payment, however old."""
    prefix, name, since = RECENT_GAPS
    gaps = payment_gaps(installments, KEY, LOAN, "DAYS_ENTRY_PAYMENT")
    return gap_stats(gaps.where(F.col("DAYS_ENTRY_PAYMENT") >= since), KEY, prefix, name)


def features(installments: DataFrame, prev: DataFrame, card: DataFrame, without: Collection[str] = ()) -> DataFrame:
    rows = payments(installments, prev, card)
    return attach(aggregate_slices(rows, KEY, slices(), without, heavy_keys(installments, KEY)), recent_gaps(installments), KEY)

"""First/last rows, gaps, active loans.

"Latest" and "earliest" are max/min over a struct, which combine before the
shuffle, so a key with a great many rows is never sorted in one task.  The
struct lists the order column first and the carried columns after it: ties are
broken by the carried values and the result does not depend on input order.
Missing values sort lowest, as they do at the end of a descending sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import flag, named, ratio
from riskloom.operators.joins import attach, only_keys


def latest(order: str, carried: Sequence[str]) -> Column:
    """Aggregate: the carried values of the row with the highest order value."""
    return F.max(F.struct(named(order), *[named(c) for c in carried]))


def earliest(order: str, carried: Sequence[str]) -> Column:
    return F.min(F.struct(named(order), *[named(c) for c in carried]))


def latest_row(df: DataFrame, key: str, order: str, carried: Sequence[str]) -> DataFrame:
    """One row per key: the latest, its missing values included."""
    picked = df.where(named(key).isNotNull()).groupBy(key).agg(latest(order, carried).alias("_r"))
    return picked.select(named(key), "_r.*")


def earliest_row(df: DataFrame, key: str, order: str, carried: Sequence[str]) -> DataFrame:
    picked = df.where(named(key).isNotNull()).groupBy(key).agg(earliest(order, carried).alias("_r"))
    return picked.select(named(key), "_r.*")


def latest_present(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The latest value per key that is not missing."""
    return latest_row(df.where(named(value).isNotNull()), key, order, [value])


def planned_and_actual(df: DataFrame, loan: str, owner: str, order: str, value: str) -> DataFrame:
    """First (planned) against last (actual) value per loan, with difference and ratio."""
    ends = df.where(named(loan).isNotNull()).groupBy(loan).agg(
        earliest(order, [value, owner]).alias("_first"), latest(order, [value, owner]).alias("_last")
    )
    out = ends.select(
        named(loan),
        F.col("_first")[owner].alias(owner),
        F.col("_first")[value].alias(f"PLANNED_{value}"),
        F.col("_last")[value].alias(f"ACTUAL_{value}"),
    )
    return out.withColumns(
        {
            f"{value}_AHEAD": named(f"PLANNED_{value}") - named(f"ACTUAL_{value}"),
            f"{value}_AHEAD_RATIO": ratio(f"ACTUAL_{value}", f"PLANNED_{value}"),
        }
    )


def last_by_min(df: DataFrame, loan: str, owner: str, order: str, value: str, name: str) -> DataFrame:
    """The latest non-missing value over the smallest, per loan of an owner."""
    present = F.when(named(value).isNotNull(), F.struct(named(order), named(value)))
    per_loan = df.where(named(loan).isNotNull()).groupBy(loan, owner).agg(
        F.max(present).alias("_last"), F.min(named(value)).alias("_min")
    )
    return per_loan.select(named(loan), named(owner), ratio(F.col("_last")[value], F.col("_min")).alias(name))


def payment_gaps(df: DataFrame, owner: str, loan: str, day: str) -> DataFrame:
    """Days between consecutive payments of a loan, per distinct payment day.

    Equal days are counted before the window runs, so a window holds at most
    one row per calendar day of a loan however many payments it has.  Of the
    ``n`` payments on a day, ``n - 1`` follow another on the same day (gap 0)
    and one has the given gap to the next older day, NULL on the oldest.
    """
    days = (
        df.where(named(loan).isNotNull() & named(day).isNotNull())
        .groupBy(owner, loan, day)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    older = F.lag(named(day)).over(Window.partitionBy(owner, loan).orderBy(named(day)))
    return days.withColumn("gap", named(day) - older)


def gap_stats(gaps: DataFrame, owner: str, prefix: str, name: str) -> DataFrame:
    """Mean and minimum gap per owner from :func:`payment_gaps`."""
    known = F.col("n") - F.when(F.col("gap").isNull(), 1).otherwise(0)
    least = F.when(F.col("n") > 1, F.least(F.lit(0.0), F.col("gap"))).otherwise(F.col("gap"))
    return gaps.groupBy(owner).agg(
        F.try_divide(F.sum(F.coalesce(F.col("gap"), F.lit(0.0))), F.sum(known).cast("double")).alias(f"{prefix}mean({name})"),
        F.min(least).alias(f"{prefix}min({name})"),
    )


def largest_row(df: DataFrame, key: str, by: str, tie: str, carried: Sequence[str]) -> DataFrame:
    """One representative row per key: the largest ``by`` (missing last), ties by ``tie``."""
    best = F.max(F.struct(named(by).alias("_by"), named(tie).alias("_tie"), *[named(c) for c in carried]))
    picked = df.where(named(key).isNotNull()).groupBy(key).agg(best.alias("_r"))
    return picked.select(named(key), *[F.col("_r")[c].alias(c) for c in carried])


def active_loans(df: DataFrame, loan: str, month: str, status: str, since: int = -12) -> DataFrame:
    """Ids of loans never reported as completed whose latest month is recent enough."""
    state = df.where(named(loan).isNotNull()).groupBy(loan).agg(
        F.max(named(month)).alias("_last"), F.max(flag(named(status) == "Completed")).alias("_done")
    )
    return state.where((F.col("_last") >= since) & (F.col("_done") == 0)).select(named(loan))


def active_rows(df: DataFrame, loan: str, month: str, status: str, since: int = -12) -> DataFrame:
    """The rows of the active loans."""
    return only_keys(df, active_loans(df, loan, month, status, since), loan)


def attach_group(df: DataFrame, by: Sequence[str], **stats: Column) -> DataFrame:
    """Several statistics of a row's group attached to the row, from one groupBy."""
    grouped = df.dropna(subset=list(by)).groupBy(*by).agg(*[c.alias(n) for n, c in stats.items()])
    return attach(df, grouped, by)

"""Exact area under the ROC curve, without ranking the whole table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import named
from riskloom.operators.joins import attach_small
from riskloom.session import computed

# Distinct scores of one range; a task sorts one range.
RANGE_SCORES = 100_000


def auc(df: DataFrame, label: str, score: str, by: str | None = None) -> DataFrame:
    """One row per group (or one row): ``auc``, with tied scores counted half.

    Rows are first counted per distinct score.  Quantiles of the distinct
    scores then cut each group into ranges of about equal size, as many as its number of scores asks for; the running
    count of negatives is taken inside a range and the totals of the ranges
    before it are added, so no task sees more than one range.  A group with
    only one class has a NULL result.
    """
    group = ["_g"] if by else []
    rows = df.where(named(label).isNotNull() & named(score).isNotNull())
    if by:
        rows = rows.withColumn("_g", named(by))
    counts = rows.groupBy(*group, named(score).cast("double").alias("_s")).agg(
        F.sum((named(label) == 1).cast("bigint")).alias("_pos"),
        F.sum((named(label) != 1).cast("bigint")).alias("_neg"),
    )
    counts = computed(counts)
    most = counts.groupBy(*group).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    ranges = -(-most // RANGE_SCORES)
    if ranges > 1:
        cuts = F.percentile_approx("_s", [i / ranges for i in range(1, ranges)], 100 * ranges).alias("_cuts")
        found = counts.groupBy(*group).agg(cuts)
        ranged = attach_small(counts, found, "_g", how="inner") if by else counts.withColumn("_cuts", found.scalar())
        ranged = ranged.select(*group, "_s", "_pos", "_neg", F.size(F.filter("_cuts", lambda c: c < F.col("_s"))).alias("_range"))
    else:
        ranged = counts.withColumn("_range", F.lit(0))
    inside = Window.partitionBy(*group, "_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    ranges = (
        ranged.withColumn("_below", below)
        .groupBy(*group, "_range")
        .agg(
            F.sum(F.col("_pos").cast("double") * (2 * F.col("_below") + F.col("_neg"))).alias("_twice"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
        )
    )
    # a row for each range and group from here on
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_neg").over(before), F.lit(0))
    total = (
        ranges.withColumn("_before", offset)
        .groupBy(*group)
        .agg(
            F.sum(F.col("_twice") + 2.0 * F.col("_pos") * F.col("_before")).alias("_twice"),
            F.sum("_pos").alias("_pos"),
            F.sum("_neg").alias("_neg"),
        )
    )
    pairs = F.col("_pos").cast("double") * F.col("_neg")
    value = F.try_divide(F.col("_twice"), 2 * pairs).alias("auc")
    return total.select(F.col("_g").alias(by), value) if by else total.select(value)


def auc_value(df: DataFrame, label: str, score: str) -> float | None:
    row = auc(df, label, score).first()
    return None if row is None else row["auc"]


def auc_per_group(df: DataFrame, label: str, score: str, by: str) -> dict:
    """The metric per fold, as a small dict."""
    return {r[by]: r["auc"] for r in auc(df, label, score, by).collect()}

"""Group-relative features, pooled means, encodings, event rates and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import flag, named, ratio
from riskloom.operators.joins import attach_small
from riskloom.session import computed

# Accuracy asked of the quantile summary, how many of its rank errors the bracket
# around the median leaves on each side, and how many rows of one group may lie
# inside the bracket before it is narrowed.
QUANTILE_ACCURACY = 10_000
BRACKET_ERRORS = 4
BRACKET_ROWS = 5_000_000
CUTS = 100


def medians_by(df: DataFrame, by: str, targets: dict[str, str]) -> DataFrame:
    """Exact interpolated medians per group, without gathering a group in memory.

    ``targets`` maps columns to output names; all of them share the passes.  A
    mergeable quantile summary brackets the middle of every group to a small
    fraction of its rows, once more for groups so large that even this fraction
    is big.  The last pass counts what lies below the bracket and keeps distinct
    values, with their counts, only inside it; the running count over those picks
    the one or two middle values.  Groups whose bracket missed the middle are done again
    with a bracket around all their values, narrowed anew, and at last not narrowed.
    """
    pairs = F.array(
        *[F.struct(F.lit(i).alias("t"), named(c).cast("double").alias("x")) for i, c in enumerate(targets)]
    )
    rows = (
        df.where(named(by).isNotNull())
        .select(named(by).alias("_g"), F.inline(pairs).alias("_t", "_x"))
        .where(F.col("_x").isNotNull())
    )
    brackets = _brackets(rows)
    picked = computed(_picked(rows, brackets))
    for narrow in (True, False):
        missed = picked.where(F.col("_lo").isNull() | F.col("_hi").isNull()).select("_g", "_t")
        if missed.isEmpty():
            break
        again = attach_small(rows, missed, ["_g", "_t"], how="inner")
        whole = again.groupBy("_g", "_t").agg(F.min("_x").alias("_from"), F.max("_x").alias("_to"), F.count(F.lit(1)).alias("_n"))
        wide = computed(whole)
        found = _picked(again, (_small(again, wide) if narrow else wide).drop("_n"))
        picked = computed(picked.join(missed, ["_g", "_t"], "left_anti").unionByName(found))
    middle = F.col("_lo") + (F.col("_hi") - F.col("_lo")) / 2
    medians = picked.select(F.col("_g").alias(by), "_t", middle.alias("_m"))
    return medians.groupBy(by).agg(
        *[F.max(F.when(F.col("_t") == i, F.col("_m"))).alias(name) for i, name in enumerate(targets.values())]
    )


def _picked(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """The two middle values of each group, NULL where they lie outside its bracket."""
    counted = (
        attach_small(rows, brackets, ["_g", "_t"], how="inner", ready=True)
        .select("_g", "_t", _zone(F.col("_x")).alias("_zone"), "_x")
        .groupBy("_g", "_t", "_zone", F.when(F.col("_zone") == 0, F.col("_x")).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    within = Window.partitionBy("_g", "_t")
    running = within.orderBy("_zone", "_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns({"_upto": F.sum("_n").over(running), "_all": F.sum("_n").over(within)})
    low, high = _middle_ranks(F.col("_all"))

    def holds(rank: Column) -> Column:
        return (F.col("_zone") == 0) & (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n"))

    return ranked.groupBy("_g", "_t").agg(
        F.max(F.when(holds(low), F.col("_v"))).alias("_lo"),
        F.max(F.when(holds(high), F.col("_v"))).alias("_hi"),
    )


def _middle_ranks(n: Column) -> tuple[Column, Column]:
    """1-based ranks of the two middle rows; they coincide for an odd count."""
    return F.floor((n + 1) / 2), F.floor((n + 2) / 2)


def _zone(x: Column) -> Column:
    """Below, inside or above the bracket of the row's group."""
    return F.when(x < F.col("_from"), -1).when(x > F.col("_to"), 1).otherwise(0)


def _brackets(rows: DataFrame) -> DataFrame:
    """Per group, two values with the middle between them; one row per group."""
    margin = BRACKET_ERRORS / QUANTILE_ACCURACY
    ends = F.percentile_approx("_x", [0.5 - margin, 0.5 + margin], QUANTILE_ACCURACY)
    found = rows.groupBy("_g", "_t").agg(ends.alias("_b"), F.count(F.lit(1)).alias("_n"))
    found = computed(found.select("_g", "_t", F.col("_b")[0].alias("_from"), F.col("_b")[1].alias("_to"), "_n"))
    largest = found.agg(F.max("_n")).first()[0] or 0
    if largest * 2 * (BRACKET_ERRORS + 1) / QUANTILE_ACCURACY > BRACKET_ROWS:
        found = _small(rows, found)
    return found.drop("_n")


def _small(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Brackets narrowed until none holds more than ``BRACKET_ROWS`` rows, counted, or narrowing gains nothing more."""
    before = None
    while True:
        zone = attach_small(rows, brackets, ["_g", "_t"], how="inner", ready=True).where(_zone(F.col("_x")) == 0)
        inside = zone.groupBy("_g", "_t").count().agg(F.max("count")).first()[0] or 0
        if inside <= BRACKET_ROWS or before is not None and inside >= before:
            return brackets
        before = inside
        brackets = computed(_narrowed(rows, brackets))


def _narrowed(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Each bracket cut into hundredths, keeping the few around the middle."""
    zone, x = _zone(F.col("_x")), F.col("_x")
    stats = attach_small(rows, brackets, ["_g", "_t"], how="inner", ready=True).groupBy("_g", "_t", "_from", "_to", "_n").agg(
        F.count(F.when(zone < 0, 1)).alias("_below"),
        F.count(F.when(zone == 0, 1)).alias("_inside"),
        F.percentile_approx(F.when(zone == 0, x), [j / CUTS for j in range(1, CUTS)], QUANTILE_ACCURACY).alias("_c"),
    )
    low, high = _middle_ranks(F.col("_n"))
    first = (F.floor(CUTS * (low - F.col("_below")) / F.col("_inside")) - 2).cast("int")
    last = (F.ceil(CUTS * (high - F.col("_below")) / F.col("_inside")) + 2).cast("int")
    return stats.select(
        "_g",
        "_t",
        F.when(first >= 1, F.try_element_at("_c", F.greatest(first, F.lit(1)))).otherwise(F.col("_from")).alias("_from"),
        F.when(last < CUTS, F.try_element_at("_c", F.greatest(last, F.lit(1)))).otherwise(F.col("_to")).alias("_to"),
        "_n",
    )


def median_by(df: DataFrame, by: str, target: str, name: str) -> DataFrame:
    return medians_by(df, by, {target: name})


def relative_to_median(df: DataFrame, by: str, targets: dict[str, str]) -> DataFrame:
    """Each value over its group's median; NULL where the group is missing.

    ``targets`` maps a column to the name of its relative value.
    """
    medians = {c: f"_median_{i}" for i, c in enumerate(targets)}
    out = attach_small(df, medians_by(df, by, medians), by)
    out = out.withColumns({name: ratio(c, medians[c]) for c, name in targets.items()})
    return out.drop(*medians.values())


def fill_with_mean(df: DataFrame, column: str, fit_on: Column | None = None) -> DataFrame:
    """Fill missing values with the column's mean over the table (or over ``fit_on`` rows).

    The mean is a scalar subquery: one value, no join.
    """
    rows = df if fit_on is None else df.where(fit_on)
    mean = rows.select(F.avg(named(column))).scalar()
    return df.withColumn(column, F.coalesce(named(column), mean))


def group_means(pool: DataFrame, groupings: dict[str, str], shared: str, targets: Sequence[str]) -> DataFrame:
    """Means per (grouping column, shared column) for several grouping columns in one pass.

    ``groupings`` maps a postfix to its grouping column.  Gives rows
    ``_postfix, _group, <shared>, <targets>``.
    """
    kinds = F.array(
        *[F.struct(F.lit(p).alias("p"), named(c).cast("string").alias("g")) for p, c in groupings.items()]
    )
    rows = pool.select(F.inline(kinds).alias("_postfix", "_group"), named(shared), *[named(t) for t in targets])
    return rows.dropna(subset=["_group", shared]).groupBy("_postfix", "_group", shared).agg(
        *[F.avg(named(t)).alias(t) for t in targets]
    )


def against_means(
    rows: DataFrame, means: DataFrame, groupings: dict[str, str], shared: str, targets: Sequence[str]
) -> DataFrame:
    """Add ``<target>_BY_<postfix>`` with ``_RATIO`` and ``_DIFF`` from :func:`group_means`, which are computed once for all groupings."""
    out, means = rows, computed(means)
    for postfix, column in groupings.items():
        own = means.where(F.col("_postfix") == postfix).select(
            F.col("_group").alias(column), named(shared), *[named(t).alias(f"{t}_BY_{postfix}") for t in targets]
        )
        out = attach_small(out, own, [column, shared])
        for t in targets:
            base = f"{t}_BY_{postfix}"
            out = out.withColumns({base + "_RATIO": ratio(t, base), base + "_DIFF": named(t) - named(base)})
    return out


def pooled_group_mean(
    current: DataFrame, earlier: DataFrame, key: str, groupings: dict[str, str], shared: str, targets: Sequence[str]
) -> DataFrame:
    """Compare each current row with its group's mean over current and earlier rows; one row per key."""
    columns = [*groupings.values(), shared, *targets]
    own = current.select(named(key), *[named(c) for c in columns])
    pool = own.select(*columns).unionByName(earlier.select(*[named(c) for c in columns]))
    out = against_means(own, group_means(pool, groupings, shared, targets), groupings, shared, targets)
    return out.drop(*columns)


def mean_by_type(df: DataFrame, key: str, type_column: str, types: dict[str | None, str], targets: dict[str, str]) -> DataFrame:
    """Means per key, over all rows and per contract type, in one groupBy.

    ``types`` maps a type value (None for all rows) to the infix of the output
    name, ``targets`` a column to its short name: ``MEAN_PREV_<infix><short>``.
    """
    exprs = []
    for value, infix in types.items():
        for column, short in targets.items():
            c = named(column)
            kept = c if value is None else F.when(named(type_column) == value, c)
            exprs.append(F.avg(kept).alias(f"MEAN_PREV_{infix}{short}"))
    return df.where(named(key).isNotNull()).groupBy(key).agg(*exprs)


def target_mean(df: DataFrame, by: str, target: str, name: str, fit_on: Column | None = None) -> DataFrame:
    """Replace a category by the mean label of its rows; ``fit_on`` keeps folds apart."""
    rows = df if fit_on is None else df.where(fit_on)
    means = rows.where(named(by).isNotNull()).groupBy(by).agg(F.avg(named(target)).alias(name))
    return attach_small(df, means, by)


def event_rate(df: DataFrame, key: str, event: Column, name: str) -> DataFrame:
    """Share of a key's rows where the event holds; an undecidable event counts as no."""
    return df.where(named(key).isNotNull()).groupBy(key).agg(F.avg(flag(event)).alias(name))


def event_label(df: DataFrame, key: str, event: Column, name: str, cutoff: float = 0.0) -> DataFrame:
    """1 for the keys whose event rate is above the cutoff, else 0."""
    rate = event_rate(df, key, event, name)
    return rate.withColumn(name, (named(name) > cutoff).cast("int"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """How often each non-missing value occurs."""
    return df.where(named(column).isNotNull()).groupBy(column).count()


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson correlation over the rows where both values are present."""
    both = df.where(named(a).isNotNull() & named(b).isNotNull())
    return both.agg(F.corr(named(a).cast("double"), named(b).cast("double")).alias("correlation"))


def distinct_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c) for c in columns]).distinct()

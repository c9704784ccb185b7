"""A feature learned from earlier loans: the chance that an applicant pays late.

Earlier loans become pseudo-applications whose outcome is known.  A model fitted
on them scores the current applications.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import flag, named, positive_part
from riskloom.models.folds import FOLDS, SEED, with_folds
from riskloom.models.prepare import Prepared
from riskloom.models.train import Cv, _union, cross_validate_seeds
from riskloom.operators.checks import require_same_columns
from riskloom.operators.groups import against_means, correlation, event_label, group_means
from riskloom.operators.joins import attach, override_columns
from riskloom.plans.application import GROUPINGS, KEY, basic_features
from riskloom.plans.dropped import STRICT
from riskloom.session import computed

LOAN = "SK_ID_PREV"
LABEL = "delay"

# What a loan brings along itself, and application columns left
# out of the model.
OWN = ["AMT_ANNUITY", "AMT_GOODS_PRICE", "NAME_TYPE_SUITE", "AMT_CREDIT", "NAME_CONTRACT_TYPE"]
UNUSED_DOCUMENTS = [f"FLAG_DOCUMENT_{i}" for i in (5, 6, 8, 16, 18)]
UNUSED = [c for c in STRICT if not c.startswith("AMT_REQ")] + UNUSED_DOCUMENTS
# The model of monthly balances leaves out one column only.
UNUSED_BY_MONTH = ["ORGANIZATION_TYPE"]
DPD_LIMIT = 3

Hook = Callable[[DataFrame], DataFrame]


def pseudo_applications(app: DataFrame, prev: DataFrame) -> DataFrame:
    """Each earlier loan in the shape of an application."""
    return override_columns(prev, app, KEY, OWN, keep=[LOAN])


def late_instalments(installments: DataFrame, days: int = 7, first: int = 5, cutoff: float = 0.0) -> DataFrame:
    """Loans paid more than ``days`` late, on the first instalments or (first <= 0) on any."""
    rows = installments if first <= 0 else installments.where(F.col("NUM_INSTALMENT_NUMBER") <= first)
    late = positive_part(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT")) > days
    return event_label(rows, LOAN, late, LABEL, cutoff)


def late_variants(installments: DataFrame, variants: dict[str, tuple[int, int]], cutoff: float = 0.0) -> DataFrame:
    """Several outcomes of each loan in one pass over the payments, as ``late_instalments`` has them one by one.

    ``variants`` has the days and first instalments of each; NULL where a loan has no such instalment.
    """
    late = positive_part(F.col("DAYS_ENTRY_PAYMENT") - F.col("DAYS_INSTALMENT"))
    rows = installments.where(F.col(LOAN).isNotNull()).select(LOAN, "NUM_INSTALMENT_NUMBER", late.alias("_late"))

    def outcome(days: int, first: int) -> Column:
        event = flag(F.col("_late") > days)
        return (F.avg(event if first <= 0 else F.when(F.col("NUM_INSTALMENT_NUMBER") <= first, event)) > cutoff).cast("int")

    return rows.groupBy(LOAN).agg(*[outcome(*v).alias(name) for name, v in variants.items()])


def late_months(pos: DataFrame, days: int = DPD_LIMIT, cutoff: float = 0.0) -> DataFrame:
    """Loans with a month more than ``days`` past due."""
    return event_label(pos, LOAN, F.col("SK_DPD") > days, LABEL, cutoff)


def training_rows(app: DataFrame, prev: DataFrame, labels: DataFrame) -> DataFrame:
    """Pseudo-applications with a known outcome."""
    return pseudo_applications(app, prev).join(labels, [LOAN])


def against_contract_means(df: DataFrame) -> DataFrame:
    """A hook: annuity and credit against the mean of similar contracts in all rows."""
    targets, shared = ["AMT_ANNUITY", "AMT_CREDIT"], "NAME_CONTRACT_TYPE"
    return against_means(df, group_means(df, GROUPINGS, shared, targets), GROUPINGS, shared, targets)


def model_rows(app: DataFrame, prev: DataFrame, labels: DataFrame, hook: Hook | None = None) -> DataFrame:
    """Earlier loans (labels known) and current applications (labels missing) in one table.

    ``labels`` has a loan and one or several outcomes.  ``_row`` identifies a row: an earlier loan or a current application.
    """
    known = basic_features(training_rows(app, prev, labels)).withColumn("_row", F.concat(F.lit("p"), LOAN))
    now = basic_features(app).withColumns({c: F.lit(None).cast("int") for c in labels.columns if c != LOAN} | {"_row": F.concat(F.lit("c"), KEY)})
    known = known.drop(LOAN)
    require_same_columns(known, now)
    rows = known.unionByName(now)
    return hook(rows) if hook else rows


def stacked_features(
    app: DataFrame, prev: DataFrame, labels: DataFrame, params: dict,
    hook: Hook | None = None, k: int = FOLDS, seed: int = SEED, by_applicant: bool = True,
    unused: Sequence[str] = tuple(UNUSED), seeds: Sequence[int] = (0,), log: Callable[[str, int, Cv], None] | None = None, **options,
) -> DataFrame:
    """``SK_ID_CURR`` and, for each outcome in ``labels``, the predicted chance, averaged over folds and seeds.

    All outcomes share one training table.  All loans of an applicant stay in one fold unless ``by_applicant`` is off.
    ``log`` gets each seed's result by outcome.
    """
    # Inside, outcomes have names of their own: an outcome may be called as a column of the rows or of a fitted model.
    inner = {c: f"_outcome{i}" for i, c in enumerate(c for c in labels.columns if c != LOAN)}
    rows = with_folds(model_rows(app, prev, labels.withColumnsRenamed(inner), hook), KEY if by_applicant else "_row", k, seed)
    first, *others = inner.values()
    data = Prepared(rows, "_row", first, keep=[KEY, "fold", *others], drop=["TARGET", *unused])
    found = None
    for name, outcome in inner.items():
        own, parts = data.labelled_by(outcome), []
        for s, result in cross_validate_seeds(own, params, seeds, k, **options):
            if log:
                log(name, s, result)
            parts.append(result.unlabelled)
        # Loans without this outcome are scored as well, but only applications are asked for.
        scored = _union(parts).where(F.col("_row").startswith("c")).groupBy("_row").agg(F.avg("prediction").alias(name))
        scored = computed(scored.select(F.substring("_row", 2, 30).cast("bigint").alias(KEY), named(name)))
        found = scored if found is None else found.join(scored, [KEY], "full")
    return found


def stacked_feature(app: DataFrame, prev: DataFrame, labels: DataFrame, name: str, params: dict, log: Callable[[int, Cv], None] | None = None, **options) -> DataFrame:
    """``SK_ID_CURR`` and the predicted chance of one outcome, ``delay`` in ``labels``."""
    told = (lambda _, seed, result: log(seed, result)) if log else None
    return stacked_features(app, prev, labels.select(LOAN, F.col(LABEL).alias(name)), params, log=told, **options)


def agreement(app: DataFrame, predicted: DataFrame, name: str) -> DataFrame:
    """Correlation of the stacked feature with the real outcome of labelled applicants."""
    return correlation(attach(app.select(KEY, "TARGET"), predicted, KEY), name, "TARGET")

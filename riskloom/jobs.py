"""The three end-to-end jobs: build the matrix, train and predict, learn a stacked feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from riskloom.models import stacked
from riskloom.models.folds import FOLDS, SEED, with_folds
from riskloom.models.prepare import Prepared
from riskloom.models.train import EARLIER, PARAMS, Cv, cross_validate, mean_importance
from riskloom.plans.feature_sets import FeatureSet
from riskloom.plans.matrix import KEY, feature_matrix
from riskloom.operators.checks import Observed
from riskloom.session import computed, tune_tables
from riskloom.sources.store import Cache, log_metrics, write_matrix, write_predictions, write_sample
from riskloom.sources.tables import read_tables

LABEL = "TARGET"


def build_features(
    spark: SparkSession, source: str, out: str, refresh: str | Sequence[str] = "all", stacked_path: str | None = None
) -> DataFrame:
    """Tables in ``source`` to ``<out>/features_all.parquet`` and a CSV sample of 100 rows.

    Each part is written to ``<out>/cache`` first; ``refresh`` says which parts to
    rebuild, so a failed run resumes with the parts that are there and whose input is as it was.
    The matrix must have the applicants' rows; rows are counted while they are written.
    """
    tune_tables(spark)
    predictions = spark.read.parquet(stacked_path) if stacked_path else None
    cache = Cache(spark, f"{out}/cache", refresh)
    matrix = Observed(feature_matrix(read_tables(spark, source), predictions, cache), "matrix")
    path = f"{out}/features_all.parquet"
    write_matrix(matrix.rows, path)
    matrix.require_some().require_rows(cache.rows["app"])
    written = spark.read.parquet(path)
    write_sample(written, KEY, f"{out}/all_sample")
    return written


def train_and_predict(
    spark: SparkSession, matrix: DataFrame, out: str, name: str, feature_set: FeatureSet | None = None,
    candidates: DataFrame | None = None, params: dict | None = None, k: int | None = None, seed: int = SEED, **options,
) -> Cv:
    """Cross-validate on the labelled rows and predict the others.

    Writes predictions (CSV by key), out-of-fold predictions, importances by fold and the 100 highest means,
    and the AUC and the trees kept, per fold and overall.
    """
    tune_tables(spark)
    params = dict(params or (EARLIER if feature_set is not None else PARAMS))
    if feature_set is not None:
        matrix = feature_set.apply(matrix, candidates)
        params["max_depth"] = params.get("max_depth", 8) if feature_set.max_depth > 0 else -1
        if feature_set.seed is not None:
            params["seed"] = feature_set.seed
    k = k or (feature_set.folds if feature_set else FOLDS)
    data = Prepared(with_folds(matrix, KEY, k, seed), KEY, LABEL, keep=["fold"])
    result = cross_validate(data, params, k, **options)
    write_predictions(result.unlabelled, KEY, "prediction", f"{out}/{name}.csv")
    result.oof.write.mode("overwrite").parquet(f"{out}/{name}_oof.parquet")
    result.importance.write.mode("overwrite").parquet(f"{out}/{name}_importance.parquet")
    mean_importance(result.importance).write.mode("overwrite").parquet(f"{out}/{name}_importance_top.parquet")
    log_metrics(spark, f"{out}/metrics.parquet", name, _metrics(result), note=str(params))
    return result


def _metrics(result: Cv) -> dict[str, float]:
    found = {f"fold_{i}_auc": a for i, a in result.fold_auc.items() if a is not None}
    found |= {f"fold_{i}_trees": float(n) for i, n in result.trees.items()}
    return found | ({} if result.auc is None else {"auc": result.auc})


# Days late and first instalments (below 1: all) of the features learned from instalments.
LATE_VARIANTS = {
    "PREDICTED_X14Y-1": (14, -1), "PREDICTED_DPD": (7, 5), "PREDICTED_X21Y-1": (21, -1), "PREDICTED_X28Y-1": (28, -1),
    "PREDICTED_X35Y-1": (35, -1),
}
SEEDS = range(10)


def build_stacked(
    spark: SparkSession, source: str, out: str, params: dict | None = None, k: int = FOLDS,
    variants: Sequence[str] = ("PREDICTED_X14Y-1",), seeds: Sequence[int] = SEEDS, metrics: str | None = None, **options,
) -> DataFrame:
    """Stacked features by key, ready for :func:`build_features` or as candidates of a feature set.

    ``variants`` names the features learned from instalments; one more learns from months more than 3 days past
    due.  Each is the mean over seeds.  With ``metrics``, AUC and trees of each seed and the correlation with the real
    outcome are logged there.
    """
    tune_tables(spark)
    t = read_tables(spark, source)
    app, prev = t.application_all, t.previous_application
    params = params or EARLIER

    def log(name: str, seed: int, result: Cv) -> None:
        log_metrics(spark, metrics, f"{name}, seed {seed}", _metrics(result), note=str(params))

    def learned(labels: DataFrame, **more) -> DataFrame:
        features = stacked.stacked_features(app, prev, labels, params, k=k, seeds=seeds, log=log if metrics else None, **more, **options)
        for name in [c for c in features.columns if c != KEY] if metrics else []:
            agreed = stacked.agreement(app, features, name).first()[0]
            log_metrics(spark, metrics, name, {} if agreed is None else {"correlation": agreed})
        return features

    late = computed(stacked.late_variants(t.installments_payments, {v: LATE_VARIANTS[v] for v in variants}))
    months = stacked.late_months(t.POS_CASH_balance).withColumnRenamed(stacked.LABEL, "POS_PREDICTED")
    parts = ([learned(late)] if variants else []) + [learned(months, unused=stacked.UNUSED_BY_MONTH)]
    every = parts[0]
    for p in parts[1:]:
        every = every.join(p, [KEY], "full")
    every.write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)

"""Boosted trees with out-of-fold predictions.

The driver loops over folds; every fit, prediction and metric is a Spark job.  A fit with a fixed number of rounds is
MLlib's own; one that stops early watches the AUC of the held fold (``boosting``).
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import named
from riskloom.models.auc import auc_per_group, auc_value
from riskloom.models.boosting import BLOCK, boost
from riskloom.models.folds import FOLDS
from riskloom.models.prepare import Prepared
from riskloom.operators.shape import top_rows
from riskloom.session import computed, remove, shared_folder

# The parameter sets of the models, and the two parameter grids.  PARAMS is the current model's,
# EARLIER that of the named feature sets and of the stacked features.
PARAMS = {
    "num_leaves": 32,
    "learning_rate": 0.04,
    "colsample_bytree": 0.2,
    "max_depth": 8,
    "reg_alpha": 0.04,
    "reg_lambda": 0.073,
    "min_split_gain": 0.1,
    "min_child_weight": 120,
    "n_estimators": 10000,
}
EARLIER = {
    "num_leaves": 32,
    "learning_rate": 0.04,
    "colsample_bytree": 0.95,
    "subsample": 0.872,
    "max_depth": 8,
    "reg_alpha": 0.04,
    "reg_lambda": 0.073,
    "min_split_gain": 0.0222415,
    "min_child_weight": 40,
    "n_estimators": 10000,
}
# Rounds without a better AUC of the held fold after which a fit stops; rounds of a fit that adds columns.
PATIENCE = 200
SELECTION_ROUNDS = 1000
GRID = {
    "reg_alpha": [0, 0.04, 0.1],
    "reg_lambda": [0, 0.073, 0.1],
    "min_child_weight": [20, 40, 80],
    "colsample_bytree": [0.2, 0.5],
}
STACKED_GRID = {"min_child_weight": [20, 40, 80], "num_leaves": [32, 48, 64]}


def to_gbt(params: dict) -> dict:
    """MLlib's settings for a parameter set.

    MLlib grows trees by level, so a leaf limit becomes a depth limit; it has no
    L1/L2 terms, so ``reg_alpha`` and ``reg_lambda`` do not change the model.
    ``min_split_gain`` is its least information gain.
    """
    leaves = math.ceil(math.log2(params.get("num_leaves", 32)))
    depth = params.get("max_depth", -1)
    out = {
        "maxDepth": leaves if depth <= 0 else min(depth, leaves),
        "stepSize": float(params.get("learning_rate", 0.1)),
        "maxIter": int(params.get("n_estimators", 20)),
        "minInfoGain": float(params.get("min_split_gain", 0.0)),
        "minInstancesPerNode": int(params.get("min_child_weight", 1)),
        "subsamplingRate": float(params.get("subsample", 1.0)),
        "featureSubsetStrategy": str(float(params.get("colsample_bytree", 1.0))),
        "seed": int(params.get("seed", 0)),
    }
    if out["featureSubsetStrategy"] == "1.0":
        out["featureSubsetStrategy"] = "all"
    return out


@dataclass
class Cv:
    """Results of one cross-validation; ``trees`` are the rounds kept in each fold."""

    oof: DataFrame
    unlabelled: DataFrame
    importance: DataFrame
    fold_auc: dict[int, float]
    auc: float
    trees: dict[int, int]


def fit(train: DataFrame, label: str, params: dict, bins: int) -> GBTClassificationModel:
    """One model with all the rounds that the parameters ask for."""
    return GBTClassifier(labelCol=label, featuresCol="features", maxBins=bins, **to_gbt(params)).fit(train)


def score(model: GBTClassificationModel, df: DataFrame) -> DataFrame:
    scored = model.transform(df)
    p = vector_to_array("probability")[1].alias("prediction")
    return scored.select(*[named(c) for c in df.columns if c != "features"], p)


@dataclass
class Fold:
    """One fit: the rows it did not train on with their prediction, the rounds kept, the importance of each input."""

    rows: DataFrame
    trees: int
    importance: list[float]


def fit_fold(vectors: DataFrame, train: Column, label: str, params: dict, bins: int, early_stop: bool, patience: int, block: int, folder: str | None) -> Fold:
    """Fit on the ``train`` rows and score all others, once.

    With early stopping the state of the fit lies in ``folder``, from which a broken run goes on; else in one that goes with
    the fit.
    """
    known = named(label).isNotNull()
    if not early_stop:
        model = fit(vectors.where(known & train), label, params, bins)
        rows = computed(score(model, vectors.where(~(known & train))))
        return Fold(rows, model.getNumTrees, [float(v) for v in model.featureImportances.toArray()])
    spark = vectors.sparkSession
    own = folder or f"{shared_folder(spark)}/boost-{uuid.uuid4().hex}"
    found = boost(vectors, label, train, to_gbt(params), bins, own, patience, block)
    rows = computed(found.rows)
    if not folder:
        remove(spark, own)
    return Fold(rows, found.trees, found.importance)


def cross_validate(
    data: Prepared,
    params: dict,
    k: int = FOLDS,
    features: Sequence[str] | None = None,
    early_stop: bool = True,
    fold: str = "fold",
    watch: Callable[[dict[int, float | None]], bool] | None = None,
    patience: int = PATIENCE,
    block: int = BLOCK,
    folder: str | None = None,
) -> Cv | dict[int, float]:
    """Out-of-fold predictions, mean prediction of the unlabelled rows, importances, AUC.

    With ``early_stop`` a fold's fit ends when the AUC of the held rows has not risen for ``patience`` rounds; its state is
    written after each ``block`` of rounds, in ``folder`` if given, from which a broken run goes on.

    ``watch`` sees the AUC per finished fold and may abandon the run by
    returning True; the folds done so far are then returned.
    """
    names = list(features) if features is not None else data.features
    spark = data.table.sparkSession
    oof, unseen, weights, done, trees = [], [], [], {}, {}
    vectors = data.vectors(features)
    known = named(data.label).isNotNull()
    for i in range(k):
        found = fit_fold(vectors, named(fold) != i, data.label, params, data.bins, early_stop, patience, block, folder and f"{folder}/fold-{i}")
        trees[i] = found.trees
        oof.append(found.rows.where(known & (named(fold) == i)))
        unseen.append(found.rows.where(~known))
        weights += [(n, i, v) for n, v in zip(names, found.importance)]
        if watch:
            done[i] = auc_value(oof[-1], data.label, "prediction")
            if watch(done):
                return done
    all_oof = _union(oof)
    return Cv(
        oof=all_oof,
        unlabelled=_union(unseen).groupBy(data.key).agg(F.avg("prediction").alias("prediction")),
        importance=spark.createDataFrame(weights, "feature string, fold int, importance double"),
        fold_auc=done or auc_per_group(all_oof, data.label, "prediction", fold),
        auc=auc_value(all_oof, data.label, "prediction"),
        trees=trees,
    )


def cross_validate_seeds(data: Prepared, params: dict, seeds: Sequence[int], k: int = FOLDS, **options) -> Iterator[tuple[int, Cv]]:
    """Each seed with its ``cross_validate``, on the same folds.

    Models of a fixed number of rounds are all fitted first, on the labelled rows alone, and score the others together.
    """
    if options.get("early_stop", True) or options.get("watch"):
        for s in seeds:
            yield s, cross_validate(data, {**params, "seed": s}, k, **options)
    else:
        yield from zip(seeds, _cross_validate_together(data, params, seeds, k, options.get("features"), options.get("fold", "fold")))


def _cross_validate_together(data: Prepared, params: dict, seeds: Sequence[int], k: int, features: Sequence[str] | None, fold: str) -> list[Cv]:
    """Rows are written once, with an array of one prediction for each seed: a held row's by its fold, the mean of all folds for the unlabelled.

    A fit reads its rows three times, so they are kept on disk as dense vectors, in the partitions and the order they have.
    """
    spark, known = data.table.sparkSession, named(data.label).isNotNull()
    names = list(features) if features is not None else data.features
    vectors = data.vectors(features)
    held = [c for c in vectors.columns if c != "features"]
    dense = array_to_vector(vector_to_array("features")).alias("features", metadata=vectors.schema["features"].metadata)
    train = vectors.where(known).select(*[named(c) for c in held], dense).persist(StorageLevel.DISK_ONLY)
    models = [[fit(train.where(named(fold) != i), data.label, {**params, "seed": s}, data.bins) for i in range(k)] for s in seeds]
    parts = [_scored(train.where(named(fold) == i), [[m[i]] for m in models]) for i in range(k)]
    rows = computed(_union([*parts, _scored(vectors.where(~known), models)]))
    train.unpersist()

    seen = rows.where(known).select(named(data.label), named(fold), F.posexplode("_means").alias("_seed", "_score"))
    auc = auc_per_group(seen, data.label, "_score", "_seed")
    by_fold = auc_per_group(seen.withColumn("_at", F.col("_seed") * k + named(fold)), data.label, "_score", "_at")
    out = []
    for j, found in enumerate(models):
        own = rows.select(*[named(c) for c in held], F.col("_means")[j].alias("prediction"))
        weights = [(n, i, float(v)) for i, m in enumerate(found) for n, v in zip(names, m.featureImportances.toArray())]
        out.append(Cv(
            oof=own.where(known),
            unlabelled=own.where(~known).groupBy(data.key).agg(F.avg("prediction").alias("prediction")),
            importance=spark.createDataFrame(weights, "feature string, fold int, importance double"),
            fold_auc={i: by_fold[j * k + i] for i in range(k) if j * k + i in by_fold},
            auc=auc.get(j),
            trees={i: m.getNumTrees for i, m in enumerate(found)},
        ))
    return out


def _scored(rows: DataFrame, models: Sequence[Sequence[GBTClassificationModel]]) -> DataFrame:
    """The rows with ``_means``: for each list of models their mean prediction."""
    held, sums = [named(c) for c in rows.columns if c != "features"], [f"_sum{j}" for j in range(len(models))]
    out = rows.withColumns({c: F.lit(0.0) for c in sums})
    for j, own in enumerate(models):
        for model in own:
            p = vector_to_array("probability")[1]
            out = model.transform(out).select(*held, "features", *[(F.col(c) + p).alias(c) if c == sums[j] else F.col(c) for c in sums])
    return out.select(*held, F.array(*[F.col(c) / len(own) for c, own in zip(sums, models)]).alias("_means"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mean_importance(importance: DataFrame, n: int = 100) -> DataFrame:
    """The most important features, averaged over folds."""
    means = importance.groupBy("feature").agg(F.avg("importance").alias("importance"))
    return top_rows(means, "importance", "feature", n)


def bag_seeds(data: Prepared, params: dict, seeds: Sequence[int] = range(10), k: int = FOLDS, **options) -> DataFrame:
    """Mean prediction of the unlabelled rows over several seeds.

    Models of a fixed number of rounds are all fitted first, on the labelled rows alone, and score the others in one pass.
    """
    if not options.get("early_stop", True) and not set(options) - {"early_stop", "features", "fold"}:
        return _bag_in_one_pass(data, params, seeds, k, options.get("features"), options.get("fold", "fold"))
    runs = [cross_validate(data, {**params, "seed": s}, k, **options).unlabelled for s in seeds]
    return _union(runs).groupBy(data.key).agg(F.avg("prediction").alias("prediction"))


def _bag_in_one_pass(data: Prepared, params: dict, seeds: Sequence[int], k: int, features: Sequence[str] | None, fold: str) -> DataFrame:
    known = named(data.label).isNotNull()
    train = data.with_table(computed(data.table.where(known))).vectors(features)
    models = [fit(train.where(named(fold) != i), data.label, {**params, "seed": s}, data.bins) for s in seeds for i in range(k)]
    rows = data.vectors(features).where(~known).select(named(data.key), "features", F.lit(0.0).alias("_sum"))
    for model in models:
        p = vector_to_array("probability")[1]
        rows = model.transform(rows).select(named(data.key), "features", (F.col("_sum") + p).alias("_sum"))
    return rows.groupBy(data.key).agg((F.avg("_sum") / len(models)).alias("prediction"))


def combinations(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def distinct_settings(base: dict, grid: dict[str, Sequence]) -> dict[str, list[dict]]:
    """The combinations of a grid, together where they mean the same MLlib model."""
    out: dict[str, list[dict]] = {}
    for c in combinations(grid):
        out.setdefault(str(sorted(to_gbt({**base, **c}).items())), []).append(c)
    return out


def live_dimensions(base: dict, grid: dict[str, Sequence]) -> dict[str, Sequence]:
    """The grid without dimensions that change no MLlib model."""
    return {n: v for n, v in grid.items() if len({str(sorted(to_gbt({**base, n: x}).items())) for x in v}) > 1}


def _text(combination: dict) -> str:
    return ",".join(f"{n}={v}" for n, v in combination.items())


def grid_search(
    data: Prepared, base: dict, grid: dict[str, Sequence], k: int = FOLDS, parallelism: int = 2,
    log: Callable[[str, Cv], None] | None = None, known: dict[str, float] | None = None, **options,
) -> DataFrame:
    """The AUC of every combination, several fitted at a time.

    Combinations that mean the same MLlib model are fitted once; ``fitted`` names the one whose fit each row shows.
    ``log`` is told of each fit when it is done; ``known`` has the results of an earlier, broken run.
    """
    settings = distinct_settings(base, grid)
    done = known or {}

    def run(item):
        setting, same = item
        name = _text(same[0])
        if name in done:
            return setting, done[name]
        result = cross_validate(data, {**base, **same[0]}, k, **options)
        if log:
            log(name, result)
        return setting, result.auc

    with ThreadPool(parallelism) as pool:
        found = dict(pool.map(run, settings.items()))
    rows = [(_text(c), _text(same[0]), found[s]) for s, same in settings.items() for c in same]
    return data.table.sparkSession.createDataFrame(rows, "combination string, fitted string, auc double")

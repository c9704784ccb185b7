"""Boosting that watches the AUC of held rows, keeps its state in files and goes on where it was broken off.

MLlib's own boosted trees watch the loss and can neither be continued nor stopped with patience.  Here every round fits one
MLlib tree on the gradients of the loss; what boosting needs to know of the rows is one number each, the *margin*.
Rows that are not trained on (held and unlabelled ones) ride along and are scored on the way, so no tree is applied twice.

Rows trained on lie apart from the others, so a fit reads no other rows.  After each block of rounds both parts are written
with their margin.  Rows that are not trained on also carry the margin after each round of the block, and the exact AUC of the
held rows is taken for all of these rounds in one job.  A block counts once its report is written; a run with the same folder
continues after the last such block, and fits no finished round again.

Rows trained on are put back into the partitions and the order they began in, once a block: sums, and the rows that MLlib
samples for its thresholds, then do not depend on where a block ends.  The others are dealt out
once if they lie in few partitions, as trees cost time by the row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import named
from riskloom.models.auc import auc_per_group
from riskloom.session import exists, remove

#: Rounds between two written states.
BLOCK = 10
#: Rows trained on, and those that are only scored.
PARTS = ("train", "rest")


@dataclass
class Boosted:
    """``rows``: the rows not trained on, with their prediction at the best round.

    ``trees`` is the best round, ``aucs`` the held rows' AUC after each fitted round, ``stopped`` whether patience ended it;
    ``importance`` averages that of the trees kept.
    """

    rows: DataFrame
    trees: int
    aucs: list[float | None]
    importance: list[float]
    stopped: bool


def best_round(losses, patience: int) -> tuple[int, bool]:
    """The round with the smallest loss before ``patience`` rounds passed without a smaller one, and whether they did."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        if i - best >= patience:
            return best + 1, True
    return best + 1, False


def _gradient(y: Column, margin: Column) -> Column:
    """The negative gradient of 2 log(1 + exp(-2 y margin)), for y of -1 and 1."""
    return 4 * y / (1 + F.exp(2 * y * margin))


def _place() -> Column:
    """The partition that a row trained on was in when its fit began."""
    return F.shiftright("_at", 33).cast("int")


def boost(
    rows: DataFrame, label: str, train: Column, settings: dict, bins: int, folder: str,
    patience: int, block: int = BLOCK, on_fit: Callable[[int], None] | None = None,
) -> Boosted:
    """Fit on the ``train`` rows (with ``features``), watch the other labelled ones, and score all others.

    ``settings`` are MLlib's (see ``to_gbt``).  The first tree is fitted on the labels and has weight 1, later ones the
    step size.  Without held rows of both classes every round is fitted and the last is best.  ``on_fit`` is told
    of every tree.
    """
    spark = rows.sparkSession
    limit, step, seed = settings["maxIter"], settings["stepSize"], settings["seed"]
    learner = {k: v for k, v in settings.items() if k not in ("maxIter", "stepSize", "seed")}
    held = [c for c in rows.columns if c != "features"]
    y = 2 * F.col("_y") - 1
    trained = F.coalesce(train & named(label).isNotNull(), F.lit(False))
    reports: list = []

    def at(kind: str, rounds_before: int) -> str:
        return f"{folder}/{kind}-{rounds_before:06d}"

    def verdict() -> tuple[int, bool]:
        aucs = [r["auc"] for r in reports]
        return best_round([-a for a in aucs], patience) if aucs and aucs[-1] is not None else (len(aucs), False)

    def after(begin: int) -> dict[str, DataFrame]:
        """The parts after the last block; the best margin is taken over from it if the best round so far is in it."""
        found, best = {part: spark.read.parquet(at(part, begin)) for part in PARTS}, verdict()[0]
        if best > begin:
            found["rest"] = found["rest"].withColumn("_best", F.get("_margins", F.lit(best - begin - 1)))
        return found

    last = None
    while exists(spark, at("rounds", len(reports)) + "/_SUCCESS"):  # finished blocks of an earlier run
        last = len(reports)
        reports += sorted(spark.read.parquet(at("rounds", last)).collect(), key=lambda r: r["round"])
    if last is None:
        begun = rows.withColumns({"_y": named(label).cast("double"), "_margin": F.lit(0.0)})
        first = begun.where(trained).select("features", "_y", "_margin", F.monotonically_increasing_id().alias("_at"))
        first.write.mode("overwrite").parquet(f"{folder}/train")
    state = after(last) if last is not None else {"train": spark.read.parquet(f"{folder}/train")}
    partitions = state["train"].agg(F.max(_place()) + 1).first()[0] or 1
    if last is None:
        state["rest"], cores = begun.where(~trained).withColumn("_best", F.lit(None).cast("double")), spark.sparkContext.defaultParallelism
        if 2 * partitions <= cores:
            state["rest"] = state["rest"].repartitionById(cores, (F.monotonically_increasing_id() % cores).cast("int"))

    while len(reports) < limit and not verdict()[1]:
        done, importances = len(reports), []
        placed = state["train"].repartitionById(partitions, _place()).sortWithinPartitions("_at").persist()
        now = state | {"train": placed}
        n = min(block, limit - done)
        for i in range(done, done + n):
            target = _gradient(y, F.col("_margin")) if i else y
            forest = RandomForestRegressor(
                featuresCol="features", labelCol="_target", predictionCol="_tree", numTrees=1, bootstrap=False, maxBins=bins, seed=seed + i, **learner
            )
            tree = forest.fit(now["train"].select("features", target.alias("_target")))
            if on_fit:
                on_fit(i)
            importances.append([float(v) for v in tree.featureImportances.toArray()])
            margin = F.col("_margin") + (step if i else 1.0) * F.col("_tree")
            now = {part: tree.transform(df).withColumn("_margin", margin).drop("_tree") for part, df in now.items()}
            now["rest"] = now["rest"].withColumn(f"_m{i}", F.col("_margin"))
        now["train"].write.mode("overwrite").parquet(at("train", done))
        placed.unpersist()
        margins = F.array(*[f"_m{i}" for i in range(done, done + n)]).alias("_margins")
        kept = now["rest"].select(*[named(c) for c in held], "features", "_y", "_margin", margins, "_best")
        kept.write.mode("overwrite").parquet(at("rest", done))
        watched = spark.read.parquet(at("rest", done)).where(F.col("_y").isNotNull())
        aucs = auc_per_group(watched.select("_y", F.posexplode("_margins").alias("_round", "_score")), "_y", "_score", "_round")
        report = [(done + i + 1, aucs.get(i), importances[i]) for i in range(n)]
        table = spark.createDataFrame(report, "round int, auc double, importance array<double>")
        table.coalesce(1).write.mode("overwrite").parquet(at("rounds", done))
        reports += [{"round": r, "auc": a, "importance": v} for r, a, v in report]
        state = after(done)
        for old in [f"{folder}/train"] if last is None else [at(part, last) for part in PARTS]:
            remove(spark, old)
        last = done

    best, stopped = verdict()
    kept = [r["importance"] for r in reports[:best]]
    margin = F.col("_best" if reports and reports[-1]["auc"] is not None else "_margin")
    scored = state["rest"].select(*[named(c) for c in held], (1 / (1 + F.exp(-2 * margin))).alias("prediction"))
    return Boosted(scored, best, [r["auc"] for r in reports], [sum(v) / len(kept) for v in zip(*kept)], stopped)

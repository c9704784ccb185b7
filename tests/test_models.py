import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskloom.models.auc import auc, auc_per_group, auc_value
from riskloom.models.boosting import best_round, boost
from riskloom.models.folds import HEAVY, fold_of, with_balanced_folds, with_folds
from riskloom.models.prepare import Prepared, value_codes
from riskloom.models.select import backward, chunks, forward, losing
from riskloom.models.train import (
    GRID, STACKED_GRID, bag_seeds, combinations, cross_validate, distinct_settings, grid_search, live_dimensions, mean_importance,
    to_gbt,
)

QUICK = {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.3}


@pytest.mark.parametrize("pairs, want", [
    ([(0, 0.1), (0, 0.2), (1, 0.3)], 1.0),
    ([(1, 0.1), (0, 0.2), (0, 0.3)], 0.0),
    ([(1, 0.5), (0, 0.5), (1, 0.5)], 0.5),
    ([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], 0.875),
    ([(1, 0.5)], None),
])
def test_auc_small(spark, pairs, want):
    assert auc_value(spark.createDataFrame(pairs, "y int, p double"), "y", "p") == want


def test_auc_equals_mllib_with_many_ties(spark):
    rng = random.Random(11)
    data = [(float(rng.random() < 0.3), rng.choice([0.5, round(rng.random(), 2), rng.random()]), i % 3) for i in range(8000)]
    df = spark.createDataFrame(data, "y double, p double, g int")
    want = BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="y", numBins=0)
    assert auc_value(df, "y", "p") == pytest.approx(want.evaluate(df), abs=1e-9)
    per_group = auc_per_group(df, "y", "p", "g")
    for g in range(3):
        assert per_group[g] == pytest.approx(want.evaluate(df.where(F.col("g") == g)), abs=1e-9)


def test_auc_ignores_missing(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (1, None)], "y int, p double")
    assert auc(df, "y", "p").collect()[0]["auc"] == 1.0


def test_folds_cover_and_keep_entities_together(spark):
    df = with_folds(spark.range(5000), "id").withColumn("entity", F.col("id") % 100)
    sizes = {r["fold"]: r["count"] for r in df.groupBy("fold").count().collect()}
    assert set(sizes) == set(range(5)) and min(sizes.values()) > 800
    grouped = df.withColumn("g", fold_of("entity")).groupBy("entity").agg(F.count_distinct("g").alias("n"))
    assert grouped.where("n > 1").count() == 0
    other = df.where(fold_of("id", seed=1) != F.col("fold")).count()
    assert other > 0


@pytest.mark.parametrize("seed", range(4))
def test_balanced_folds(spark, seed):
    """One entity holds 15 % of the rows and others are heavy: folds differ by no more than the lightest placed entity."""
    rng = random.Random(seed)
    sizes = {0: 1500, **{i: rng.randrange(20, 400) for i in range(1, 30)}, **{i: rng.randrange(1, 6) for i in range(100, 1500)}}
    df = spark.createDataFrame([(e, i) for e, n in sizes.items() for i in range(n)], "e long, i long").repartition(5)
    placed = with_balanced_folds(df, "e")
    rows = {r["fold"]: r["count"] for r in placed.groupBy("fold").count().collect()}
    lightest = min(n for n in sizes.values() if n * HEAVY * 5 >= sum(sizes.values()))
    assert set(rows) == set(range(5)) and max(rows.values()) - min(rows.values()) <= lightest
    assert placed.groupBy("e").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()
    plain = {r["fold"]: r["count"] for r in df.groupBy(fold_of("e").alias("fold")).count().collect()}
    assert max(rows.values()) - min(rows.values()) < max(plain.values()) - min(plain.values())
    none = with_balanced_folds(spark.createDataFrame([(None,)], "e long"), "e").collect()
    assert [r["fold"] for r in none] == [None]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        x, c = rng.random(), rng.choice(["a", "b", None])
        y = None if i % 5 == 0 else float(x + (0.3 if c == "a" else 0) > 0.6)
        rows.append((i, y, x, rng.random(), None if i % 7 == 0 else float(i), c))
    df = spark.createDataFrame(rows, "id long, y double, x double, noise double, z double, `c (raw)` string")
    yield Prepared(with_folds(df, "id", 3), "id", "y", keep=["fold"])


def test_out_of_fold_covers_every_labelled_row_once(data):
    cv = cross_validate(data, QUICK, k=3)
    assert cv.oof.count() == 480 == cv.oof.select("id").distinct().count()
    assert cv.unlabelled.count() == 120
    assert cv.auc > 0.9 and set(cv.fold_auc) == {0, 1, 2}
    assert cv.oof.where("prediction < 0 or prediction > 1").count() == 0
    top = mean_importance(cv.importance, 2).collect()
    assert top[0]["feature"] == "x" and len(top) == 2


def test_seeds_are_averaged(data):
    assert bag_seeds(data, QUICK, seeds=[1, 2], k=2).count() == 120


def test_grid_runs_every_combination(data):
    assert len(combinations(GRID)) == 54 and len(combinations(STACKED_GRID)) == 9
    got = grid_search(data, QUICK, {"min_child_weight": [1, 200], "reg_alpha": [0, 1]}, k=2).collect()
    assert [r["combination"] for r in got][0] == "min_child_weight=1,reg_alpha=0" and len(got) == 4
    assert got[0]["auc"] == got[1]["auc"]


def test_parameters():
    assert to_gbt({"num_leaves": 32, "max_depth": -1})["maxDepth"] == 5
    assert to_gbt({"num_leaves": 64, "max_depth": 4, "colsample_bytree": 0.2})["maxDepth"] == 4


def test_selection(data):
    assert chunks(list("abcde"), 2) == [["a", "b"], ["c", "d"], ["e"]]
    dropped = backward(data, QUICK, n=3, k=2).collect()
    assert [r["step"] for r in dropped] == ["baseline", "drop", "drop"]
    added = forward(data, QUICK, base=["x"], candidates=["noise"], n=1, k=2).collect()
    assert [r["changed"] for r in added] == ["", "noise"]


def test_abandon_rule():
    rule = losing({0: 0.8, 1: 0.8, 2: 0.8}, 3)
    assert not rule({0: 0.7}) and rule({0: 0.7, 1: 0.79})
    assert not rule({0: 0.79, 1: 0.79, 2: 0.9})


def test_codes_are_a_dense_rank_of_any_width(spark):
    """Every value has a code of its own, the most frequent first, whether it is a category for the learner or not."""
    df = spark.range(50_000).select("id", (F.col("id") % 2).cast("double").alias("y"), F.concat(F.lit("v"), (F.col("id") / 2).cast("int")).alias("c"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("n"), F.col("id") % 3)).alias("d"))
    df = df.where("id < 49000 or id % 10 > 0").repartition(16)
    want = sorted(df.groupBy("c").count().collect(), key=lambda r: (-r["count"], r["c"]))
    for limit in (10, 1_000_000):
        data = Prepared(df, "id", "y", category_values=limit)
        got = {r["id"]: r for r in data.columns().collect()}
        code = {f"v{i // 2}": got[i]["c"] for i in got}
        assert code == {r["c"]: float(i) for i, r in enumerate(want)}
        assert {(i % 3, r["d"]) for i, r in got.items()} == {(1, 0.0), (0, 1.0), (2, 2.0)} or len({r["d"] for r in got.values()}) == 3
        assert data.bins == (32 if limit == 10 else len(want))


def test_codes_of_a_million_values(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(1_000_000).select(F.concat(F.lit("="), F.col("id") * 7919 % 1_000_003).alias("a"), F.lit("=x").alias("b"))
        codes = value_codes(df, ["a", "b"])
        found = codes.groupBy("place").agg(F.count("*").alias("n"), F.count_distinct("code").alias("codes"), F.min("code").alias("low"), F.max("code").alias("high"))
        assert sorted(tuple(r) for r in found.collect()) == [(0, 1_000_000, 1_000_000, 0.0, 999_999.0), (1, 1, 1, 0.0, 0.0)]
        low = [r["value"] for r in codes.where("place = 0").orderBy("code").limit(50).collect()]
        assert low == sorted(low)
        assert "SinglePartition" not in codes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_missing_is_below_everything_and_apart_from_empty_text(spark):
    df = spark.createDataFrame([(1, 1.0, -5e9, ""), (2, 0.0, None, None), (3, 1.0, -1e300, "a")], "id long, y double, x double, c string")
    rows = {r["id"]: r for r in Prepared(df, "id", "y").columns().collect()}
    assert rows[2]["x"] < rows[3]["x"] < rows[1]["x"]
    assert len({r["c"] for r in rows.values()}) == 3


@pytest.fixture(scope="module")
def noisy(spark):
    """The loss on held rows goes up and down while it falls."""
    rng = random.Random(5)
    rows = []
    for i in range(1500):
        x = [rng.random() for _ in range(10)]
        rows.append((i, float(sum(x[:5]) + rng.gauss(0, 0.5) > 2.5), *x))
    df = spark.createDataFrame(rows, "id long, y double, " + ", ".join(f"x{i} double" for i in range(10)))
    return Prepared(with_folds(df, "id", 3), "id", "y", keep=["fold"])


NOISY = {"n_estimators": 24, "max_depth": 4, "num_leaves": 16, "learning_rate": 0.2, "colsample_bytree": 0.2, "seed": 3}


def predictions(found):
    return {r["id"]: r["prediction"] for r in found.rows.select("id", "prediction").collect()}


def test_boosting_equals_mllib(noisy, tmp_path):
    """Without sampling, rounds by blocks give MLlib's boosted trees."""
    settings = to_gbt({**NOISY, "n_estimators": 5, "colsample_bytree": 1.0, "max_depth": 3})
    vectors = noisy.vectors()
    found = boost(vectors, "y", F.col("fold") != 0, settings, 32, str(tmp_path), patience=100, block=2)
    plain = GBTClassifier(labelCol="y", featuresCol="features", maxBins=32, **settings).fit(vectors.where("fold <> 0"))
    at_best = GBTClassifier(labelCol="y", featuresCol="features", maxBins=32, **{**settings, "maxIter": found.trees}).fit(vectors.where("fold <> 0"))
    scored = at_best.transform(vectors.where("fold = 0")).select("id", vector_to_array("probability")[1].alias("p")).collect()
    assert predictions(found) == pytest.approx({r["id"]: r["p"] for r in scored}, abs=1e-9)
    ranked = plain.transform(vectors.where("fold = 0")).select("y", vector_to_array("probability")[1].alias("p"))
    assert found.aucs[-1] == pytest.approx(auc_value(ranked, "y", "p"), abs=1e-9) and len(found.aucs) == 5


def test_a_plateau_does_not_stop_the_fit(noisy, tmp_path):
    vectors, settings = noisy.vectors(), to_gbt(NOISY)
    whole = boost(vectors, "y", F.col("fold") != 0, settings, 32, str(tmp_path / "whole"), patience=100, block=12)
    first_fall = next(i for i in range(1, 24) if whole.aucs[i] <= whole.aucs[i - 1])
    for patience, block in [(3, 2), (5, 4)]:
        found = boost(vectors, "y", F.col("fold") != 0, settings, 32, str(tmp_path / f"p{patience}"), patience, block)
        best, stopped = best_round([-a for a in whole.aucs], patience)
        assert (found.trees, found.stopped) == (best, stopped)
        assert found.aucs == pytest.approx(whole.aucs[: len(found.aucs)], abs=1e-12)
        assert len(found.aucs) <= best + patience + block
    assert first_fall < whole.trees


def test_a_killed_fit_goes_on(noisy, tmp_path):
    """No finished round is fitted again, and the result is that of one uninterrupted run, whatever the blocks."""
    vectors, settings, fitted = noisy.vectors(), to_gbt({**NOISY, "n_estimators": 9}), []

    def killed(i):
        fitted.append(i)
        if i == 5:
            raise KeyboardInterrupt

    args = (vectors, "y", F.col("fold") != 1, settings, 32)
    with pytest.raises(KeyboardInterrupt):
        boost(*args, str(tmp_path / "a"), patience=50, block=2, on_fit=killed)
    again = boost(*args, str(tmp_path / "a"), patience=50, block=2, on_fit=fitted.append)
    assert fitted == [0, 1, 2, 3, 4, 5, 4, 5, 6, 7, 8], "only the broken block is fitted again"
    whole = boost(*args, str(tmp_path / "b"), patience=50, block=9)
    assert again.aucs == pytest.approx(whole.aucs, abs=1e-12) and again.trees == whole.trees
    assert predictions(again) == pytest.approx(predictions(whole), abs=1e-12)
    assert again.importance == pytest.approx(whole.importance)
    done = boost(*args, str(tmp_path / "a"), patience=50, block=2, on_fit=lambda i: 1 / 0)
    assert predictions(done) == predictions(again)


def test_held_rows_of_one_class_do_not_stop_a_fit(data, tmp_path):
    vectors = data.vectors().where("fold <> 0 or y = 1 or y is null")
    found = boost(vectors, "y", F.col("fold") != 0, to_gbt(QUICK), 32, str(tmp_path), patience=1, block=2)
    assert found.trees == 3 and found.aucs == [None] * 3 and not found.stopped
    assert found.rows.where("prediction is null").count() == 0


def test_fits_read_no_other_rows(spark, tmp_path):
    """However many rounds are fitted, the rows are read once for those trained on and once for the others."""
    read = spark.sparkContext.accumulator(0)

    def counted(y):
        read.add(1)
        return y

    df = spark.range(4000).select("id", (F.col("id") * 37 % 101).cast("double").alias("x"), F.when(F.col("id") % 10 == 0, (F.col("id") % 3 == 0).cast("double")).alias("y"))
    vectors = Prepared(with_folds(df, "id", 2), "id", "y", keep=["fold"]).vectors()
    seen = vectors.withColumn("y", F.udf(counted, "double").asNondeterministic()("y"))
    found = boost(seen, "y", F.col("fold") != 0, {**to_gbt(QUICK), "maxIter": 4}, 32, str(tmp_path), patience=100, block=4)
    assert read.value <= 2 * 4000 and len(found.aucs) == 4
    want = df.count() - vectors.where("fold <> 0 and y is not null").count()
    assert found.rows.where("prediction between 0 and 1").count() == want == found.rows.select("id").distinct().count()


def test_blocks_do_not_change_the_trees(spark, tmp_path):
    """Rows in partitions of unequal size, of which thresholds are sampled: as many rounds in one block or in many."""
    df = spark.range(0, 30_000, 1, 1).select("id", *[F.rand(i).alias(f"x{i}") for i in range(4)])
    df = df.withColumn("y", (F.col("x0") + F.col("x1") + F.rand(9) > 1.5).cast("double"))
    df = df.repartitionById(4, F.floor(F.sqrt(F.col("id") / 2000)).cast("int"))
    vectors = Prepared(with_folds(df, "id", 2), "id", "y", keep=["fold"]).vectors()
    whole, parts = [boost(vectors, "y", F.col("fold") != 0, to_gbt(QUICK), 32, str(tmp_path / f"{n}"), patience=100, block=n) for n in (3, 1)]
    assert parts.aucs == pytest.approx(whole.aucs, abs=1e-12) and parts.importance == pytest.approx(whole.importance, abs=1e-12)
    assert predictions(parts) == pytest.approx(predictions(whole), abs=1e-12)


def test_best_round():
    assert best_round([5, 4, 4.5, 3, 3.5, 3.6], 2) == (4, True)
    assert best_round([5, 4, 4.5, 3], 3) == (4, False)
    assert best_round([1, 2, 3, 0], 2) == (1, True)


def test_cross_validation_is_a_loop_over_fits(noisy):
    """Predictions per fold, their mean, and the importances equal those of plain fits."""
    k, params = 3, {**NOISY, "n_estimators": 3}
    got = cross_validate(noisy, params, k, early_stop=False)
    vectors = noisy.vectors()
    for i in range(k):
        plain = GBTClassifier(labelCol="y", featuresCol="features", maxBins=32, **to_gbt(params)).fit(vectors.where(F.col("fold") != i))
        want = plain.transform(vectors.where(F.col("fold") == i)).select("id", vector_to_array("probability")[1].alias("p"))
        both = want.join(got.oof, "id")
        assert both.count() == want.count() and both.where("abs(p - prediction) > 1e-12").count() == 0
        weights = {r["feature"]: r["importance"] for r in got.importance.where(F.col("fold") == i).collect()}
        assert [weights[c] for c in noisy.features] == pytest.approx(list(plain.featureImportances.toArray()))
    assert got.trees == {0: 3, 1: 3, 2: 3}


def test_a_fold_of_one_class_decides_nothing():
    rule = losing({0: 0.8, 1: None, 2: 0.8}, 3)
    assert not rule({0: 0.7, 1: 0.9}) and rule({0: 0.7, 1: None, 2: 0.7})


def test_auc_in_many_ranges(spark, monkeypatch):
    monkeypatch.setattr("riskloom.models.auc.RANGE_SCORES", 50)
    test_auc_equals_mllib_with_many_ties(spark)


def test_grid_without_dead_dimensions():
    assert set(live_dimensions({}, GRID)) == {"min_child_weight", "colsample_bytree"}
    assert sum(len(c) for c in distinct_settings({}, GRID).values()) == 54 and len(distinct_settings({}, GRID)) == 6


def test_a_broken_grid_goes_on(data):
    logged = {}
    grid = {"min_child_weight": [1, 200]}
    whole = grid_search(data, QUICK, grid, k=2, log=lambda name, cv: logged.update({name: cv.auc}), early_stop=False).collect()
    assert logged == {r["fitted"]: r["auc"] for r in whole}
    assert grid_search(data, QUICK, grid, k=2, known=logged, log=lambda name, cv: 1 / 0).collect() == whole


def test_selection_logs_and_skips(data):
    rows = []
    backward(data, QUICK, n=3, k=2, log=rows.append, early_stop=False)
    assert [r[0] for r in rows] == ["baseline", "drop", "drop"]
    rows = []
    forward(data, QUICK, base=["x"], candidates=["noise", "z"], n=1, k=2, skip=1, log=rows.append)
    assert [r[1] for r in rows] == ["", "z"]


def test_bagging_scores_unlabelled_rows_in_one_pass(spark, monkeypatch):
    rng = random.Random(8)
    data = [(None if i % 10 == 9 else i % 70, rng.random(), rng.choice("abc"), rng.choice([0, 1, None])) for i in range(240)]
    df = with_folds(spark.createDataFrame(data, "id long, x double, t string, y int"), "id", 2)
    table, few = Prepared(df, "id", "y", keep=["fold"]), {**QUICK, "n_estimators": 2}
    runs = [cross_validate(table, {**few, "seed": s}, 2, early_stop=False).unlabelled for s in (1, 2)]
    want = {r["id"]: r["p"] for r in runs[0].union(runs[1]).groupBy("id").agg(F.avg("prediction").alias("p")).collect()}
    from riskloom.models import train

    written, computed = [], train.computed
    monkeypatch.setattr(train, "computed", lambda df: written.append(df) or computed(df))
    got = {r["id"]: r["prediction"] for r in bag_seeds(table, few, seeds=[1, 2], k=2, early_stop=False).collect()}
    assert got == pytest.approx(want) and len(written) == 1


def test_seeds_are_validated_together(spark, monkeypatch):
    from riskloom.models import train

    rng = random.Random(8)
    rows = [(i, i % 3 if i % 7 else None, None if i % 4 == 0 else float(rng.random() < (0.8 if x > 0 else 0.3)), x, rng.choice("abc")) for i in range(600) for x in [rng.gauss(0, 1)]]
    rows += rows[:40] + [(None, 1, 1.0, 0.5, "a"), (None, 2, None, 0.4, None)]  # keys may come twice or be missing
    table = Prepared(spark.createDataFrame(rows, "id int, part int, y double, a double, b string"), "id", "y", keep=["part"])
    few = {"n_estimators": 2, "max_depth": 2, "min_child_weight": 5}
    runs = [cross_validate(table, {**few, "seed": s}, 3, early_stop=False, fold="part") for s in (1, 2)]
    fits, tables, fitted, kept = [], [], train.fit, train.computed
    monkeypatch.setattr(train, "fit", lambda df, *more: fits.append(df._jdf.queryExecution().optimizedPlan().toString()) or fitted(df, *more))
    monkeypatch.setattr(train, "computed", lambda df: tables.append(df) or kept(df))
    found = list(train.cross_validate_seeds(table, few, (1, 2), 3, early_stop=False, fold="part"))
    assert [s for s, _ in found] == [1, 2]
    assert len(fits) == 6 and len(tables) == 1  # no table of scores for each fit
    assert all("InMemoryRelation" in plan for plan in fits)

    def values(df, *by):
        return sorted((*[str(r[c]) for c in by], round(r["prediction"], 9)) for r in df.collect())

    for (_, got), want in zip(found, runs):
        assert got.oof.columns == want.oof.columns and got.unlabelled.columns == want.unlabelled.columns
        assert values(got.oof, "id", "part", "y") == values(want.oof, "id", "part", "y")
        assert values(got.unlabelled, "id") == values(want.unlabelled, "id")
        assert got.auc == pytest.approx(want.auc, abs=1e-12) and got.trees == want.trees
        assert got.fold_auc == pytest.approx(want.fold_auc, abs=1e-12)
        assert sorted(got.importance.collect()) == sorted(want.importance.collect())

"""The end-to-end jobs on the stand-in tables, from files to files."""

import shutil

import pytest

from checks.standin import SCHEMAS, credit_table
from riskloom import jobs
from riskloom.models import stacked
from riskloom.operators import checks
from riskloom.plans.dropped import STRICT
from riskloom.sources import store
from riskloom.sources.tables import read_table, read_tables

SMALL = "/root/testdata/sf0.001"
QUICK = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3}


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("source"))
    for name in SCHEMAS:
        df = credit_table(spark, SMALL, name)
        if name == "application_all":
            df = df.selectExpr("*", "cast('NaN' as double) as EXTRA")
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_reading_types_nan_and_passes_extra_columns(spark, source):
    app = read_table(spark, source, "application_all")
    assert "EXTRA" in app.columns and app.where("EXTRA is not null").count() == 0
    t = read_tables(spark, source)
    assert dict(t.bureau.dtypes)["AMT_CREDIT_SUM"] == "double"


def test_missing_column_is_refused(spark, source, tmp_path):
    read_table(spark, source, "bureau").drop("CREDIT_TYPE").write.parquet(f"{tmp_path}/bureau.parquet")
    with pytest.raises(ValueError, match="CREDIT_TYPE"):
        read_table(spark, str(tmp_path), "bureau")


@pytest.fixture(scope="module")
def built(spark, source, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    stacked = jobs.build_stacked(spark, source, f"{out}/stacked.parquet", QUICK, k=2, seeds=range(2), metrics=f"{out}/stacked_metrics.parquet")
    assert sorted(stacked.columns) == ["POS_PREDICTED", "PREDICTED_X14Y-1", "SK_ID_CURR"]
    logged = {r["experiment"] for r in store.read_metrics(spark, f"{out}/stacked_metrics.parquet").collect()}
    assert {"PREDICTED_X14Y-1, seed 0", "POS_PREDICTED, seed 1"} <= logged
    jobs.build_features(spark, source, out, stacked_path=f"{out}/stacked.parquet")
    return out


def matrix_in(spark, out):
    return spark.read.parquet(f"{out}/features_all.parquet")


def test_matrix(spark, source, built):
    out, matrix = built, matrix_in(spark, built)
    known = read_table(spark, source, "application_all").where("CODE_GENDER <> 'XNA'").count()
    assert matrix.count() == known == matrix.select("SK_ID_CURR").distinct().count()
    assert matrix.columns == sorted(matrix.columns)
    assert not set(STRICT) & set(matrix.columns) and "POS_PREDICTED" in matrix.columns
    sample = spark.read.csv(f"{out}/all_sample", header=True)
    assert sample.count() == min(100, known) and sample.columns == matrix.columns


def test_resuming_reads_the_cached_parts(spark, source, built):
    out, before = built, matrix_in(spark, built)
    rows, columns = before.count(), before.columns
    again = jobs.build_features(spark, source, out, refresh=["app"], stacked_path=f"{out}/stacked.parquet")
    assert again.count() == rows and again.columns == columns
    assert store.Cache(spark, out, "creditbureau")._wanted("bureau") and not store.Cache(spark, out, [])._wanted("app")


def test_a_changed_input_rebuilds_the_parts_behind_it(spark, source, tmp_path):
    """A part is read back only if its files, code and schema are those of its manifest and its write was finished."""
    inside = str(tmp_path / "in")
    for name in SCHEMAS:
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{inside}/{name}.parquet")
    out, built = str(tmp_path / "out"), []
    keep = store.Cache.table

    def watched(self, name, build, *more):
        return keep(self, name, lambda: built.append(name) or build(), *more)

    def run():
        built.clear()
        store.Cache.table = watched
        try:
            return jobs.build_features(spark, inside, out, refresh=[])
        finally:
            store.Cache.table = keep

    first = run()
    rows = first.count()
    assert sorted(built) == ["app", "bureau", "cash", "credit", "install", "prev"]
    run()
    assert built == []
    spark.read.parquet(f"{source}/bureau_balance.parquet").limit(50).write.mode("overwrite").parquet(f"{inside}/bureau_balance.parquet")
    assert run().count() == rows and built == ["bureau"]
    shutil.rmtree(f"{out}/cache/cash.manifest")  # as a write that was broken off leaves it
    run()
    assert built == ["cash"]
    spark.read.parquet(f"{source}/previous_application.parquet").repartition(2).write.mode("overwrite").parquet(f"{inside}/previous_application.parquet")
    run()
    assert sorted(built) == ["cash", "credit", "install", "prev"]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    seen = checks.Observed(spark.range(50), "fifty")
    seen.rows.write.parquet(f"{tmp_path}/a")
    seen.require_some().require_rows(50)
    with pytest.raises(ValueError, match="expected 49"):
        seen.require_rows(49)
    none = checks.Observed(spark.range(0), "none")
    none.rows.write.parquet(f"{tmp_path}/b")
    with pytest.raises(ValueError, match="empty"):
        none.require_some()


def test_outcomes_in_one_pass(spark):
    """All variants equal the labels made one by one, and the payments are read once."""
    payments = credit_table(spark, SMALL, "installments_payments")
    variants = {**jobs.LATE_VARIANTS, "other": (0, 2)}
    got = stacked.late_variants(payments, variants)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 1 or plan.count("FileScan") == payments._jdf.queryExecution().executedPlan().toString().count("FileScan")
    wide = {r[0]: r.asDict() for r in got.collect()}
    for name, (days, first) in variants.items():
        single = {r[0]: r[1] for r in stacked.late_instalments(payments, days, first).collect()}
        assert {k: r[name] for k, r in wide.items() if r[name] is not None} == single


def test_training_writes_everything(spark, built):
    out, matrix = built, matrix_in(spark, built)
    narrow = matrix.select("SK_ID_CURR", "TARGET", "CODE_GENDER", "AMT_CREDIT", "`b_mean(DAYS_CREDIT)`", "POS_PREDICTED")
    result = jobs.train_and_predict(spark, narrow, out, "quick", params=QUICK, k=2)
    unlabelled = narrow.where("TARGET is null").count()
    assert spark.read.csv(f"{out}/quick.csv", header=True).count() == unlabelled
    assert spark.read.parquet(f"{out}/quick_oof.parquet").count() == narrow.count() - unlabelled
    assert spark.read.parquet(f"{out}/quick_importance.parquet").count() == 2 * len(narrow.columns[2:])
    logged = {r["metric"]: r["value"] for r in store.read_metrics(spark, f"{out}/metrics.parquet").collect()}
    assert logged["auc"] == pytest.approx(result.auc)
    store.log_metrics(spark, f"{out}/metrics.parquet", "second", {"auc": 0.5})
    assert store.read_metrics(spark, f"{out}/metrics.parquet").where("metric = 'auc'").count() == 2


def test_template_is_filled_by_key(spark, tmp_path):
    ids = spark.createDataFrame([(1, 0.0), (2, 0.0)], "SK_ID_CURR long, TARGET double")
    ids.write.csv(f"{tmp_path}/template", header=True)
    predictions = spark.createDataFrame([(2, 0.7), (1, 0.2)], "SK_ID_CURR long, TARGET double")
    filled = store.fill_template(spark, f"{tmp_path}/template", predictions, "SK_ID_CURR")
    assert sorted(tuple(r) for r in filled.collect()) == [(1, 0.2), (2, 0.7)]
    store.write_predictions(predictions, "SK_ID_CURR", "TARGET", f"{tmp_path}/p", format="parquet")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2


@pytest.mark.parametrize("early_stop", [False, True])
def test_an_outcome_may_be_called_as_a_column_of_a_fitted_model(spark, source, early_stop):
    t = read_tables(spark, source)
    late = stacked.late_variants(t.installments_payments, {"late": (7, -1), "later": (14, -1)})
    few = {**QUICK, "n_estimators": 1}
    want = stacked.stacked_features(t.application_all, t.previous_application, late, few, k=2, early_stop=early_stop)
    own = late.withColumnsRenamed({"late": "prediction", "later": "probability"})
    got = stacked.stacked_features(t.application_all, t.previous_application, own, few, k=2, early_stop=early_stop)
    assert got.columns == ["SK_ID_CURR", "prediction", "probability"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

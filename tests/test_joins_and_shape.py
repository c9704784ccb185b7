import pytest
from pyspark.sql import functions as F

from riskloom.operators import checks, joins, shape
from riskloom.plans.feature_sets import RARE_DOCUMENTS, SETS, FeatureSet


@pytest.fixture(scope="module")
def parent(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, "b", 20.0)], "k long, s string, x double")


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0), (3, 7, 3.0), (None, 8, 4.0)], "k long, id long, x double")


def test_enrich_keeps_every_child_row_and_its_own_values(child, parent, rows):
    assert rows(joins.enrich(child, parent, "k"), "id", "x", "s") == [(5, 1.0, "a"), (6, 2.0, "a"), (7, 3.0, None), (8, 4.0, None)]


def test_attach_small_equals_attach_on_both_paths(child, parent, rows, monkeypatch):
    want = rows(joins.attach(child.select("k", "id"), parent, "k"))
    assert rows(joins.attach_small(child.select("k", "id"), parent, "k")) == want
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    assert rows(joins.attach_small(child.select("k", "id"), parent, "k")) == want


def test_semi_and_anti_split_the_rows(child, parent, rows):
    inside, outside = joins.only_keys(child, parent, "k"), joins.without_keys(child, parent, "k")
    assert rows(inside, "id") == [(5,), (6,)]
    assert rows(outside, "id") == [(7,), (8,)]


def test_mark_keys_with_repeated_and_null_ids(child, spark, rows):
    ids = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    assert rows(joins.mark_keys(child, ids, "k", "m"), "id", "m") == [(5, 1), (6, 1), (7, 0), (8, 0)]


def test_override_takes_the_childs_values(child, parent, rows):
    assert rows(joins.override_columns(child, parent, "k", ["x"], keep=["id"]), "id", "x", "s") == [
        (5, 1.0, "a"), (6, 2.0, "a"), (7, 3.0, None), (8, 4.0, None),
    ]


def test_add_columns_leaves_out_known_ones(parent, spark, rows):
    extra = spark.createDataFrame([(1, 99.0, 7.0)], "k long, x double, y double")
    assert rows(joins.add_columns(parent, extra, "k")) == [(1, "a", 10.0, 7.0), (2, "b", 20.0, None)]


def test_drops(parent):
    assert shape.drop_if_present(parent, ["x", "nope"]).columns == ["k", "s"]
    assert shape.drop_required(parent, ["x"]).columns == ["k", "s"]
    with pytest.raises(ValueError):
        shape.drop_required(parent, ["nope"])


def test_names(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "`b_mean(AMT X)` double, A double")
    assert shape.plain_names(df).columns == ["b_mean_amt_x", "a"]
    assert shape.sorted_columns(df).columns == ["A", "b_mean(AMT X)"]


def test_stack_and_top(parent, spark, rows):
    other = spark.createDataFrame([(9, 20.0)], "k long, x double")
    both = shape.stack_sources(p=parent, o=other)
    assert rows(both, "k", "s", "source") == [(1, "a", "p"), (2, "b", "p"), (9, None, "o")]
    assert [r["k"] for r in shape.top_rows(both, "x", "k", 2).collect()] == [2, 9]


def test_checks(parent, child):
    assert checks.require_rows(parent, 2) is parent
    with pytest.raises(ValueError):
        checks.require_rows(parent, 3)
    checks.require_some(parent=parent)
    with pytest.raises(ValueError):
        checks.require_some(parent=parent.where(F.lit(False)))
    checks.require_same_columns(parent, parent.select("x", "s", "k"))
    with pytest.raises(ValueError):
        checks.require_same_columns(parent, child)


def test_feature_sets_grow_and_apply(spark):
    assert SETS["model2"].remove == RARE_DOCUMENTS and not SETS["model2"].known_gender
    for smaller, larger in [("model3", "model6"), ("model6", "model7"), ("model7", "model8"), ("model8", "model9")]:
        assert set(SETS[smaller].add) < set(SETS[larger].add)
    assert "PREDICTED_X28Y-1" in SETS["model10_x28y-1"].add and "PREDICTED_DPD" not in SETS["model10_x28y-1"].add
    assert SETS["model11"].folds == 10 and SETS["model4"].max_depth == -1 and len(SETS["model11"].add) == 83 + 1
    base = spark.createDataFrame([(1, "F", 1, 2), (2, "XNA", 3, 4), (3, None, 5, 6)], "SK_ID_CURR long, CODE_GENDER string, a int, b int")
    extra = spark.createDataFrame([(1, 9)], "SK_ID_CURR long, c int")
    out = FeatureSet("x", add=("c",), remove=("b",)).apply(base, extra)
    assert out.columns == ["SK_ID_CURR", "CODE_GENDER", "a", "c"] and out.count() == 2
    with pytest.raises(ValueError):
        FeatureSet("x", add=("d",)).apply(base, extra)

"""Medians, fills, pooled means, encodings, rates."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskloom.operators import groups
from riskloom.session import computed


def test_median_of_four_one_and_none(spark, rows):
    data = [("a", x) for x in (1.0, 2.0, 4.0, 10.0)] + [("b", 7.0), ("c", None), (None, 3.0)]
    df = spark.createDataFrame(data, "cat string, x double")
    assert rows(groups.median_by(df, "cat", "x", "m")) == [("a", 3.0), ("b", 7.0)]


@pytest.mark.parametrize("seed", range(3))
def test_median_against_brute_force_with_a_hot_group_and_ties(spark, seed):
    rng = random.Random(seed)
    data = []
    for _ in range(60_000):
        g = "hot" if rng.random() < 0.4 else rng.choice("abcdef")
        x = rng.choice([1.0, 2.0, rng.gauss(0, 1), float(rng.randrange(5))])
        data.append((g, x, rng.random()))
    df = spark.createDataFrame(data, "g string, x double, y double").repartition(7)
    want_x, want_y = {}, {}
    for g, x, y in data:
        want_x.setdefault(g, []).append(x)
        want_y.setdefault(g, []).append(y)
    got = {r["g"]: (r["mx"], r["my"]) for r in groups.medians_by(df, "g", {"x": "mx", "y": "my"}).collect()}
    for g in want_x:
        assert got[g] == (pytest.approx(statistics.median(want_x[g])), pytest.approx(statistics.median(want_y[g])))


@pytest.mark.parametrize("limit", [0.5, 10, 1000])
def test_median_with_narrowed_brackets(spark, monkeypatch, limit):
    monkeypatch.setattr(groups, "BRACKET_ROWS", limit)
    rng = random.Random(limit)
    data = [("hot" if rng.random() < 0.5 else rng.choice("ab"), rng.choice([rng.gauss(5, 2), 5.0])) for _ in range(30_001)]
    data += [("tiny", 1.0), ("pair", 1.0), ("pair", 4.0)] + [("same", 3.0)] * 5000
    df = spark.createDataFrame(data, "g string, x double").repartition(5)
    want = {}
    for g, x in data:
        want.setdefault(g, []).append(x)
    got = {r["g"]: r["m"] for r in groups.median_by(df, "g", "x", "m").collect()}
    assert got == {g: pytest.approx(statistics.median(xs)) for g, xs in want.items()}


def test_relative_to_median(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", 4.0), (3, None, 5.0), (4, "z", 0.0)], "id long, cat string, x double")
    got = rows(groups.relative_to_median(df, "cat", {"x": "rel"}), "id", "rel")
    assert got == [(1, 2 / 3), (2, 4 / 3), (3, None), (4, None)]


def test_fill_with_mean_uses_only_known_values(spark, rows):
    df = spark.createDataFrame([(1, 2.0, True), (2, None, True), (3, 6.0, False)], "id long, x double, train boolean")
    assert rows(groups.fill_with_mean(df, "x"), "id", "x") == [(1, 2.0), (2, 4.0), (3, 6.0)]
    fitted = groups.fill_with_mean(df, "x", fit_on=F.col("train"))
    assert rows(fitted, "id", "x") == [(1, 2.0), (2, 2.0), (3, 6.0)]


def test_pooled_mean_has_one_row_per_key_and_no_group_for_nulls(spark, rows):
    current = spark.createDataFrame([(1, "o", "p", "cash", 10.0), (2, None, "p", "cash", 20.0)], "k long, org string, occ string, kind string, amt double")
    earlier = spark.createDataFrame([("o", "q", "cash", 30.0), ("o", "q", "card", 99.0)], "org string, occ string, kind string, amt double")
    out = groups.pooled_group_mean(current, earlier, "k", {"ORG": "org", "OCC": "occ"}, "kind", ["amt"])
    got = rows(out, "k", "amt_BY_ORG", "amt_BY_ORG_RATIO", "amt_BY_ORG_DIFF", "amt_BY_OCC")
    assert got == [(1, 20.0, 0.5, -10.0, 15.0), (2, None, None, None, 15.0)]


def test_mean_by_type(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "b", 4.0), (2, "b", 6.0)], "k long, t string, x double")
    out = groups.mean_by_type(df, "k", "t", {None: "", "a": "A_"}, {"x": "X"})
    assert rows(out) == [(1, 3.0, 2.0), (2, 6.0, None)]


def test_target_mean_can_leave_rows_out_of_the_fit(spark, rows):
    df = spark.createDataFrame([(1, "a", 1.0, 0), (2, "a", 0.0, 1), (3, "b", 1.0, 1), (4, None, 1.0, 0)], "id long, c string, y double, fold int")
    assert rows(groups.target_mean(df, "c", "y", "m"), "id", "m") == [(1, 0.5), (2, 0.5), (3, 1.0), (4, None)]
    assert rows(groups.target_mean(df, "c", "y", "m", F.col("fold") == 0), "id", "m") == [(1, 1.0), (2, 1.0), (3, None), (4, None)]


def test_event_label(spark, rows):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 0), (2, 1)], "loan long, dpd int")
    assert rows(groups.event_rate(df, "loan", F.col("dpd") > 3, "r")) == [(1, 0.5), (2, 0.0)]
    assert rows(groups.event_label(df, "loan", F.col("dpd") > 3, "late")) == [(1, 1), (2, 0)]
    assert rows(groups.event_label(df, "loan", F.col("dpd") > 3, "late", cutoff=0.5)) == [(1, 0), (2, 0)]


def test_frequency_and_correlation(spark, rows):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 4.0), (None, 3.0, None), ("b", 4.0, 8.0)], "c string, x double, y double")
    assert rows(groups.frequency(df, "c")) == [("a", 2), ("b", 1)]
    assert groups.correlation(df, "x", "y").first()[0] == pytest.approx(1.0)


def test_a_missed_bracket_is_done_again(spark, monkeypatch):
    """Brackets that lie beside the middle cost another pass and change no median."""
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("b", 3.0), ("b", 4.0), ("c", 7.0)], "g string, x double")

    def beside(rows):
        return computed(rows.groupBy("_g", "_t").agg(F.min("_x").alias("_from"), F.min("_x").alias("_to")))

    monkeypatch.setattr(groups, "_brackets", beside)
    got = {r["g"]: r["m"] for r in groups.median_by(df, "g", "x", "m").collect()}
    assert got == {"a": 50.0, "b": 3.5, "c": 7.0}
    monkeypatch.setattr(groups, "_small", lambda rows, brackets: brackets.withColumn("_to", F.col("_from")))
    assert {r["g"]: r["m"] for r in groups.median_by(df, "g", "x", "m").collect()} == got


def test_means_of_groups_are_computed_once(spark, rows, monkeypatch):
    from riskloom.operators import groups

    df = spark.createDataFrame([(1, "a", "x", "k", 1.0), (2, "a", "y", "k", 3.0), (3, "b", "y", "k", 5.0), (4, None, "y", "m", 7.0), (4, None, "y", "m", None)], "id int, g string, h string, t string, v double")
    tables, kept = [], groups.computed
    monkeypatch.setattr(groups, "computed", lambda d: tables.append(d) or kept(d))
    groupings = {"G": "g", "H": "h"}
    out = groups.against_means(df, groups.group_means(df, groupings, "t", ["v"]), groupings, "t", ["v"])
    assert len(tables) == 1  # not again for each grouping
    found = sorted((r["id"], str(r["v"]), r["v_BY_G"], r["v_BY_H"], r["v_BY_H_DIFF"]) for r in out.collect())
    assert found == [(1, "1.0", 2.0, 1.0, 0.0), (2, "3.0", 2.0, 4.0, -1.0), (3, "5.0", 5.0, 4.0, 1.0), (4, "7.0", None, 7.0, 0.0), (4, "None", None, 7.0, None)]

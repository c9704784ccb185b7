"""Feature maps and slices: null groups, absent groups, agreement of layouts, hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.aggregate import (
    Slice, aggregate, aggregate_slices, aggregate_slices_by_join, group_stat, heavy_keys, read_spec,
)
from riskloom.operators.joins import attach

SCHEMA = "k long, id long, status string, days int, amt double"
CHILD = [
    (1, 1, "A", -10, None), (1, 2, "B", -900, None),
    (2, 3, "A", -400, 5.0),
    (3, 4, "A", -10, 1.0), (3, 5, None, -20, 2.0), (3, 6, "B", None, 4.0), (3, 7, "B", -30, None),
    (None, 8, "A", -1, 100.0),
]


@pytest.fixture(scope="module")
def child(spark):
    return spark.createDataFrame(CHILD, SCHEMA)


@pytest.fixture(scope="module")
def base(spark):
    return spark.createDataFrame([(1,), (2,), (3,), (4,)], "k long")


def test_spec_text():
    assert read_spec("a | mean max\n  b c | sum") == [("a", "mean"), ("a", "max"), ("b c", "sum")]


def test_sum_count_std_and_absent_groups(child, base, rows):
    stats = aggregate(child, "k", read_spec("amt | count sum mean std size"), "c_", size_as="n")
    got = {r[0]: r[1:] for r in rows(attach(base, stats, "k"))}
    assert got[1] == (0, 0.0, None, None, 2, 2)  # all missing: sum 0, mean null, size counts rows
    assert got[2] == (1, 5.0, 5.0, None, 1, 1)  # one row: no standard deviation
    assert got[3][0:3] == (3, 7.0, pytest.approx(7 / 3)) and got[3][4:] == (4, 4)
    assert got[4] == (None,) * 6  # no rows: null everywhere, counts included
    assert set(got) == {1, 2, 3, 4}


def slices():
    spec = read_spec("amt | count sum mean min max std var\n status | nunique")
    return [
        Slice("all_", None, spec),
        Slice("a_", F.col("status") == "A", spec),
        Slice("recent_", F.col("days") >= -365, read_spec("amt | sum")),
    ]


def test_slices_give_the_same_as_one_join_per_slice(child, base, rows):
    wide = attach(base, aggregate_slices(child, "k", slices()), "k")
    joined = aggregate_slices_by_join(child, base, "k", slices())
    assert wide.columns == joined.columns
    # The layouts add up in different orders.
    assert [pytest.approx(r, abs=1e-12) for r in rows(joined)] == rows(wide)


def test_row_filter_drops_undecidable_rows(child, rows):
    got = dict(rows(aggregate_slices(child, "k", slices()), "k", "`recent_sum(amt)`"))
    assert got == {1: 0.0, 2: None, 3: 3.0}


def test_extra_aggregates(child, rows):
    s = [Slice("x_", F.col("status") == "B", [], {"best": F.max("id")})]
    assert dict(rows(aggregate_slices(child, "k", s))) == {1: 2, 3: 7}


def test_one_key_with_a_third_of_the_rows(spark, rows):
    rng = random.Random(5)
    data = [
        (0 if rng.random() < 0.34 else rng.randrange(1, 400), i, rng.choice("AB"), rng.randrange(-800, 0), float(rng.randrange(100)))
        for i in range(20_000)
    ]
    child = spark.createDataFrame(data, SCHEMA)
    base = child.select("k").distinct()
    a = attach(base, aggregate_slices(child, "k", slices()), "k")
    b = aggregate_slices_by_join(child, base, "k", slices())
    columns = [f"round(`{c}`, 6)" if c != "k" else c for c in a.columns]
    assert rows(a.selectExpr(*columns)) == rows(b.selectExpr(*columns))


def test_a_hot_partition_is_split_before_the_wide_aggregate(spark):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(0, 600_000, 1, 12).selectExpr(
            "if(id % 3 = 0, 0, id % 20000) as k", "id", "if(id % 2 = 0, 'A', 'B') as status",
            "cast(-(id % 900) as int) as days", "cast(id % 97 as double) as amt",
        )
        out = aggregate_slices(df, "k", slices())
        total = out.agg(F.sum("`all_count(amt)`")).first()[0]
        out.collect()
        assert total == 600_000
        assert "AQEShuffleRead skewed" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")


def test_slices_of_a_partition_add_up(child, rows):
    spec = read_spec("id | count")
    parts = [Slice("a_", F.col("status") == "A", spec), Slice("rest_", ~F.coalesce(F.col("status") == "A", F.lit(False)), spec), Slice("all_", None, spec)]
    for _, a, rest, total in rows(aggregate_slices(child, "k", parts)):
        assert (a or 0) + (rest or 0) == total


def test_group_stat_leaves_null_keys_null(child, rows):
    merged = group_stat(child, ["k", "status"], "id", "count", "n")
    got = {r[0]: r[1] for r in rows(merged, "id", "n")}
    assert got[4] == 1 and got[6] == 2 and got[7] == 2
    assert got[5] is None and got[8] is None
    assert merged.count() == len(CHILD)
    alone = group_stat(child, "status", "id", "count", "n", merge=False)
    assert rows(alone) == [("A", 4), ("B", 3)]


def test_the_rows_are_shuffled_narrow_and_partials_combine(child):
    plan = aggregate_slices(child, "k", slices())._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "partial_avg" in plan


def test_features_left_out_are_not_computed(spark):
    child = spark.createDataFrame([(1, 5.0, 2.0, True), (1, 7.0, 3.0, False), (2, 1.0, 4.0, False)], "k long, amt double, other double, recent boolean")
    wanted = [Slice("all_", None, [("amt", "sum"), ("other", "max")]), Slice("recent_", F.col("recent"), [("other", "mean")])]
    got = aggregate_slices(child, "k", wanted, without=["all_max(other)", "recent_mean(other)"])
    assert got.columns == ["k", "all_sum(amt)"]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above_the_scan = "\n".join(plan.splitlines()[:-1])
    assert "max(" not in above_the_scan and "avg(" not in above_the_scan and "other" not in above_the_scan
    assert sorted(map(tuple, got.collect())) == [(1, 12.0), (2, 1.0)]


def test_medians_ride_along(spark, monkeypatch):
    """Exact medians in feature maps, slices and group statistics, also where a group is read again."""
    monkeypatch.setattr("riskloom.operators.aggregate.SUMMARY_ROWS", 50)
    rng = random.Random(4)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), i, rng.choice("AB"), -i, rng.choice([None, rng.random(), float(rng.randrange(5))])) for i in range(4000)]
    data += [(9, 0, "A", -1, None), (10, 0, "B", -1, 4.0), (10, 0, "B", -1, 1.0), (11, 1, "A", -2, 7.5)]
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    spec = read_spec("amt | median mean\n days | median")

    def median(xs):
        xs = sorted(x for x in xs if x is not None)
        return None if not xs else pytest.approx((xs[(len(xs) - 1) // 2] + xs[len(xs) // 2]) / 2, abs=1e-12)

    def of(key, column, keep=lambda r: True):
        return median([r[column] for r in data if r[0] == key and keep(r)])

    got = {r[0]: r for r in aggregate(df, "k", spec, "c_", size_as="n").collect()}
    assert {k: (r["c_median(amt)"], r["c_median(days)"]) for k, r in got.items()} == {k: (of(k, 4), of(k, 3)) for k in got}
    assert sum(r["n"] for r in got.values()) == sum(r[0] is not None for r in data)
    wide = aggregate_slices(df, "k", [Slice("all_", None, spec), Slice("b_", F.col("status") == "B", spec)])
    for r in wide.collect():
        assert r["all_median(amt)"] == of(r["k"], 4) and r["all_median(days)"] == of(r["k"], 3)
        assert r["b_median(amt)"] == of(r["k"], 4, lambda x: x[2] == "B")
    stat = {r["k"]: r["m"] for r in group_stat(df, "k", "amt", "median", "m", merge=False).collect()}
    assert stat == {k: of(k, 4) for k in stat}


def test_median_reads_only_large_groups_again(spark, monkeypatch):
    """A group whose summary is sure of the middle is not looked at twice."""
    seen = []
    real = __import__("riskloom.operators.aggregate", fromlist=["medians_by"]).medians_by
    monkeypatch.setattr("riskloom.operators.aggregate.medians_by", lambda rows, by, cs: seen.append(rows.count()) or real(rows, by, cs))
    small = spark.range(3000).select((F.col("id") % 100).alias("k"), F.rand(1).alias("x"))
    equal = spark.range(30_000).select(F.lit(500).cast("long").alias("k"), F.lit(2.0).alias("x"))
    aggregate(small.union(equal), "k", [("x", "median")]).collect()
    assert seen == []
    large = spark.range(20_000).select(F.lit(700).cast("long").alias("k"), F.rand(2).alias("x"))
    aggregate(small.union(equal).union(large), "k", [("x", "median")]).collect()
    assert seen == [20_000]


def test_distinct_counts_by_bits(spark, monkeypatch):
    """No distinct aggregate in the plan, and the same counts, for one number of bits and for several."""
    rng = random.Random(7)
    data = [(rng.randrange(30), i, rng.choice([None, *"ABCDE"]), rng.randrange(200), rng.choice([None, float(rng.randrange(70))])) for i in range(3000)]
    df = spark.createDataFrame([*data, (99, 0, None, 1, None)], SCHEMA)
    spec = read_spec("status | nunique\n days | nunique\n amt | nunique sum")
    made = [Slice("all_", None, spec), Slice("a_", F.col("status") == "A", spec)]
    wide = aggregate_slices(df, "k", made)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "distinct" not in plan.lower() and "bit_or" in plan
    want = {}
    for r in [*data, (99, 0, None, 1, None)]:
        for prefix, keep in (("all_", True), ("a_", r[2] == "A")):
            if keep:
                for c, v in (("status", r[2]), ("days", r[3]), ("amt", r[4])):
                    want.setdefault((r[0], f"{prefix}nunique({c})"), set()).update([] if v is None else [v])
    got = {(r["k"], c): r[c] for r in wide.collect() for c in wide.columns if "nunique" in c and r[c] is not None}
    assert got == {k: len(v) for k, v in want.items()}
    monkeypatch.setattr("riskloom.operators.aggregate.BIT_VALUES", 3)
    assert {(r["k"], c): r[c] for r in aggregate_slices(df, "k", made).collect() for c in wide.columns if "nunique" in c and r[c] is not None} == got


@pytest.mark.parametrize("least", [3, 1_000_000])
def test_heavy_keys_go_another_way_with_the_same_result(spark, rows, monkeypatch, least):
    monkeypatch.setattr("riskloom.operators.aggregate.HEAVY_ROWS", least)
    data = [(k, i, random.Random(i).choice("AB"), -i, float(i)) for i, k in enumerate([0] * 9 + [1] * 3 + [2, 3, 3, None, None])]
    df = spark.createDataFrame(data, "k long, id long, status string, days int, amt double")
    heavy = heavy_keys(df, "k")
    assert rows(heavy) == ([(0,)] if least == 3 else [])
    a, b = aggregate_slices(df, "k", slices(), (), heavy), aggregate_slices(df, "k", slices())
    assert a.columns == b.columns and rows(a) == rows(b)


def test_rows_without_heavy_keys_are_shuffled_once(spark, child):
    plan = aggregate_slices(child, "k", [Slice("", None, read_spec("amt | sum std"))], (), heavy_keys(child, "k"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

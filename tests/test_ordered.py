"""Latest, earliest, gaps and active loans against brute force."""

import random

import pytest

from riskloom.operators import ordered


def test_latest_keeps_nulls_and_breaks_ties_by_the_carried_values(spark, rows):
    df = spark.createDataFrame([(1, -1, None), (1, -2, 5.0), (2, -3, 1.0), (2, -3, 9.0), (None, 0, 1.0)], "k long, m int, v double")
    assert rows(ordered.latest_row(df, "k", "m", ["v"])) == [(1, -1, None), (2, -3, 9.0)]
    assert rows(ordered.earliest_row(df, "k", "m", ["v"])) == [(1, -2, 5.0), (2, -3, 1.0)]
    assert rows(ordered.latest_present(df, "k", "m", "v")) == [(1, -2, 5.0), (2, -3, 9.0)]


def test_planned_and_actual(spark, rows):
    df = spark.createDataFrame([(7, 1, -3, 12.0), (7, 1, -2, 10.0), (7, 1, -1, 6.0), (8, 1, -1, 0.0)], "loan long, who long, m int, n double")
    out = ordered.planned_and_actual(df, "loan", "who", "m", "n")
    assert rows(out, "loan", "n_AHEAD", "n_AHEAD_RATIO") == [(7, 6.0, 0.5), (8, 0.0, None)]


def test_last_by_min_skips_missing_limits(spark, rows):
    df = spark.createDataFrame([(7, 1, -2, 100.0), (7, 1, -1, 300.0), (7, 1, 0, None), (8, 1, 0, None)], "loan long, who long, m int, lim double")
    assert rows(ordered.last_by_min(df, "loan", "who", "m", "lim", "x")) == [(7, 1, 3.0), (8, 1, None)]


def brute_gaps(data):
    """Row by row: sort descending with missing days last, subtract the next."""
    by_loan = {}
    for owner, loan, day in data:
        by_loan.setdefault((owner, loan), []).append(day)
    out = {}
    for (owner, _), days in by_loan.items():
        days = sorted((d for d in days if d is not None), reverse=True)
        gaps = [a - b for a, b in zip(days, days[1:])]
        out.setdefault(owner, []).extend(gaps)
    return out


def test_gaps_against_brute_force_with_copies(spark, rows):
    rng = random.Random(3)
    data = [(rng.randrange(3), rng.randrange(4), rng.choice([None, -5.0, float(-rng.randrange(60))])) for _ in range(600)]
    data += [(0, 0, -7.0)] * 400  # a third of the rows are copies
    df = spark.createDataFrame(data, "who long, loan long, day double")
    got = {r[0]: r[1:] for r in rows(ordered.gap_stats(ordered.payment_gaps(df, "who", "loan", "day"), "who", "p_", "gap"))}
    for owner, gaps in brute_gaps(data).items():
        assert got[owner] == (pytest.approx(sum(gaps) / len(gaps)), min(gaps))


def test_single_payment_has_no_gap(spark, rows):
    df = spark.createDataFrame([(1, 1, -5.0)], "who long, loan long, day double")
    assert rows(ordered.gap_stats(ordered.payment_gaps(df, "who", "loan", "day"), "who", "p_", "g")) == [(1, None, None)]


def test_largest_row_puts_missing_last(spark, rows):
    df = spark.createDataFrame([(1, 10, None, "a"), (1, 11, 5.0, "b"), (1, 12, 5.0, "c"), (2, 13, None, "d")], "k long, id long, x double, s string")
    assert rows(ordered.largest_row(df, "k", "x", "id", ["s"])) == [(1, "c"), (2, "d")]


def test_active_loans(spark, rows):
    df = spark.createDataFrame(
        [(1, -1, "Active"), (2, -1, "Active"), (2, -5, "Completed"), (3, -13, "Active"), (4, -12, None), (None, 0, "Active")],
        "loan long, m int, status string",
    )
    assert rows(ordered.active_loans(df, "loan", "m", "status")) == [(1,), (4,)]
    assert ordered.active_rows(df, "loan", "m", "status").count() == 2


def test_attach_group(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, None), (1, 2, 7.0), (None, 2, 9.0)], "a long, b long, x double")
    out = ordered.attach_group(df, ["a", "b"], n=F.count("x"), least=F.min("x"))
    assert rows(out, "a", "b", "x", "n", "least") == [(1, 1, 5.0, 1, 5.0), (1, 1, None, 1, 5.0), (1, 2, 7.0, 1, 7.0), (None, 2, 9.0, None, None)]

"""Feature plans on skewed hand-made data against plain Python."""

import random

import pytest

from checks.standin import credit_tables
from riskloom.plans import bureau, credit_card, installments, pos_cash, previous

RNG = random.Random(8)


def payments_data():
    """One loan holds a third of the rows, and many of those are copies."""
    data = []
    for _ in range(900):
        hot = RNG.random() < 0.4
        loan = 1 if hot else RNG.randrange(2, 40)
        due = float(RNG.choice([-40, -400]))
        paid = RNG.choice([None, -35.0, due, due - 3, due + RNG.randrange(20)])
        data.append((loan, 100 + loan % 5, 1 if hot else RNG.randrange(3), float(RNG.randrange(2)), due, paid, 10.0, RNG.choice([None, 0.0, 5.0, 10.0])))
    return data + [(1, 101, 1, 1.0, -40.0, -38.0, 10.0, 5.0)] * 300


@pytest.fixture(scope="module")
def payments(spark):
    data = payments_data()
    schema = """SK_ID_PREV long, SK_ID_CURR long, NUM_INSTALMENT_NUMBER int, NUM_INSTALMENT_VERSION double,
        DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double, AMT_INSTALMENT double, AMT_PAYMENT double"""
    prev = spark.createDataFrame([(i, "Cash loans" if i % 2 else "Consumer loans") for i in range(1, 35)], "SK_ID_PREV long, NAME_CONTRACT_TYPE string")
    card = spark.createDataFrame([(3,), (3,), (39,), (None,)], "SK_ID_PREV long")
    return data, spark.createDataFrame(data, schema), prev, card


def brute(data):
    groups = {}
    for r in data:
        groups.setdefault((r[0], r[2], r[3]), []).append(r)
    out = []
    for r in data:
        loan, who, num, ver, due, paid, asked, amount = r
        peers = groups[(loan, num, ver)]
        late = lambda x: max(x[5] - x[4], 0.0) if x[5] is not None else 0.0
        dpd = late(r)
        first = min((p[5] for p in peers if p[5] is not None), default=None)
        on_time = [p for p in peers if late(p) == 0]
        paid_on_time = sum(p[7] or 0.0 for p in on_time) if on_time else None
        early = first is not None and first < due
        rate = 0.0
        if dpd > 0 and paid_on_time is not None and amount:
            rate = paid_on_time / amount
        out.append((loan, dpd, sum(p[7] is not None for p in peers), first, 0.0 if early else dpd, dpd if early else 0.0, rate, int(loan in (3, 39)), None if loan > 34 else ("Cash loans" if loan % 2 else "Consumer loans")))
    return sorted(out, key=repr)


def test_payment_rows_with_a_hot_loan(payments, rows):
    data, df, prev, card = payments
    got = rows(
        installments.payments(df, prev, card), "SK_ID_PREV", "DPD", "N_PAYMENTS", "FIRST_PAYMENT", "DPD_without_prev",
        "DPD_with_prev", "DPD_RATIO", "is_credit", "NAME_CONTRACT_TYPE",
    )
    assert got == brute(data)


def test_payment_features_keep_one_row_per_applicant(payments):
    data, df, prev, card = payments
    out = installments.features(df, prev, card)
    assert out.count() == len({r[1] for r in data}) and len(out.columns) == 203


PREV = """SK_ID_PREV long, AMT_ANNUITY double, AMT_GOODS_PRICE double, AMT_CREDIT double, CNT_PAYMENT double,
    NAME_YIELD_GROUP string, DAYS_FIRST_DUE double, DAYS_LAST_DUE_1ST_VERSION double, DAYS_DECISION int,
    NAME_TYPE_SUITE string, PRODUCT_COMBINATION string"""


def prev_row(loan, annuity, group="high"):
    return (loan, annuity, 50.0, 100.0, 12.0, group, 365243.0, -5.0, -100, "Family", f"P{loan}")


def test_pos_debt_and_representative_loan(spark):
    pos = spark.createDataFrame(
        [
            (1, 9, -3, 12.0, 9.0, "Active", 0, 0), (1, 9, -1, 10.0, 7.0, "Active", 5, 1),
            (2, 9, -2, 6.0, 3.0, "Active", 0, 0),
            (3, 9, -1, 6.0, 1.0, "Completed", 0, 0),
            (4, 9, -20, 6.0, 1.0, "Active", 0, 0),
            (5, 8, -20, 24.0, 20.0, "Demand", 0, 0), (5, 8, -30, None, 20.0, "Demand", 0, 0),
        ],
        """SK_ID_PREV long, SK_ID_CURR long, MONTHS_BALANCE int, CNT_INSTALMENT double, CNT_INSTALMENT_FUTURE double,
        NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int""",
    )
    prev = spark.createDataFrame([prev_row(1, 100.0), prev_row(2, 300.0, "low_normal"), prev_row(3, 900.0)], PREV)
    got = {r["SK_ID_CURR"]: r.asDict() for r in pos_cash.features(pos, prev).collect()}
    nine, eight = got[9], got[8]
    assert nine[pos_cash.DEBT] == 100.0 * 7 + 300.0 * 3
    assert nine["pAMT_ANNUITY"] == 300.0 and nine["pNAME_YIELD_GROUP"] == "low_normal" and nine["pCREDIT_TO_GOODS_RATIO"] == 0.5
    assert nine["pos_active_mean(DAYS_FIRST_DUE)"] is None and nine["pos_active_mean(NAME_YIELD_GROUP_high)"] == 0.5
    assert nine["pos_max(CNT_INSTALMENT_AHEAD)"] == 2.0 and nine["pos_sum(REGULAR_CONTRACT)"] == 5
    assert nine["pos12_sum(SK_DPD)"] == 5 and nine["pos12_count(MONTHS_BALANCE)"] == 4
    # no running loan: null, not 0; the planned number is the oldest row's, here missing
    assert eight[pos_cash.DEBT] is None and eight["pAMT_ANNUITY"] is None and eight["pos12_sum(SK_DPD)"] is None
    assert eight["pos_max(CNT_INSTALMENT_AHEAD)"] is None and eight["pos_sum(REGULAR_CONTRACT)"] == 0


def test_card_limits_and_balance(spark):
    columns = [f.strip().split() for f in credit_card_schema().split(",")]
    defaults = {n: None for n, _ in columns}

    def row(**values):
        return tuple({**defaults, "NAME_CONTRACT_STATUS": "Active", **values}[n] for n, _ in columns)

    card = spark.createDataFrame(
        [
            row(SK_ID_PREV=1, SK_ID_CURR=9, MONTHS_BALANCE=-3, AMT_CREDIT_LIMIT_ACTUAL=100.0, AMT_BALANCE=10.0),
            row(SK_ID_PREV=1, SK_ID_CURR=9, MONTHS_BALANCE=-2, AMT_CREDIT_LIMIT_ACTUAL=300.0, AMT_BALANCE=30.0),
            row(SK_ID_PREV=1, SK_ID_CURR=9, MONTHS_BALANCE=-1, AMT_CREDIT_LIMIT_ACTUAL=0.0, AMT_BALANCE=0.0),
            row(SK_ID_PREV=2, SK_ID_CURR=9, MONTHS_BALANCE=-1, AMT_CREDIT_LIMIT_ACTUAL=50.0, AMT_BALANCE=25.0, NAME_CONTRACT_STATUS="Completed"),
        ],
        credit_card_schema(),
    )
    got = credit_card.features(card, spark.createDataFrame([prev_row(1, 7.0)], PREV)).first().asDict()
    assert got["credit_prev_mean(CREDIT_LIMIT_LAST_BY_MIN)"] == (3.0 + 1.0) / 2
    assert got[credit_card.DEBT] == 0.0 and got["credit_active_sum(AMT_ANNUITY)"] == 7.0
    assert got["credit_max(AMT_BALANCE_PER_LMT)"] == 0.5 and got["CC_COUNT"] == 4
    assert got["credit_mean(AMT_CREDIT_LIMIT_ACTUAL)"] == 150.0


def credit_card_schema():
    from riskloom.sources.tables import SCHEMAS

    return " ".join(SCHEMAS["credit_card_balance"].split())


def test_number_of_columns_of_each_source(spark):
    """Literal counts, as the SQL of the checks takes its feature maps from the plans."""
    t = credit_tables(spark, "/root/testdata/sf0.001")
    got = {
        "bureau": bureau.features(t.bureau, t.bureau_balance),
        "previous": previous.features(t.previous_application),
        "installments": installments.features(t.installments_payments, t.previous_application, t.credit_card_balance),
        "pos_cash": pos_cash.features(t.POS_CASH_balance, t.previous_application),
        "credit_card": credit_card.features(t.credit_card_balance, t.previous_application),
    }
    assert {name: len(set(df.columns)) - 1 for name, df in got.items()} == {"bureau": 380, "previous": 185, "installments": 202, "pos_cash": 37, "credit_card": 35}
    counts = {m: [len(s.spec) + len(s.extra) for s in m.slices()] for m in (bureau, previous, installments)}
    assert counts == {bureau: [38] * 10, previous: [37] * 5, installments: [40, 40, 40, 40, 18, 22]}


def test_parts_are_written_one_after_another(spark, monkeypatch):
    """The shuffle files of a part go before the next one is built, and the joined matrix does not build any of them."""
    import time
    from types import SimpleNamespace

    from pyspark.sql import functions as F

    from riskloom.plans import matrix

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before, left = shuffled(), {}

    def part(name):
        def make():
            until = time.time() + 20
            while shuffled() - before and time.time() < until:
                time.sleep(0.1)
            left[name] = shuffled() - before
            return spark.range(100).withColumn("k", F.col("id") % 10).repartition(3, "k").groupBy(F.col("k").alias("SK_ID_CURR")).agg(F.sum("id").alias(name))

        return make

    app = spark.createDataFrame([(1,), (1,), (2,), (77,), (None,)], "SK_ID_CURR bigint")
    monkeypatch.setattr(matrix, "parts", lambda t, without: {"bureau": part("bureau"), "install": part("install"), "app": lambda: app})
    monkeypatch.setattr(matrix, "sources", lambda t: {})
    monkeypatch.setattr(matrix.previous, "loans", lambda df: df)
    monkeypatch.setattr(matrix.application, "cross_features", lambda out, prev, narrow: out)
    freed = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    out = matrix.full_matrix(SimpleNamespace(application_all=app, previous_application=app))
    assert list(left.items()) == [("install", set()), ("bureau", set())]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == freed
    assert out.columns == ["SK_ID_CURR", "bureau", "install"]
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = sorted(out.collect(), key=lambda r: r["SK_ID_CURR"] or 0)
    assert [tuple(r) for r in found] == [(None, None, None), (1, 460, 460), (1, 460, 460), (2, 470, 470), (77, None, None)]

"""Every registered query, with its SQL counterpart where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import feature_sql as fs
from checks.standin import credit_table, credit_tables, raw
from riskloom.functions import (
    blank_when, code_value, flag, gated, member_flag, named, one_hot, positive_part, quoted, ratio, row_mean, row_std,
)
from riskloom.jobs import LATE_VARIANTS
from riskloom.models import stacked
from riskloom.models.auc import auc
from riskloom.models.boosting import boost
from riskloom.models.folds import fold_of, labelled, unlabelled, with_balanced_folds, with_folds
from riskloom.models.prepare import Prepared
from riskloom.models.select import backward, chunks, forward
from riskloom.models.train import GRID, bag_seeds, combinations, cross_validate, grid_search, to_gbt
from riskloom.operators import checks, groups, joins, ordered, shape
from riskloom.operators.aggregate import Slice, aggregate, aggregate_slices, group_stat, read_spec
from riskloom.plans import application, bureau, credit_card, installments, matrix, pos_cash, previous
from riskloom.plans.feature_sets import SETS
from riskloom.session import remove, shared_folder, tune_tables
from riskloom.sources.store import Cache, fill_template, log_metrics, read_metrics, sample_rows, write_matrix, write_predictions
from riskloom.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | Callable[[], str] | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tune_tables(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(named(c), places) + F.lit(0.0) for c in columns})


def settled(df: DataFrame) -> DataFrame:
    """Round what depends on summation order and give every column a plain name."""
    return df.selectExpr(*[f"{fs.settle(quoted(c), c)} as {shape.plain_name(c)}" for c in df.columns])


# ---------------------------------------------------------------- feature tables


@query(fs.feature_sql("app"))
def application_features(spark, folder):
    return settled(application.application(credit_table(spark, folder, "application_all")))


@query(fs.feature_sql("bureau_features"))
def bureau_features(spark, folder):
    t = credit_tables(spark, folder)
    return settled(bureau.features(t.bureau, t.bureau_balance))


@query(fs.feature_sql("prev_features"))
def previous_features(spark, folder):
    return settled(previous.features(credit_table(spark, folder, "previous_application")))


@query(fs.feature_sql("ins_features"))
def installment_features(spark, folder):
    t = credit_tables(spark, folder)
    return settled(installments.features(t.installments_payments, t.previous_application, t.credit_card_balance))


@query(fs.feature_sql("pos_features"))
def pos_cash_features(spark, folder):
    t = credit_tables(spark, folder)
    return settled(pos_cash.features(t.POS_CASH_balance, t.previous_application))


@query(fs.feature_sql("card_features"))
def credit_card_features(spark, folder):
    t = credit_tables(spark, folder)
    return settled(credit_card.features(t.credit_card_balance, t.previous_application))


@query(fs.feature_sql("cross_features"))
def cross_features(spark, folder):
    t = credit_tables(spark, folder)
    base = application.application(t.application_all)
    debts = joins.attach(base, pos_cash.loan_features(t.POS_CASH_balance, t.previous_application), "SK_ID_CURR")
    card = credit_card.loan_features(credit_card.months(t.credit_card_balance), t.previous_application)
    debts = joins.attach(debts, card, "SK_ID_CURR")
    out = application.cross_features(debts, previous.loans(t.previous_application), narrow=base)
    return settled(out.selectExpr("SK_ID_CURR", *[quoted(c) for c in fs.columns("cross_features")]))


@query(fs.feature_sql("matrix"))
def feature_matrix(spark, folder):
    return settled(matrix.feature_matrix(credit_tables(spark, folder)))


@query(
    fs.with_ctes(
        """select SK_ID_BUREAU as sk_id_bureau, SK_ID_CURR as sk_id_curr, AMT_CREDIT_SUM as amt_credit_sum,
        ENDDATE_DIFF as enddate_diff, DAYS_CREDIT_PLAN as days_credit_plan, AMT_CREDIT_SUM_RATIO as amt_credit_sum_ratio,
        AMT_CREDIT_DEBT_PERC as amt_credit_debt_perc, AMT_CREDIT_DEBT_DIFF as amt_credit_debt_diff,
        AMT_CREDIT_ANNUITY_PERC as amt_credit_annuity_perc, BB_MONTHS_BALANCE_SIZE as bb_months_balance_size,
        BB_DPD_MAX as bb_dpd_max, round(BB_DPD_STD, 3) + 0 as bb_dpd_std from bureau_rows"""
    )
)
def bureau_rows(spark, folder):
    t = credit_tables(spark, folder)
    wanted = """SK_ID_BUREAU SK_ID_CURR AMT_CREDIT_SUM ENDDATE_DIFF DAYS_CREDIT_PLAN AMT_CREDIT_SUM_RATIO
    AMT_CREDIT_DEBT_PERC AMT_CREDIT_DEBT_DIFF AMT_CREDIT_ANNUITY_PERC BB_MONTHS_BALANCE_SIZE BB_DPD_MAX BB_DPD_STD""".split()
    out = shape.plain_names(bureau.credits_with_balances(t.bureau, t.bureau_balance).select(*wanted))
    return rounded(out, 3, "bb_dpd_std")


@query(
    fs.with_ctes(
        """select SK_ID_PREV as sk_id_prev, NUM_INSTALMENT_NUMBER as num_instalment_number,
        DAYS_ENTRY_PAYMENT as days_entry_payment, AMT_INSTALMENT as amt_instalment, AMT_PAYMENT as amt_payment,
        DPD as dpd, DBD as dbd, N_PAYMENTS as n_payments, FIRST_PAYMENT as first_payment,
        DPD_without_prev as dpd_without_prev, DPD_with_prev as dpd_with_prev, DPD_RATIO as dpd_ratio,
        PAYMENT_PERC as payment_perc, PAYMENT_DIFF as payment_diff, is_credit from ins_rows"""
    )
)
def payment_rows(spark, folder):
    t = credit_tables(spark, folder)
    rows = installments.payments(t.installments_payments, t.previous_application, t.credit_card_balance)
    wanted = """SK_ID_PREV NUM_INSTALMENT_NUMBER DAYS_ENTRY_PAYMENT AMT_INSTALMENT AMT_PAYMENT DPD DBD N_PAYMENTS
    FIRST_PAYMENT DPD_without_prev DPD_with_prev DPD_RATIO PAYMENT_PERC PAYMENT_DIFF is_credit""".split()
    return shape.plain_names(rows.select(*wanted))


# ---------------------------------------------------------------- row operators


def _late_lines(spark, folder) -> DataFrame:
    """Every line with its order's date and customer, and the days it shipped late."""
    lines = raw(spark, folder, "lineitem")
    orders = raw(spark, folder, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    rows = joins.enrich(lines, orders, "l_orderkey", ["o_custkey", "o_orderdate"])
    return rows.withColumn("days_late", positive_part(F.datediff("l_shipdate", "o_orderdate")))


@query(
    """select c_custkey, n_lines, total_late, mean_late, max_late, round(std_late, 3) + 0 as std_late from customer left join (
         select o_custkey as c_custkey, count(days_late) as n_lines, sum(days_late) as total_late, avg(days_late) as mean_late,
           max(days_late) as max_late, stddev_samp(days_late) as std_late from (
             select o_custkey, cast(greatest(coalesce(date_diff('day', o_orderdate, l_shipdate), 0), 0) as double) as days_late
             from lineitem left join orders on l_orderkey = o_orderkey) d where o_custkey is not null group by 1) a using (c_custkey)"""
)
def customer_lateness(spark, folder):
    late = _late_lines(spark, folder).withColumnRenamed("o_custkey", "c_custkey")
    stats = aggregate(late, "c_custkey", read_spec("days_late | count sum mean max std"))
    stats = stats.toDF("c_custkey", "n_lines", "total_late", "mean_late", "max_late", "std_late")
    return rounded(joins.attach(raw(spark, folder, "customer").select("c_custkey"), stats, "c_custkey"), 3, "std_late")


LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    f"""select {LINE}, l_extendedprice / l_quantity as unit_price, l_tax / nullif(l_discount, 0) as tax_to_discount,
    l_extendedprice / (1 + l_quantity) as padded_price, l_extendedprice - l_quantity as difference,
    l_extendedprice * l_discount as product from lineitem"""
)
def ratios(spark, folder):
    return raw(spark, folder, "lineitem").select(
        *LINE.split(", "),
        ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        ratio("l_tax", "l_discount").alias("tax_to_discount"),
        ratio("l_extendedprice", 1 + F.col("l_quantity")).alias("padded_price"),
        (F.col("l_extendedprice") - F.col("l_quantity")).alias("difference"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("product"),
    )


SCORES = "[nullif(l_discount, 0), nullif(l_tax, 0), l_quantity / 64]"


@query(
    f"""select {LINE}, round(list_avg(list_filter({SCORES}, lambda x: x is not null)), 9) + 0 as scores_mean,
    round(list_stddev_samp(list_filter({SCORES}, lambda x: x is not null)), 9) + 0 as scores_std from lineitem"""
)
def row_statistics(spark, folder):
    lines = raw(spark, folder, "lineitem").withColumns(
        {"s1": blank_when("l_discount", 0.0), "s2": blank_when("l_tax", 0.0), "s3": F.col("l_quantity") / 64}
    )
    scores = ["s1", "s2", "s3"]
    out = lines.select(*LINE.split(", "), row_mean(scores).alias("scores_mean"), row_std(scores).alias("scores_std"))
    return rounded(out, 9, "scores_mean", "scores_std")


@query(
    f"""select {LINE}, round(coalesce(nullif(l_tax, 0), avg(nullif(l_tax, 0)) over ()), 6) + 0 as tax,
    coalesce(nullif(l_discount, 0), -1) as discount from lineitem"""
)
def filled(spark, folder):
    lines = raw(spark, folder, "lineitem").withColumn("tax", blank_when("l_tax", 0.0))
    out = groups.fill_with_mean(lines, "tax")
    discount = F.coalesce(blank_when("l_discount", 0.0), F.lit(-1.0)).alias("discount")
    return rounded(out.select(*LINE.split(", "), "tax", discount), 6, "tax")


PRIORITY = {"1-URGENT": 135, "2-HIGH": 75, "3-MEDIUM": 45, "4-NOT SPECIFIED": 15}


@query(
    """select o_orderkey, case o_orderpriority when '1-URGENT' then 135 when '2-HIGH' then 75 when '3-MEDIUM' then 45
      when '4-NOT SPECIFIED' then 15 end as weight,
    case when nullif(o_orderstatus, 'P') in ('O', 'X') then 1 else 0 end as is_open,
    case when o_totalprice > 250000 then 1 else 0 end as is_large,
    case when nullif(o_orderstatus, 'P') = 'F' then 1 else 0 end as status_F,
    case when nullif(o_orderstatus, 'P') = 'O' then 1 else 0 end as status_O from orders"""
)
def codes_and_flags(spark, folder):
    orders = raw(spark, folder, "orders").withColumn("status", blank_when("o_orderstatus", "P"))
    hot = one_hot("status", ["F", "O"], "status")
    return orders.select(
        "o_orderkey",
        code_value("o_orderpriority", PRIORITY).alias("weight"),
        member_flag("status", ["O", "X"]).alias("is_open"),
        flag(F.col("o_totalprice") > 250000).alias("is_large"),
        *[c.alias(n) for n, c in hot.items()],
    )


@query(
    f"""select {LINE}, case when nullif(l_tax, 0) > 0.04 then 0 else l_quantity end as closed,
    case when nullif(l_tax, 0) > 0.04 then l_quantity else 0 end as opened from lineitem"""
)
def gated_columns(spark, folder):
    closed, opened = gated("l_quantity", blank_when("l_tax", 0.0) > 0.04)
    return raw(spark, folder, "lineitem").select(*LINE.split(", "), closed.alias("closed"), opened.alias("opened"))


# ---------------------------------------------------------------- joins


@query(
    """select o_orderkey, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem where l_returnflag = 'R')"""
)
def kept_keys(spark, folder):
    returned = raw(spark, folder, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.only_keys(raw(spark, folder, "orders"), returned, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    """select o_orderkey, o_custkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')"""
)
def excluded_keys(spark, folder):
    returned = raw(spark, folder, "lineitem").where("l_returnflag = 'R'").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.without_keys(raw(spark, folder, "orders"), returned, "o_orderkey").select("o_orderkey", "o_custkey")


@query(
    """select o_orderkey, case when o_orderkey in (select l_orderkey from lineitem where l_discount = 0) then 1 else 0 end
    as has_full_price from orders"""
)
def marked_keys(spark, folder):
    full = raw(spark, folder, "lineitem").where("l_discount = 0").withColumnRenamed("l_orderkey", "o_orderkey")
    return joins.mark_keys(raw(spark, folder, "orders").select("o_orderkey"), full, "o_orderkey", "has_full_price")


@query(
    fs.with_ctes(
        """select p.SK_ID_PREV as sk_id_prev, p.SK_ID_CURR as sk_id_curr, p.AMT_ANNUITY as amt_annuity,
    p.AMT_GOODS_PRICE as amt_goods_price, p.NAME_TYPE_SUITE as name_type_suite, p.AMT_CREDIT as amt_credit,
    p.NAME_CONTRACT_TYPE as name_contract_type, a.AMT_INCOME_TOTAL as amt_income_total, a.DAYS_BIRTH as days_birth,
    a.EXT_SOURCE_1 as ext_source_1 from previous_application p left join application_all a using (SK_ID_CURR)"""
    )
)
def replaced_columns(spark, folder):
    t = credit_tables(spark, folder)
    rows = stacked.pseudo_applications(t.application_all, t.previous_application)
    wanted = ["SK_ID_PREV", "SK_ID_CURR", *stacked.OWN, "AMT_INCOME_TOTAL", "DAYS_BIRTH", "EXT_SOURCE_1"]
    return shape.plain_names(rows.select(*wanted))


@query(
    """select c_custkey, c_acctbal, predicted from customer left join
    (select o_custkey as c_custkey, avg(case when o_orderstatus = 'F' then 1 else 0 end) as predicted from orders group by 1) p
    using (c_custkey)"""
)
def joined_predictions(spark, folder):
    orders = raw(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    predictions = groups.event_rate(orders, "c_custkey", F.col("o_orderstatus") == "F", "predicted")
    customers = raw(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return joins.add_columns(customers, predictions, "c_custkey")


@query(
    """select c_custkey, c_mktsegment, n_orders from customer left join
    (select o_custkey as c_custkey, count(o_orderkey) as n_orders from orders group by 1) o using (c_custkey)"""
)
def checked_columns(spark, folder):
    customers = raw(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    counts = aggregate(raw(spark, folder, "orders"), "o_custkey", [("o_orderkey", "count")]).toDF("c_custkey", "n_orders")
    side_file = joins.attach(customers.select("c_custkey"), counts, "c_custkey")
    return joins.add_columns(customers, checks.require_rows(side_file, customers.count()), "c_custkey")


# ---------------------------------------------------------------- aggregates


def _orders_with_amount(spark, folder) -> DataFrame:
    return raw(spark, folder, "orders").withColumns(
        {"amount": F.floor("o_totalprice").cast("double"), "days": F.datediff("o_orderdate", F.lit("2001-11-05").cast("date"))}
    )


AMOUNT_SPEC = "amount | count sum mean min max std\n days | mean var\n o_orderpriority | nunique"
AMOUNT_SQL = {
    "count_amount": "count(amount)", "sum_amount": "coalesce(sum(amount), 0)", "mean_amount": fs.settle("avg(amount)", "mean(amount)"),
    "min_amount": "min(amount)", "max_amount": "max(amount)", "std_amount": fs.settle("stddev_samp(amount)", "std(amount)"),
    "mean_days": fs.settle("avg(days)", "mean(days)"), "var_days": fs.settle("var_samp(days)", "var(days)"),
    "nunique_o_orderpriority": "count(distinct o_orderpriority)",
}


def _slices_sql(slices: dict[str, str]) -> str:
    out = """with o as (select *, cast(floor(o_totalprice) as double) as amount,
        date_diff('day', date '2001-11-05', cast(o_orderdate as date)) as days from orders)
        select * from (select distinct o_custkey from o) k"""
    for i, (prefix, where) in enumerate(slices.items()):
        cols = ", ".join(f"{e} as {prefix}{n}" for n, e in AMOUNT_SQL.items())
        out += f" left join (select o_custkey, {cols} from o where {where} group by 1) s{i} using (o_custkey)"
    return out


def _sliced_orders(spark, folder, slices: dict) -> DataFrame:
    spec = read_spec(AMOUNT_SPEC)
    orders = _orders_with_amount(spark, folder)
    return settled(aggregate_slices(orders, "o_custkey", [Slice(p, w, spec) for p, w in slices.items()]))


@query(_slices_sql({"all_": "true", "open_": "o_orderstatus = 'O'", "closed_": "o_orderstatus = 'F'"}))
def slices_by_status(spark, folder):
    status = F.col("o_orderstatus")
    return _sliced_orders(spark, folder, {"all_": None, "open_": status == "O", "closed_": status == "F"})


@query(_slices_sql({"all_": "true", "urgent_": "o_orderpriority = '1-URGENT'", "low_": "o_orderpriority = '5-LOW'"}))
def slices_by_type(spark, folder):
    kind = F.col("o_orderpriority")
    return _sliced_orders(spark, folder, {"all_": None, "urgent_": kind == "1-URGENT", "low_": kind == "5-LOW"})


@query(_slices_sql({"all_": "true", "d720_": "days >= -720", "d365_": "days >= -365", "d180_": "days >= -180"}))
def slices_by_recency(spark, folder):
    days = F.col("days")
    return _sliced_orders(
        spark, folder, {"all_": None, "d720_": days >= -720, "d365_": days >= -365, "d180_": days >= -180}
    )


@query(
    """select o_orderkey, count(o_orderkey) over (partition by o_custkey, nullif(o_orderstatus, 'P')) *
    case when nullif(o_orderstatus, 'P') is null then null else 1 end as n_alike from orders"""
)
def group_statistic(spark, folder):
    orders = raw(spark, folder, "orders").withColumn("status", blank_when("o_orderstatus", "P"))
    return group_stat(orders, ["o_custkey", "status"], "o_orderkey", "count", "n_alike").select("o_orderkey", "n_alike")


@query(
    """select o_custkey, avg(lines) as mean_lines, max(qty) as max_quantity from orders left join
    (select l_orderkey, count(*) as lines, sum(l_quantity) as qty from lineitem group by 1) l on l_orderkey = o_orderkey group by 1"""
)
def two_levels(spark, folder):
    lines = raw(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    per_order = aggregate(lines, "o_orderkey", [("l_quantity", "size"), ("l_quantity", "sum")]).toDF("o_orderkey", "lines", "qty")
    orders = joins.enrich(raw(spark, folder, "orders"), per_order, "o_orderkey")
    return aggregate(orders, "o_custkey", [("lines", "mean"), ("qty", "max")]).toDF("o_custkey", "mean_lines", "max_quantity")


@query(
    f"""select {LINE}, sum(case when l_returnflag = 'N' then coalesce(nullif(l_quantity, 1), 0) end)
    over (partition by l_orderkey, l_linenumber) as on_schedule, count(*) over (partition by l_orderkey, l_linenumber) as parts
    from lineitem"""
)
def sum_on_condition(spark, folder):
    amount = F.coalesce(blank_when("l_quantity", 1.0), F.lit(0.0))
    out = ordered.attach_group(
        raw(spark, folder, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        on_schedule=F.sum(F.when(F.col("l_returnflag") == "N", amount)),
        parts=F.count(F.lit(1)),
    )
    return out.select(*LINE.split(", "), "on_schedule", "parts")


@query(
    """select o_orderkey, o_totalprice / m as relative from orders left join (select o_orderpriority,
    quantile_cont(o_totalprice, 0.5) as m from orders where o_orderpriority <> '5-LOW' group by 1) x
    on x.o_orderpriority = nullif(orders.o_orderpriority, '5-LOW')""".replace("o_totalprice / m", "round(o_totalprice / m, 6) + 0")
)
def relative_to_median(spark, folder):
    orders = raw(spark, folder, "orders").withColumn("kind", blank_when("o_orderpriority", "5-LOW"))
    out = groups.relative_to_median(orders, "kind", {"o_totalprice": "relative"})
    return rounded(out.select("o_orderkey", "relative"), 6, "relative")


@query(
    """with o as (select *, cast(floor(o_totalprice) as double) as amount from orders),
    p as (select o_orderpriority, month(o_orderdate) as m, avg(amount) as amount_BY_PRIORITY from o group by 1, 2)
    select o_orderkey, amount_BY_PRIORITY, amount / amount_BY_PRIORITY as amount_BY_PRIORITY_RATIO,
    amount - amount_BY_PRIORITY as amount_BY_PRIORITY_DIFF from o left join p on p.o_orderpriority = o.o_orderpriority and m = month(o_orderdate) where o_orderstatus = 'O'"""
)
def pooled_mean(spark, folder):
    orders = _orders_with_amount(spark, folder)
    orders = orders.withColumn("o_shared", F.month("o_orderdate"))
    current, earlier = orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus <> 'O'")
    return groups.pooled_group_mean(
        current, earlier, "o_orderkey", {"PRIORITY": "o_orderpriority"}, "o_shared", ["amount"]
    )


@query(
    """select o_custkey, avg(amount) as MEAN_PREV_AMOUNT, avg(case when o_orderstatus = 'F' then amount end) as MEAN_PREV_CLOSED_AMOUNT
    from (select *, cast(floor(o_totalprice) as double) as amount from orders) o group by 1"""
)
def mean_by_type(spark, folder):
    orders = _orders_with_amount(spark, folder)
    return groups.mean_by_type(orders, "o_custkey", "o_orderstatus", {None: "", "F": "CLOSED_"}, {"amount": "AMOUNT"})


LABELLED = "(select d.doc_id, d.lang, d.source, d.n_chars, quality, toxic from documents d left join labels using (doc_id))"


def _labelled_documents(spark, folder) -> DataFrame:
    documents = raw(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return joins.enrich(documents, raw(spark, folder, "labels"), "doc_id")


@query(
    f"""select doc_id, source_quality from {LABELLED} d left join (select source, avg(quality) as source_quality from {LABELLED} x
    group by 1) m using (source)"""
)
def target_mean(spark, folder):
    out = groups.target_mean(_labelled_documents(spark, folder), "source", "quality", "source_quality")
    return out.select("doc_id", "source_quality")


@query(
    """select l_orderkey, rate, case when rate > 0.25 then 1 else 0 end as late from (select l_orderkey,
    avg(case when date_diff('day', o_orderdate, l_shipdate) > 14 then 1 else 0 end) as rate
    from lineitem left join orders on l_orderkey = o_orderkey group by 1) r"""
)
def event_label(spark, folder):
    late = _late_lines(spark, folder)
    event = F.col("days_late") > 14
    rate = groups.event_rate(late, "l_orderkey", event, "rate")
    return joins.attach(rate, groups.event_label(late, "l_orderkey", event, "late", cutoff=0.25), "l_orderkey")


@query("select event_type, count(*) as count from events group by 1")
def frequency(spark, folder):
    return groups.frequency(raw(spark, folder, "events"), "event_type")


@query(f"select round(corr(n_chars, quality), 6) + 0 as correlation from {LABELLED} d where quality is not null")
def correlation(spark, folder):
    return rounded(groups.correlation(_labelled_documents(spark, folder), "n_chars", "quality"), 6, "correlation")


@query("select distinct l_orderkey, l_suppkey from lineitem")
def distinct_pairs(spark, folder):
    return groups.distinct_pairs(raw(spark, folder, "lineitem"), ["l_orderkey", "l_suppkey"])


# ---------------------------------------------------------------- ordered operators


def _events(spark, folder) -> DataFrame:
    """Events without a value where it is below 5."""
    events = raw(spark, folder, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return events.withColumn("value", F.when(F.col("value") >= 5, F.col("value")))


EVENTS = "(select event_id, user_id, event_type, ts, case when value >= 5 then value end as value from events)"


@query(
    f"""select user_id, event_id, event_type, value from {EVENTS} e
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1"""
)
def latest_rows(spark, folder):
    return ordered.latest_row(_events(spark, folder), "user_id", "ts", ["event_id", "event_type", "value"]).drop("ts")


@query(
    f"""select user_id, event_id, event_type, value from {EVENTS} e
    qualify row_number() over (partition by user_id order by ts, event_id) = 1"""
)
def earliest_rows(spark, folder):
    return ordered.earliest_row(_events(spark, folder), "user_id", "ts", ["event_id", "event_type", "value"]).drop("ts")


@query(
    f"""select user_id, value from {EVENTS} e where value is not null
    qualify row_number() over (partition by user_id order by ts desc, value desc) = 1"""
)
def latest_present(spark, folder):
    return ordered.latest_present(_events(spark, folder), "user_id", "ts", "value").drop("ts")


@query(
    fs.with_ctes(
        f"""select SK_ID_PREV as sk_id_prev, SK_ID_CURR as sk_id_curr, CNT_INSTALMENT_AHEAD as cnt_instalment_ahead,
        CNT_INSTALMENT_AHEAD_RATIO as cnt_instalment_ahead_ratio from ({fs._ahead('POS_CASH_balance', 'true')}) a"""
    )
)
def planned_and_actual(spark, folder):
    pos = credit_table(spark, folder, "POS_CASH_balance")
    out = ordered.planned_and_actual(pos, "SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "CNT_INSTALMENT")
    return shape.plain_names(out.drop("PLANNED_CNT_INSTALMENT", "ACTUAL_CNT_INSTALMENT"))


@query(
    fs.with_ctes(
        """select SK_ID_PREV as sk_id_prev, last / least_ as last_by_min from
    (select SK_ID_PREV, min(AMT_CREDIT_LIMIT_ACTUAL) as least_ from card_months group by 1) m left join
    (select SK_ID_PREV, AMT_CREDIT_LIMIT_ACTUAL as last from card_months where AMT_CREDIT_LIMIT_ACTUAL is not null
     qualify row_number() over (partition by SK_ID_PREV order by MONTHS_BALANCE desc, AMT_CREDIT_LIMIT_ACTUAL desc) = 1) l
    using (SK_ID_PREV)"""
    )
)
def last_by_min(spark, folder):
    card = credit_card.months(credit_table(spark, folder, "credit_card_balance"))
    out = ordered.last_by_min(card, "SK_ID_PREV", "SK_ID_CURR", "MONTHS_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "last_by_min")
    return shape.plain_names(out.drop("SK_ID_CURR"))


@query(
    fs.with_ctes(
        """select SK_ID_PREV as sk_id_prev, DAYS_ENTRY_PAYMENT as days_entry_payment, n, DAYS_ENTRY_PAYMENT -
    lag(DAYS_ENTRY_PAYMENT) over (partition by SK_ID_PREV order by DAYS_ENTRY_PAYMENT) as gap from
    (select SK_ID_PREV, DAYS_ENTRY_PAYMENT, count(*) as n from installments_payments where DAYS_ENTRY_PAYMENT is not null group by 1, 2) d"""
    )
)
def payment_gaps(spark, folder):
    rows = credit_table(spark, folder, "installments_payments")
    return shape.plain_names(ordered.payment_gaps(rows, "SK_ID_CURR", "SK_ID_PREV", "DAYS_ENTRY_PAYMENT").drop("SK_ID_CURR"))


@query(
    fs.with_ctes(
        """select SK_ID_CURR as sk_id_curr, SK_ID_PREV as sk_id_prev, AMT_ANNUITY as amt_annuity,
    PRODUCT_COMBINATION as product_combination from previous_application qualify row_number() over (partition by SK_ID_CURR
    order by AMT_ANNUITY desc nulls last, SK_ID_PREV desc) = 1"""
    )
)
def representative_rows(spark, folder):
    prev = credit_table(spark, folder, "previous_application")
    return shape.plain_names(
        ordered.largest_row(prev, "SK_ID_CURR", "AMT_ANNUITY", "SK_ID_PREV", ["SK_ID_PREV", "AMT_ANNUITY", "PRODUCT_COMBINATION"])
    )


@query(fs.with_ctes(f"select distinct SK_ID_PREV as sk_id_prev from ({fs._active('POS_CASH_balance')}) a"))
def active_loans(spark, folder):
    pos = credit_table(spark, folder, "POS_CASH_balance")
    return shape.plain_names(ordered.active_loans(pos, "SK_ID_PREV", "MONTHS_BALANCE", "NAME_CONTRACT_STATUS"))


@query(
    fs.with_ctes(
        """select SK_ID_CURR as sk_id_curr, "SUM(AMT_DEBT_ACTIVE_ALL)" as debt, CURRENT_DEBT_TO_CREDIT_RATIO as to_credit,
    CURRENT_DEBT_TO_ANNUITY_RATIO as to_annuity from debts"""
    )
)
def active_debt(spark, folder):
    t = credit_tables(spark, folder)
    base = application.application(t.application_all).select("SK_ID_CURR", "AMT_CREDIT", "AMT_ANNUITY")
    pos = pos_cash.loan_features(t.POS_CASH_balance, t.previous_application).select("SK_ID_CURR", named(pos_cash.DEBT))
    card = credit_card.loan_features(credit_card.months(t.credit_card_balance), t.previous_application)
    both = joins.attach(joins.attach(base, pos, "SK_ID_CURR"), card.select("SK_ID_CURR", named(credit_card.DEBT)), "SK_ID_CURR")
    out = application.debt_ratios(both)
    return out.select(
        F.col("SK_ID_CURR").alias("sk_id_curr"),
        named("SUM(AMT_DEBT_ACTIVE_ALL)").alias("debt"),
        F.col("CURRENT_DEBT_TO_CREDIT_RATIO").alias("to_credit"),
        F.col("CURRENT_DEBT_TO_ANNUITY_RATIO").alias("to_annuity"),
    )


# ---------------------------------------------------------------- tops, unions, samples, sets


@query(
    """select user_id, total from (select user_id, sum(cast(floor(value) as bigint)) as total from events group by 1) t
    order by total desc, user_id limit 60""".replace("sum(", "cast(sum(").replace("bigint))", "bigint)) as bigint)")
)
def top_values(spark, folder):
    totals = raw(spark, folder, "events").groupBy("user_id").agg(F.sum(F.floor("value")).alias("total"))
    return shape.top_rows(totals, "total", "user_id", 60)


@query(
    """select c_custkey as party, c_nationkey as nation, c_mktsegment as segment, 'customer' as source from customer union all
    select s_suppkey, s_nationkey, null, 'supplier' from supplier"""
)
def stacked_sources(spark, folder):
    customers = raw(spark, folder, "customer").select(
        F.col("c_custkey").alias("party"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = raw(spark, folder, "supplier").select(F.col("s_suppkey").alias("party"), F.col("s_nationkey").alias("nation"))
    return shape.stack_sources(customer=customers, supplier=suppliers)


@query("select c_acctbal, c_custkey, c_mktsegment from customer order by c_custkey limit 100")
def first_rows(spark, folder):
    return sample_rows(shape.sorted_columns(raw(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")), "c_custkey")


@query(
    fs.with_ctes(
        f"""select SK_ID_CURR as sk_id_curr, {', '.join(f'{c} as {c.lower()}' for c in fs.columns('app')
        if c not in SETS['model2'].remove and c not in ('SOURCES_MEAN', 'SOURCES_STD'))} from app"""
    )
)
def feature_set(spark, folder):
    base = application.application(credit_table(spark, folder, "application_all"))
    return shape.plain_names(SETS["model2"].apply(base).drop("SOURCES_MEAN", "SOURCES_STD"))


ADDED = SETS["model3"].add


@query(
    fs.with_ctes(
        f"""select SK_ID_CURR as sk_id_curr, AMT_CREDIT as amt_credit, {', '.join(f'case when SK_ID_CURR % 5 > 0 then cast(SK_ID_CURR % {i + 2} as double) end as {shape.plain_name(c)}'
        for i, c in enumerate(ADDED))} from app where coalesce(CODE_GENDER <> 'XNA', true)"""
    )
)
def feature_set_with_candidates(spark, folder):
    """A set that adds columns by key; applicants without candidates have none."""
    base = application.application(credit_table(spark, folder, "application_all"))
    absent = [c for c in SETS["model3"].remove if c not in base.columns]
    base = base.withColumns({c: F.lit(0.0) for c in absent})
    rows = credit_table(spark, folder, "application_all").where("SK_ID_CURR % 5 > 0")
    candidates = rows.select("SK_ID_CURR", *[(F.col("SK_ID_CURR") % (i + 2)).cast("double").alias(c) for i, c in enumerate(ADDED)])
    return shape.plain_names(SETS["model3"].apply(base, candidates).select("SK_ID_CURR", "AMT_CREDIT", *[named(c) for c in ADDED]))


@query(
    fs.with_ctes(
        """select SK_ID_CURR as sk_id_curr, AMT_CREDIT as amt_credit,
        case when SK_ID_CURR % 3 > 0 then (SK_ID_CURR % 100) / 100 end as predicted from app"""
    )
)
def matrix_with_predictions(spark, folder):
    """The matrix with a stacked prediction joined in, which some applicants lack."""
    t = credit_tables(spark, folder)
    found = t.application_all.where("SK_ID_CURR % 3 > 0").selectExpr("SK_ID_CURR", "(SK_ID_CURR % 100) / 100D as `PREDICTED_X14Y-1`")
    whole = matrix.feature_matrix(t, found)
    return shape.plain_names(whole.select("SK_ID_CURR", "AMT_CREDIT", F.col("`PREDICTED_X14Y-1`").alias("predicted")))


# ---------------------------------------------------------------- folds and metrics


@query(
    """select doc_id, cast(cast('0x' || substr(md5(doc_id || ':47'), 1, 8) as bigint) % 5 as int) as fold,
    cast(cast('0x' || substr(md5(source || ':47'), 1, 8) as bigint) % 5 as int) as source_fold from documents"""
)
def folds(spark, folder):
    docs = with_folds(raw(spark, folder, "documents").select("doc_id", "source"), "doc_id")
    return docs.select("doc_id", "fold", fold_of("source").alias("source_fold"))


@query("select l_suppkey, count(*) as n, 1 as folds, true as balanced from lineitem group by 1")
def balanced_folds(spark, folder):
    """Suppliers, each in one fold; folds differ by no more than the lightest supplier placed by its size."""
    placed = with_balanced_folds(raw(spark, folder, "lineitem").select("l_suppkey"), "l_suppkey")
    gap = placed.groupBy("fold").agg(F.count("*").alias("n")).agg((F.max("n") - F.min("n")).alias("gap"))
    found = placed.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count_distinct("fold").cast("int").alias("folds"))
    return found.withColumn("balanced", gap.scalar() <= found.agg(F.min("n").alias("least")).scalar())


@query(
    """select source, count(*) as n, median(n_chars) as middle, count(distinct lang) as langs from documents where source is not null group by 1"""
)
def median_in_map(spark, folder):
    """A median and a distinct count in a feature map, beside other statistics of the same pass."""
    docs = raw(spark, folder, "documents")
    slices = [Slice("", None, [("n_chars", "size"), ("n_chars", "median"), ("lang", "nunique")])]
    return aggregate_slices(docs, "source", slices).toDF("source", "n", "middle", "langs")


@query(
    f"""with d as {LABELLED},
    langs as (select lang, row_number() over (order by count(*) desc, lang) - 1 as code from d group by 1),
    sources as (select source, row_number() over (order by count(*) desc, source) - 1 as code from d group by 1)
    select doc_id, quality, cast(l.code as double) as lang, cast(s.code as double) as source, cast(n_chars as double) as n_chars,
    coalesce(cast(toxic as double), -1.7e308) as toxic
    from d join langs l on l.lang = d.lang join sources s on s.source = d.source"""
)
def category_codes(spark, folder):
    return Prepared(_labelled_documents(spark, folder), "doc_id", "quality").columns()


@query(f"select doc_id, quality is not null as is_labelled from {LABELLED} d")
def label_split(spark, folder):
    docs = _labelled_documents(spark, folder)
    known = labelled(docs, "quality").select("doc_id", F.lit(True).alias("is_labelled"))
    return known.unionByName(unlabelled(docs, "quality").select("doc_id", F.lit(False).alias("is_labelled")))


AUC_SQL = """select {by} round((sum(case when quality = 1 then r end) - p * (p + 1) / 2) / (p * n), 9) + 0 as auc from (
    select fold, quality, avg(rn) over (partition by {part} n_chars) as r,
      sum(case when quality = 1 then 1e0 else 0 end) over ({whole}) as p, sum(case when quality = 0 then 1e0 else 0 end) over ({whole}) as n
    from (select *, row_number() over ({whole} order by n_chars) as rn from
      (select *, cast(cast('0x' || substr(md5(doc_id || ':47'), 1, 8) as bigint) % 5 as int) as fold from """ + LABELLED + """ d
       where quality is not null) f) k) s group by {by} p, n"""


@query(AUC_SQL.format(by="", part="", whole=""))
def auc_overall(spark, folder):
    return rounded(auc(_labelled_documents(spark, folder), "quality", "n_chars"), 9, "auc")


@query(AUC_SQL.format(by="fold,", part="fold,", whole="partition by fold"))
def auc_per_fold(spark, folder):
    docs = with_folds(_labelled_documents(spark, folder), "doc_id")
    return rounded(auc(docs, "quality", "n_chars", "fold"), 9, "auc")


@query(
    f"""with d as (select doc_id, quality, coalesce('=' || text, '') as text from {LABELLED} d join (select doc_id, text from documents) t using (doc_id)),
    codes as (select text, cast(row_number() over (order by count(*) desc, text) - 1 as double) as code from d group by 1)
    select doc_id, quality, code as text from d join codes using (text)"""
)
def many_category_codes(spark, folder):
    """Codes of a column with nearly as many values as rows: a dense rank, the most frequent text first."""
    docs = _labelled_documents(spark, folder).select("doc_id", "quality")
    texts = docs.join(raw(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return Prepared(texts, "doc_id", "quality").columns().select("doc_id", "quality", "text")


# ---------------------------------------------------------------- model jobs

# The values of a fit have no SQL: tests hold them against a plain loop over MLlib fits.  The queries return what a job
# must cover (keys, folds, columns, combinations) and whether every value is in its range.  Rounds and patience are arguments
# of the jobs.  STOPPED is for fits that patience ends, well below the most rounds; FEW is for jobs of many fits: 2 rounds
# each, with all folds, the 10 seeds and all combinations.  All of them use the six columns below.
STOPPED = {"n_estimators": 100, "max_depth": 2, "learning_rate": 0.3}
WAIT = {"patience": 3, "block": 4}
FEW = {"n_estimators": 2, "max_depth": 2, "learning_rate": 0.3}
MODEL_COLUMNS = ["AMT_CREDIT", "AMT_ANNUITY", "SOURCES_MEAN", "DAYS_BIRTH", "OCCUPATION_TYPE", "CREDIT_TO_INCOME_RATIO"]
IN_RANGE = "prediction between 0 and 1 as in_range"
FOLD_SQL = "cast(cast('0x' || substr(md5(cast({} as varchar) || ':47'), 1, 8) as bigint) % 5 as int)"


def _model_table(spark, folder) -> Prepared:
    """Applicants with a few features, the label and a fold."""
    base = application.application(credit_table(spark, folder, "application_all"))
    return Prepared(with_folds(base.select("SK_ID_CURR", "TARGET", *MODEL_COLUMNS), "SK_ID_CURR"), "SK_ID_CURR", "TARGET", keep=["fold"])


@query(fs.with_ctes(f"select SK_ID_CURR as sk_id_curr, TARGET as target, {FOLD_SQL.format('SK_ID_CURR')} as fold, true as in_range from app where TARGET is not null"))
def out_of_fold(spark, folder):
    return shape.plain_names(cross_validate(_model_table(spark, folder), STOPPED, **WAIT).oof.selectExpr("SK_ID_CURR", "TARGET", "fold", IN_RANGE))


@query(fs.with_ctes("select SK_ID_CURR as sk_id_curr, true as in_range from app where TARGET is null"))
def mean_prediction(spark, folder):
    return shape.plain_names(cross_validate(_model_table(spark, folder), STOPPED, **WAIT).unlabelled.selectExpr("SK_ID_CURR", IN_RANGE))


def _values(rows) -> str:
    return "select * from (values " + ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows) + ") t"


@query(_values([(c, f) for c in MODEL_COLUMNS for f in range(5)]) + "(feature, fold)")
def importances(spark, folder):
    return cross_validate(_model_table(spark, folder), STOPPED, **WAIT).importance.where("importance >= 0").select("feature", "fold")


@query(fs.with_ctes("select SK_ID_CURR as sk_id_curr, true as in_range from app where TARGET is null"))
def bagged_prediction(spark, folder):
    return shape.plain_names(bag_seeds(_model_table(spark, folder), FEW, range(10), early_stop=False).selectExpr("SK_ID_CURR", IN_RANGE))


@query(_values([(f, True, True, True) for f in range(5)]).replace("True", "true") + "(fold, stopped, waited, is_best)")
def stopped_fits(spark, folder):
    """Each fold's fit ends by patience, and its best round has the largest AUC before the end."""
    data, rows, at = _model_table(spark, folder), [], _shared(spark, "stopped")
    for i in range(5):
        found = boost(data.vectors(), "TARGET", F.col("fold") != i, to_gbt(STOPPED), data.bins, f"{at}/{i}", **WAIT)
        seen = found.aucs[: found.trees + WAIT["patience"]]
        rows.append((i, found.stopped, len(seen) == found.trees + WAIT["patience"], found.aucs[found.trees - 1] == max(seen)))
    remove(spark, at)
    return spark.createDataFrame(rows, "fold int, stopped boolean, waited boolean, is_best boolean")


@query(_values([(i, 1, True) for i in range(6)]).replace("True", "true") + "(round, times, same)")
def resumed_fit(spark, folder):
    """A fit of 4 rounds that goes on to 6: every tree is fitted once, and the AUCs are those of one run."""
    data, fitted, at = _model_table(spark, folder), [], _shared(spark, "resumed")

    def run(rounds: int, where: str, **options):
        settings = to_gbt({**STOPPED, "n_estimators": rounds})
        return boost(data.vectors(), "TARGET", F.col("fold") != 0, settings, data.bins, f"{at}/{where}", 100, **options)

    run(4, "broken", block=2, on_fit=fitted.append)
    again, whole = run(6, "broken", block=2, on_fit=fitted.append), run(6, "whole", block=6)
    remove(spark, at)
    rows = [(i, fitted.count(i), abs(again.aucs[i] - whole.aucs[i]) < 1e-12) for i in range(6)]
    return spark.createDataFrame(rows, "round int, times int, same boolean")


def _fitted(c: dict) -> dict:
    return {**c, "reg_alpha": GRID["reg_alpha"][0], "reg_lambda": GRID["reg_lambda"][0]}


@query(_values([(",".join(f"{n}={v}" for n, v in c.items()), ",".join(f"{n}={v}" for n, v in _fitted(c).items())) for c in combinations(GRID)]) + "(combination, fitted)")
def parameter_grid(spark, folder):
    return grid_search(_model_table(spark, folder), FEW, GRID, early_stop=False).where("auc between 0 and 1 or auc is null").select("combination", "fitted")


@query(_values([("baseline", "", 5)] + [("drop", ",".join(c), 5) for c in chunks(sorted(MODEL_COLUMNS), 5)]) + "(step, changed, folds)")
def backward_selection(spark, folder):
    return backward(_model_table(spark, folder), FEW, early_stop=False).selectExpr("step", "changed", "size(fold_auc) as folds")


@query(_values([("baseline", ""), *[("add", ",".join(c)) for c in chunks(MODEL_COLUMNS[2:], 2)]]) + "(step, changed)")
def forward_selection(spark, folder):
    data = _model_table(spark, folder)
    return forward(data, FEW, base=MODEL_COLUMNS[:2], candidates=MODEL_COLUMNS[2:]).select("step", "changed")


@query(
    fs.with_ctes(
        """select p.SK_ID_PREV as sk_id_prev, p.SK_ID_CURR as sk_id_curr, l.delay from previous_application p join
    (select SK_ID_PREV, case when avg(case when DPD > 14 then 1 else 0 end) > 0 then 1 else 0 end as delay from ins_late group by 1) l
    using (SK_ID_PREV)"""
    )
)
def late_loans(spark, folder):
    t = credit_tables(spark, folder)
    labels = stacked.late_instalments(t.installments_payments, days=14, first=-1)
    rows = stacked.training_rows(t.application_all, t.previous_application, labels)
    return shape.plain_names(rows.select("SK_ID_PREV", "SK_ID_CURR", "delay"))


def _outcomes_sql() -> str:
    late = "case when DPD > {days} then 1e0 else 0 end"
    columns = [
        f"""case when avg({'case when NUM_INSTALMENT_NUMBER <= ' + str(first) + ' then ' if first > 0 else ''}{late.format(days=days)}{' end' if first > 0 else ''}) is null
        then null when avg({'case when NUM_INSTALMENT_NUMBER <= ' + str(first) + ' then ' if first > 0 else ''}{late.format(days=days)}{' end' if first > 0 else ''}) > 0 then 1 else 0 end as x{days}"""
        for days, first in LATE_VARIANTS.values()
    ]
    return f"select SK_ID_PREV as sk_id_prev, {', '.join(columns)} from ins_late group by 1"


@query(fs.with_ctes(_outcomes_sql()))
def late_loan_outcomes(spark, folder):
    """All outcomes of a loan that features are learned from, in one pass over the payments."""
    late = stacked.late_variants(credit_table(spark, folder, "installments_payments"), LATE_VARIANTS)
    return late.select(F.col("SK_ID_PREV").alias("sk_id_prev"), *[F.col(f"`{name}`").alias(f"x{days}") for name, (days, _) in LATE_VARIANTS.items()])


@query(fs.with_ctes("select SK_ID_CURR as sk_id_curr, true as in_range from application_all"))
def stacked_prediction(spark, folder):
    t = credit_tables(spark, folder)
    labels = stacked.late_instalments(t.installments_payments, days=14, first=-1)
    found = stacked.stacked_feature(t.application_all, t.previous_application, labels, "prediction", FEW, seeds=range(10), early_stop=False)
    return shape.plain_names(found.selectExpr("SK_ID_CURR", IN_RANGE))


@query(fs.with_ctes("select SK_ID_CURR as sk_id_curr, true as in_range from application_all"))
def stacked_from_months(spark, folder):
    t = credit_tables(spark, folder)
    found = stacked.stacked_feature(
        t.application_all, t.previous_application, stacked.late_months(t.POS_CASH_balance), "prediction", FEW, seeds=range(10),
        hook=stacked.against_contract_means, unused=stacked.UNUSED_BY_MONTH, early_stop=False,
    )
    return shape.plain_names(found.selectExpr("SK_ID_CURR", IN_RANGE))


# ---------------------------------------------------------------- tables, sinks and checks


def _shared(spark, name: str) -> str:
    """A new folder for what a query writes and reads again."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(fs.with_ctes("select SK_ID_BUREAU as sk_id_bureau, MONTHS_BALANCE as months_balance, STATUS as status from bureau_balance"))
def read_back(spark, folder):
    """A table written as files and read by its declared columns."""
    at = _shared(spark, "tables")
    credit_table(spark, folder, "bureau_balance").write.parquet(f"{at}/bureau_balance.parquet")
    return shape.plain_names(read_table(spark, at, "bureau_balance"))


@query("select c_nationkey, count(*) as n, 'kept' as part from customer group by 1 union all select c_nationkey, count(*), 'new' from customer group by 1")
def cached_parts(spark, folder):
    """A part that is there is read, one that is asked for is built again."""
    at = _shared(spark, "cache")
    counts = raw(spark, folder, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    Cache(spark, at).table("part", lambda: counts.withColumn("part", F.lit("kept")))
    kept = Cache(spark, at, []).table("part", lambda: counts.withColumn("part", F.lit("lost")))
    new = Cache(spark, at, ["other"]).table("other", lambda: counts.withColumn("part", F.lit("new")))
    return kept.unionByName(new)


@query("select c_acctbal, c_custkey, c_mktsegment from customer")
def written_matrix(spark, folder):
    at = _shared(spark, "matrix")
    write_matrix(raw(spark, folder, "customer").select("c_mktsegment", "c_custkey", "c_acctbal"), at)
    return spark.read.parquet(at)


@query("select c_custkey, case when c_custkey % 3 = 0 then null else c_nationkey / 100 end as TARGET from customer")
def filled_template(spark, folder):
    """Predictions written with their key, put into a template by key; the template's other rows stay empty."""
    at = _shared(spark, "predictions")
    rows = raw(spark, folder, "customer").select("c_custkey", (F.col("c_nationkey") / 100).alias("p"))
    write_predictions(rows.select("c_custkey", F.lit(0.5).alias("p")), "c_custkey", "p", f"{at}/template")
    write_predictions(rows.where("c_custkey % 3 <> 0"), "c_custkey", "p", f"{at}/found", "parquet")
    return fill_template(spark, f"{at}/template", spark.read.parquet(f"{at}/found"), "c_custkey")


@query("select c_mktsegment as experiment, 'customers' as metric, cast(count(*) as double) as value, 'segment' as note from customer group by 1")
def metrics_log(spark, folder):
    """One experiment after another is appended to the log."""
    at = _shared(spark, "metrics")
    for r in raw(spark, folder, "customer").groupBy("c_mktsegment").count().collect():  # five segments
        log_metrics(spark, at, r["c_mktsegment"], {"customers": r["count"]}, "segment")
    return read_metrics(spark, at).drop("logged_at")


@query(
    """select 'customer' as name, count(*) as n, count(*) > 0 as filled, true as same_width from customer union all
    select 'none', 0, false, false"""
)
def checked_tables(spark, folder):
    """Row counts, empty tables and differing columns, as the checks see them."""
    rows = raw(spark, folder, "customer")

    def holds(check, *args, **named_args) -> bool:
        try:
            check(*args, **named_args)
        except ValueError:
            return False
        return True

    n = rows.count()
    found = [
        ("customer", n, holds(checks.require_some, customer=rows), holds(checks.require_same_columns, rows, rows.limit(0)) and holds(checks.require_rows, rows, n)),
        ("none", 0, holds(checks.require_some, none=rows.where("false")), holds(checks.require_same_columns, rows, rows.drop("c_name"))),
    ]
    return spark.createDataFrame(found, "name string, n long, filled boolean, same_width boolean")

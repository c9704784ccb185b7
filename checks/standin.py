"""The credit tables, derived from the test tables.

The credit data itself cannot be shipped, so each credit table is a SELECT over
the test tables that fills the same columns and types, over all rows.  The text
is plain SQL that Spark and DuckDB both run; only the day difference differs.
Amounts are whole units, so sums are exact on both sides.  Zeros, sentinels and
NULLs are spread over the columns on purpose.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.sources.tables import SCHEMAS, Tables

TODAY = "2001-11-05"


def _days(engine: str, stamp: str) -> str:
    """Whole days from ``TODAY`` to a timestamp (negative: in the past)."""
    if engine == "spark":
        return f"datediff(cast({stamp} as date), date '{TODAY}')"
    return f"date_diff('day', date '{TODAY}', cast({stamp} as date))"


def _whole(x: str) -> str:
    return f"cast(floor({x}) as bigint)"


def selects(engine: str) -> dict[str, str]:
    """The SELECT behind each credit table."""
    order_days, ship_days = _days(engine, "o_orderdate"), _days(engine, "l_shipdate")
    ship_month = f"cast(floor({ship_days} / 30e0) as int)"
    price, paid, balance = _whole("o_totalprice"), _whole("l_extendedprice"), _whole("abs(c_acctbal)")
    flags = ",\n".join(
        f"case when c_nationkey = {i} then 1 else 0 end as FLAG_DOCUMENT_{i}" for i in [2, *range(4, 22)]
    )
    asked = ",\n".join(
        f"cast(c_nationkey % {n} as double) as AMT_REQ_CREDIT_BUREAU_{period}"
        for n, period in [(2, "HOUR"), (3, "DAY"), (4, "WEEK"), (5, "MON"), (6, "QRT")]
    )
    contract = """case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'Cash loans'
                       when o_orderpriority = '3-MEDIUM' then 'Consumer loans'
                       else 'Revolving loans' end"""
    return {
        "application_all": f"""
            select c_custkey as SK_ID_CURR, cast(quality as double) as TARGET,
              case when c_nationkey = 0 then 'XNA' when c_nationkey < 13 then 'F' else 'M' end as CODE_GENDER,
              nullif(c_mktsegment, 'MACHINERY') as OCCUPATION_TYPE,
              concat('Org ', c_nationkey) as ORGANIZATION_TYPE,
              case when c_acctbal >= 3000 then 'Cash loans' else 'Revolving loans' end as NAME_CONTRACT_TYPE,
              case when c_nationkey = 3 then null when c_nationkey < 10 then 'Unaccompanied' else 'Family' end as NAME_TYPE_SUITE,
              case when c_nationkey % 2 = 0 then 'block of flats' else 'terraced house' end as HOUSETYPE_MODE,
              cast(floor(c_acctbal + 1000) * 50 as double) as AMT_CREDIT,
              case when c_acctbal >= 0 then cast(floor(c_acctbal / 10) as double) end as AMT_ANNUITY,
              cast(floor(c_acctbal + 1000) * 45 as double) as AMT_GOODS_PRICE,
              cast((c_nationkey + 1) * 10000 + floor(c_acctbal) as double) as AMT_INCOME_TOTAL,
              case when c_nationkey % 5 <> 1 then ({balance} % 97) / 97e0 end as EXT_SOURCE_1,
              case when c_nationkey % 4 <> 1 then ({balance} % 89) / 89e0 end as EXT_SOURCE_2,
              case when c_nationkey % 3 <> 1 then ({balance} % 83) / 83e0 end as EXT_SOURCE_3,
              case when c_mktsegment = 'AUTOMOBILE' then cast(c_nationkey as double) end as OWN_CAR_AGE,
              cast(-({balance} % 1000) as double) as DAYS_LAST_PHONE_CHANGE,
              cast(c_nationkey % 4 as int) as CNT_CHILDREN,
              cast(-(7000 + c_nationkey * 600 + {balance} % 600) as int) as DAYS_BIRTH,
              cast(case when c_nationkey in (5, 11) then 365243 else -({balance} % 4000) end as int) as DAYS_EMPLOYED,
              1 as FLAG_MOBIL, case when c_nationkey = 1 then 0 else 1 end as FLAG_CONT_MOBILE,
              {flags},
              cast(c_nationkey % 2 as int) as REG_REGION_NOT_LIVE_REGION,
              {asked}
            from customer left join labels on c_custkey = doc_id""",
        "bureau": f"""
            select o_orderkey as SK_ID_BUREAU, o_custkey as SK_ID_CURR,
              case o_orderstatus when 'F' then 'Closed' when 'O' then 'Active' else 'Sold' end as CREDIT_ACTIVE,
              case when o_orderpriority = '1-URGENT' then 'Consumer credit'
                   when o_orderpriority = '2-HIGH' then 'Credit card'
                   when o_orderpriority = '3-MEDIUM' then 'Car loan'
                   when o_orderpriority = '4-NOT SPECIFIED' then 'Mortgage'
                   when {price} % 10 = 0 then null else 'Microloan' end as CREDIT_TYPE,
              cast({order_days} as int) as DAYS_CREDIT,
              cast(case when {price} % 7 = 0 then {price} % 90 else 0 end as int) as CREDIT_DAY_OVERDUE,
              cast({price} % 3 as int) as CNT_CREDIT_PROLONG,
              cast({order_days} + {price} % 60 as int) as DAYS_CREDIT_UPDATE,
              cast(case when {price} % 11 <> 0 then {order_days} + {price} % 2000 end as double) as DAYS_CREDIT_ENDDATE,
              cast(case when o_orderstatus = 'F' then {order_days} + {price} % 1500 end as double) as DAYS_ENDDATE_FACT,
              cast(case when {price} % 4 = 0 then {price} % 5000 end as double) as AMT_CREDIT_MAX_OVERDUE,
              cast(case when {price} % 13 = 0 then 0 else {price} end as double) as AMT_CREDIT_SUM,
              cast(case when {price} % 5 = 0 then 0 when {price} % 5 = 1 then null else {price} % 100000 end as double) as AMT_CREDIT_SUM_DEBT,
              cast(case when {price} % 6 = 0 then {price} % 20000 end as double) as AMT_CREDIT_SUM_LIMIT,
              cast(case when {price} % 9 = 0 then {price} % 1000 else 0 end as double) as AMT_CREDIT_SUM_OVERDUE,
              cast(case when {price} % 3 = 0 then {price} % 30000 end as double) as AMT_ANNUITY
            from orders""",
        "bureau_balance": f"""
            select l_orderkey as SK_ID_BUREAU, {ship_month} as MONTHS_BALANCE,
              case l_linenumber when 1 then 'C' when 2 then 'X' when 3 then '0' when 4 then '1' when 5 then '2'
                   when 6 then '3' else (case when l_returnflag = 'R' then '5' when l_returnflag = 'A' then '4' end) end as STATUS
            from lineitem""",
        "previous_application": f"""
            select o_orderkey as SK_ID_PREV, o_custkey as SK_ID_CURR,
              case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then 'N' else 'Y' end as FLAG_LAST_APPL_PER_CONTRACT,
              {contract} as NAME_CONTRACT_TYPE,
              case o_orderstatus when 'F' then 'Approved' when 'O' then 'Refused' else 'Canceled' end as NAME_CONTRACT_STATUS,
              case {price} % 6 when 0 then 'high' when 1 then 'middle' when 2 then 'low_normal' when 3 then 'low_action'
                   when 4 then 'XNA' end as NAME_YIELD_GROUP,
              case {price} % 7 when 0 then 'XNA' when 1 then 'Mobile' when 2 then 'Consumer Electronics' when 3 then 'Computers'
                   when 4 then 'Furniture' end as NAME_GOODS_CATEGORY,
              case {price} % 4 when 0 then 'Unaccompanied' when 1 then 'Family' when 2 then 'Children' end as NAME_TYPE_SUITE,
              case (-{order_days}) % 7 when 0 then 'MONDAY' when 1 then 'SUNDAY' when 2 then 'SATURDAY' when 3 then 'FRIDAY'
                   when 4 then 'THURSDAY' when 5 then 'WEDNESDAY' else 'TUESDAY' end as WEEKDAY_APPR_PROCESS_START,
              concat('Product ', o_orderpriority) as PRODUCT_COMBINATION,
              cast(case when {price} % 17 = 0 then null else floor({price} / 24e0) end as double) as AMT_ANNUITY,
              cast(floor({price} * 0.75e0) as double) as AMT_APPLICATION,
              cast(case when {price} % 23 = 0 then 0 else {price} end as double) as AMT_CREDIT,
              cast(case when {price} % 2 = 0 then {price} % 9000 end as double) as AMT_DOWN_PAYMENT,
              cast(case when {price} % 19 <> 0 then floor({price} * 0.5e0) end as double) as AMT_GOODS_PRICE,
              case when {price} % 2 = 0 then ({price} % 50) / 64e0 end as RATE_DOWN_PAYMENT,
              cast(case when {price} % 10 <> 0 then ({price} % 8) * 6 end as double) as CNT_PAYMENT,
              cast({price} % 24 as int) as HOUR_APPR_PROCESS_START,
              cast({order_days} as int) as DAYS_DECISION,
              cast(case when {price} % 4 = 0 then {order_days} + 30 else 365243 end as double) as DAYS_FIRST_DRAWING,
              cast(case when {price} % 8 <> 0 then {order_days} + 30 else 365243 end as double) as DAYS_FIRST_DUE,
              cast(case when {price} % 6 <> 0 then {order_days} + 400 else 365243 end as double) as DAYS_LAST_DUE_1ST_VERSION,
              cast(case when {price} % 5 <> 0 then {order_days} + 500 else 365243 end as double) as DAYS_LAST_DUE,
              cast(case when {price} % 3 <> 0 then {order_days} + 600 else 365243 end as double) as DAYS_TERMINATION
            from orders""",
        "installments_payments": f"""
            select l_orderkey as SK_ID_PREV, o_custkey as SK_ID_CURR, l_linenumber as NUM_INSTALMENT_NUMBER,
              cast({_whole('l_quantity')} % 2 as double) as NUM_INSTALMENT_VERSION,
              cast({order_days} + 30 * l_linenumber as double) as DAYS_INSTALMENT,
              cast(case when l_tax < 0.075e0 then {ship_days} end as double) as DAYS_ENTRY_PAYMENT,
              cast(case when {paid} % 31 = 0 then 0 else {paid} end as double) as AMT_INSTALMENT,
              cast(case when l_discount > 0.095e0 then 0 when l_discount < 0.005e0 then null
                        when l_linestatus = 'F' then floor({paid} / 2e0) else {paid} end as double) as AMT_PAYMENT
            from lineitem join orders on l_orderkey = o_orderkey""",
        "POS_CASH_balance": f"""
            select l_orderkey as SK_ID_PREV, o_custkey as SK_ID_CURR, {ship_month} as MONTHS_BALANCE,
              case when l_tax < 0.075e0 then l_quantity end as CNT_INSTALMENT,
              case when l_discount > 0.005e0 then floor(l_quantity / 2e0) * 1e0 end as CNT_INSTALMENT_FUTURE,
              case when l_linenumber = 7 then 'Completed' when l_returnflag = 'A' then 'Active'
                   when l_returnflag = 'N' then 'Signed' else 'Demand' end as NAME_CONTRACT_STATUS,
              cast(case when {paid} % 5 = 0 then {paid} % 40 else 0 end as int) as SK_DPD,
              cast(case when {paid} % 15 = 0 then {paid} % 40 else 0 end as int) as SK_DPD_DEF
            from lineitem join orders on l_orderkey = o_orderkey
            where {contract} <> 'Revolving loans'""",
        "credit_card_balance": f"""
            select l_orderkey as SK_ID_PREV, o_custkey as SK_ID_CURR, {ship_month} as MONTHS_BALANCE,
              cast(case when {paid} % 6 = 0 then 0 else {paid} end as double) as AMT_BALANCE,
              cast(case when l_discount < 0.005e0 then 0 when {paid} % 12 = 1 then null else l_quantity * 1000 end as double) as AMT_CREDIT_LIMIT_ACTUAL,
              cast({paid} % 700 as double) as AMT_DRAWINGS_ATM_CURRENT,
              cast({paid} % 900 as double) as AMT_DRAWINGS_CURRENT,
              cast(case when {paid} % 4 = 0 then {paid} % 300 end as double) as AMT_DRAWINGS_OTHER_CURRENT,
              cast({paid} % 500 as double) as AMT_DRAWINGS_POS_CURRENT,
              cast({paid} % 1100 as double) as AMT_INST_MIN_REGULARITY,
              cast(case when {paid} % 3 <> 0 then {paid} % 2000 end as double) as AMT_PAYMENT_CURRENT,
              cast({paid} % 4 as double) as CNT_DRAWINGS_ATM_CURRENT,
              cast({paid} % 9 as double) as CNT_DRAWINGS_CURRENT,
              cast({paid} % 6 as double) as CNT_DRAWINGS_POS_CURRENT,
              cast(l_linenumber as double) as CNT_INSTALMENT_MATURE_CUM,
              case when l_linenumber = 7 then 'Completed' else 'Active' end as NAME_CONTRACT_STATUS,
              cast(case when {paid} % 5 = 0 then {paid} % 40 else 0 end as int) as SK_DPD,
              cast(case when {paid} % 15 = 0 then {paid} % 40 else 0 end as int) as SK_DPD_DEF
            from lineitem join orders on l_orderkey = o_orderkey
            where {contract} = 'Revolving loans'""",
    }


def raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: raw(spark, folder, n) for n in ("customer", "labels", "orders", "lineitem")}


def _derived(spark: SparkSession, sources: dict[str, DataFrame], name: str) -> DataFrame:
    """One credit table with exactly the declared column types."""
    text = selects("spark")[name]
    for n in sources:
        for word in (f"from {n}", f"join {n}"):
            text = text.replace(word, word.split()[0] + " {" + n + "}")
    used = {n: df for n, df in sources.items() if "{" + n + "}" in text}
    columns = ", ".join(
        f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in SCHEMAS[name].split(",")
    )
    return spark.sql(f"select {columns} from ({text})", **used)


def credit_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _derived(spark, _sources(spark, folder), name)


def credit_tables(spark: SparkSession, folder: str) -> Tables:
    sources = _sources(spark, folder)
    return Tables(**{name: _derived(spark, sources, name) for name in SCHEMAS})


def ctes(*names: str) -> str:
    """``name as (select ...)`` for DuckDB, for the given credit tables."""
    texts = selects("duckdb")
    return ",\n".join(f"{n} as materialized ({texts[n]})" for n in names)

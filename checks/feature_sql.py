"""The feature plans, written again as SQL over the credit tables."""

from __future__ import annotations

from checks.standin import selects
from riskloom.operators.aggregate import Spec, feature_name
from riskloom.operators.shape import plain_name
from riskloom.plans import application, bureau, credit_card, installments, pos_cash, previous
from riskloom.plans.dropped import STRICT, USELESS
from riskloom.sources.tables import SCHEMAS

SQL_FUNCTIONS = {
    "count": "count({c})",
    "size": "count(*)",
    "sum": "coalesce(sum({c}), 0)",
    "mean": "avg({c})",
    "min": "min({c})",
    "max": "max({c})",
    "std": "stddev_samp({c})",
    "var": "var_samp({c})",
    "nunique": "count(distinct {c})",
}


def q(name: str) -> str:
    return '"' + name + '"'


# Whole-number columns; DuckDB widens their sums beyond 64 bits.
WHOLE = "CREDIT_DAY_OVERDUE CNT_CREDIT_PROLONG BB_MONTHS_BALANCE_SIZE SK_DPD SK_DPD_DEF REGULAR_CONTRACT".split()


def aggs(spec: Spec, prefix: str = "") -> str:
    out = []
    for c, fn in spec:
        value = SQL_FUNCTIONS[fn].format(c=q(c))
        if fn == "sum" and c in WHOLE:
            value = f"cast({value} as bigint)"
        out.append(f"{value} as {q(feature_name(prefix, fn, c))}")
    return ", ".join(out)


def sliced(rows: str, slices: list[tuple[str, str, Spec]]) -> str:
    """One subquery per slice, joined to the keys that have any row."""
    out = f"select * from (select distinct SK_ID_CURR from {rows} where SK_ID_CURR is not null) k"
    for i, (prefix, where, spec) in enumerate(slices):
        out += f""" left join (select SK_ID_CURR, {aggs(spec, prefix)} from {rows}
                   where {where} group by SK_ID_CURR) s{i} using (SK_ID_CURR)"""
    return out


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(cast(({b}) as double), 0))"


BASIC = f"""
  * replace (nullif(DAYS_EMPLOYED, 365243) as DAYS_EMPLOYED),
  {div('AMT_CREDIT', 'AMT_ANNUITY')} as CREDIT_TO_ANNUITY_RATIO,
  {div('AMT_CREDIT', 'AMT_GOODS_PRICE')} as CREDIT_TO_GOODS_RATIO,
  {div('AMT_INCOME_TOTAL', '1 + CNT_CHILDREN')} as INC_PER_CHLD,
  {div('nullif(DAYS_EMPLOYED, 365243)', 'DAYS_BIRTH')} as EMPLOY_TO_BIRTH_RATIO,
  {div('AMT_ANNUITY', '1 + AMT_INCOME_TOTAL')} as ANNUITY_TO_INCOME_RATIO,
  EXT_SOURCE_1 * EXT_SOURCE_2 * EXT_SOURCE_3 as SOURCES_PROD,
  list_avg(list_filter([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3], lambda x: x is not null)) as SOURCES_MEAN,
  {div('OWN_CAR_AGE', 'DAYS_BIRTH')} as CAR_TO_BIRTH_RATIO,
  {div('OWN_CAR_AGE', 'nullif(DAYS_EMPLOYED, 365243)')} as CAR_TO_EMPLOY_RATIO,
  {div('DAYS_LAST_PHONE_CHANGE', 'DAYS_BIRTH')} as PHONE_TO_BIRTH_RATIO,
  {div('DAYS_LAST_PHONE_CHANGE', 'nullif(DAYS_EMPLOYED, 365243)')} as PHONE_TO_BIRTH_RATIO_EMPLOYER,
  {div('AMT_CREDIT', 'AMT_INCOME_TOTAL')} as CREDIT_TO_INCOME_RATIO"""

SOURCE_STD = """list_stddev_samp(list_filter([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3], lambda x: x is not null))"""


def _basic(rows: str) -> str:
    return f"""select * replace (coalesce(SOURCES_STD, avg(SOURCES_STD) over ()) as SOURCES_STD)
        from (select {BASIC}, {SOURCE_STD} as SOURCES_STD from {rows}) basic"""


def _app() -> dict[str, str]:
    medians = ", ".join(f"quantile_cont(cast({c} as double), 0.5) as m_{c}" for c in application.BY_OCCUPATION)
    relative = ", ".join(
        f"{div('b.' + c, 'm.m_' + c)} as {name}" for c, name in application.BY_OCCUPATION.items()
    )
    return {
        "known": "select * from application_all where coalesce(CODE_GENDER <> 'XNA', true)",
        "app": f"""select b.*, {relative} from ({_basic('known')}) b left join
            (select OCCUPATION_TYPE, {medians} from known where OCCUPATION_TYPE is not null group by 1) m
            using (OCCUPATION_TYPE)""",
    }


def _bureau() -> dict[str, str]:
    days = " ".join(f"when '{k}' then {v}" for k, v in bureau.STATUS_DAYS.items())
    balance = ", ".join(
        f"{SQL_FUNCTIONS[fn].format(c=c)} as BB_{c}_{fn.upper()}" for c, fn in bureau.BALANCE_STATS
    )
    where = {
        "b_": "true",
        "b_active_": "CREDIT_ACTIVE = 'Active'",
        "b_closed_": "CREDIT_ACTIVE = 'Closed'",
        "b_consumer_": "CREDIT_TYPE = 'Consumer credit'",
        "b_credit_": "CREDIT_TYPE = 'Credit card'",
        "b_car_": "CREDIT_TYPE = 'Car loan'",
        "b_mortage_": "CREDIT_TYPE = 'Mortgage'",
        "b_micro_": "CREDIT_TYPE = 'Microloan'",
        "b_720_": "DAYS_CREDIT >= -720",
        "b_365_": "DAYS_CREDIT >= -365",
    }
    return {
        "bureau_clean": """select * replace (nullif(AMT_CREDIT_SUM, 0) as AMT_CREDIT_SUM,
            nullif(AMT_CREDIT_SUM_DEBT, 0) as AMT_CREDIT_SUM_DEBT) from bureau""",
        "bureau_credits": f"""select c.*, m.MEAN_AMT_CREDIT_BY_CREDIT_TYPE,
              DAYS_ENDDATE_FACT - DAYS_CREDIT_ENDDATE as ENDDATE_DIFF,
              DAYS_CREDIT_ENDDATE - DAYS_CREDIT as DAYS_CREDIT_PLAN,
              {div('AMT_CREDIT_SUM', 'm.MEAN_AMT_CREDIT_BY_CREDIT_TYPE')} as AMT_CREDIT_SUM_RATIO,
              {div('AMT_CREDIT_SUM_DEBT', 'AMT_CREDIT_SUM')} as AMT_CREDIT_DEBT_PERC,
              AMT_CREDIT_SUM_DEBT - AMT_CREDIT_SUM as AMT_CREDIT_DEBT_DIFF,
              {div('AMT_ANNUITY', 'AMT_CREDIT_SUM')} as AMT_CREDIT_ANNUITY_PERC
            from bureau_clean c left join (select CREDIT_TYPE, quantile_cont(AMT_CREDIT_SUM, 0.5) as MEAN_AMT_CREDIT_BY_CREDIT_TYPE
                 from bureau_clean where CREDIT_TYPE is not null group by 1) m using (CREDIT_TYPE)""",
        "bureau_balances": f"""select SK_ID_BUREAU, {balance} from
            (select *, case STATUS {days} end as DPD from bureau_balance) d group by 1""",
        "bureau_rows": "select * from bureau_credits left join bureau_balances using (SK_ID_BUREAU)",
        "bureau_features": sliced("bureau_rows", [(p, w, bureau.STATS) for p, w in where.items()]),
    }


def _prev() -> dict[str, str]:
    dates = ", ".join(f"nullif({c}, 365243) as {c}" for c in previous.DATE_COLUMNS)
    hot = [("NAME_YIELD_GROUP", v) for v in previous.YIELD_GROUPS]
    hot += [("NAME_GOODS_CATEGORY", v) for v in previous.GOODS_CATEGORIES]
    ones = ", ".join(f"case when {c} = '{v}' then 1 else 0 end as {q(c + '_' + v)}" for c, v in hot)
    where = {
        "p_": "true",
        "p_approved": "NAME_CONTRACT_STATUS = 'Approved'",
        "p_refused": "NAME_CONTRACT_STATUS = 'Refused'",
        "p_cash": "NAME_CONTRACT_TYPE = 'Cash loans'",
        "p_cunsumer": "NAME_CONTRACT_TYPE = 'Consumer loans'",
    }
    return {
        "prev_rows": f"""select * replace ({dates}),
            {div('AMT_CREDIT', 'AMT_ANNUITY')} as CREDIT_TO_ANNUITY_RATIO,
            {div('AMT_GOODS_PRICE', 'AMT_CREDIT')} as CREDIT_TO_GOODS_RATIO,
            {div('AMT_APPLICATION', 'AMT_CREDIT')} as APP_CREDIT_PERC,
            {ones},
            case when WEEKDAY_APPR_PROCESS_START in ('SUNDAY', 'SATURDAY') then 1 else 0 end as IS_WEEKEND_APPR,
            case when NAME_TYPE_SUITE = 'Unaccompanied' then 1 else 0 end as NAME_TYPE_SUITE_Unaccompanied
            from previous_application where FLAG_LAST_APPL_PER_CONTRACT = 'Y'""",
        "prev_features": sliced("prev_rows", [(p, w, previous.STATS) for p, w in where.items()]),
    }


def _install() -> dict[str, str]:
    group = "partition by SK_ID_PREV, NUM_INSTALMENT_NUMBER, NUM_INSTALMENT_VERSION"
    s = installments
    return {
        "ins_late": """select *, greatest(coalesce(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0), 0) as DPD,
            greatest(coalesce(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0), 0) as DBD from installments_payments""",
        "ins_grouped": f"""select *, count(AMT_PAYMENT) over ({group}) as N_PAYMENTS,
            min(DAYS_ENTRY_PAYMENT) over ({group}) as FIRST_PAYMENT,
            sum(case when DPD = 0 then coalesce(AMT_PAYMENT, 0) end) over ({group}) as AMT_PAYMENT_SUM_ON_SCHEDULE
            from ins_late""",
        "ins_rows": f"""select i.*, p.NAME_CONTRACT_TYPE,
            case when i.SK_ID_PREV in (select SK_ID_PREV from credit_card_balance) then 1 else 0 end as is_credit,
            {div('AMT_PAYMENT', 'AMT_INSTALMENT')} as PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT as PAYMENT_DIFF,
            case when FIRST_PAYMENT < DAYS_INSTALMENT then 0 else DPD end as DPD_without_prev,
            case when FIRST_PAYMENT < DAYS_INSTALMENT then DPD else 0 end as DPD_with_prev,
            coalesce({div('(case when DPD > 0 then 1 else 0 end) * AMT_PAYMENT_SUM_ON_SCHEDULE', 'AMT_PAYMENT')}, 0) as DPD_RATIO
            from ins_grouped i left join (select SK_ID_PREV, NAME_CONTRACT_TYPE from previous_application) p using (SK_ID_PREV)""",
        "ins_gaps": """select *, DAYS_ENTRY_PAYMENT - lag(DAYS_ENTRY_PAYMENT) over
              (partition by SK_ID_PREV order by DAYS_ENTRY_PAYMENT) as gap
            from installments_payments where DAYS_ENTRY_PAYMENT is not null""",
        "ins_recent": """select SK_ID_CURR, avg(gap) as "ins365_mean(DAYS_ENTRY_PAYMENT_INTERVAL)",
            min(gap) as "ins365_min(DAYS_ENTRY_PAYMENT_INTERVAL)" from ins_gaps where DAYS_ENTRY_PAYMENT >= -365 group by 1""",
        "ins_sliced": sliced(
            "ins_rows",
            [
                ("ins_", "true", s.STATS),
                ("ins_consumer_", "NAME_CONTRACT_TYPE = 'Consumer loans'", s.STATS),
                ("ins_cash_", "NAME_CONTRACT_TYPE = 'Cash loans'", s.STATS),
                ("ins_credit_", "is_credit = 1", s.STATS),
                ("ins365_", "DAYS_ENTRY_PAYMENT >= -365", s.STATS_365),
                ("ins180_", "DAYS_ENTRY_PAYMENT >= -180", s.STATS_180),
            ],
        ),
        "ins_features": "select * from ins_sliced left join ins_recent using (SK_ID_CURR)",
    }


AHEAD_RECENT = [(pos_cash.AHEAD_NAMES[c], fn) for c, fn in pos_cash.AHEAD_RECENT]


def _ahead(rows: str, where: str) -> str:
    return f"""select SK_ID_PREV, max(SK_ID_CURR) as SK_ID_CURR,
        max(first - last) as CNT_INSTALMENT_AHEAD, max({div('last', 'first')}) as CNT_INSTALMENT_AHEAD_RATIO from (
          select f.SK_ID_PREV, f.SK_ID_CURR, f.CNT_INSTALMENT as first, l.CNT_INSTALMENT as last from
          (select * from {rows} where {where} qualify row_number() over (partition by SK_ID_PREV
             order by MONTHS_BALANCE asc, CNT_INSTALMENT asc nulls first) = 1) f join
          (select * from {rows} where {where} qualify row_number() over (partition by SK_ID_PREV
             order by MONTHS_BALANCE desc, CNT_INSTALMENT desc nulls last) = 1) l using (SK_ID_PREV)) e
        group by SK_ID_PREV"""


def _active(rows: str) -> str:
    return f"""select * from {rows} where
        SK_ID_PREV not in (select SK_ID_PREV from {rows} where NAME_CONTRACT_STATUS = 'Completed')
        and SK_ID_PREV in (select SK_ID_PREV from {rows} group by 1 having max(MONTHS_BALANCE) >= -12)"""


YIELD = ", ".join(
    f"case when NAME_YIELD_GROUP = '{g}' then 1 else 0 end as NAME_YIELD_GROUP_{g}"
    for g in ["high", "low_normal", "low_action"]
)


def _pos() -> dict[str, str]:
    p = pos_cash
    regular = ", ".join(f"'{v}'" for v in p.REGULAR)
    best = ", ".join(f"{q(c)} as {q('p' + c)}" for c in p.REPRESENTATIVE)
    return {
        "pos_months": f"""select *, case when NAME_CONTRACT_STATUS in ({regular}) then 1 else 0 end as REGULAR_CONTRACT
            from POS_CASH_balance""",
        "pos_sliced": sliced("pos_months", [("pos_", "true", p.STATS), ("pos12_", "MONTHS_BALANCE >= -12", p.STATS)]),
        "pos_ahead": f"""select * from
            (select SK_ID_CURR, {aggs(p.AHEAD, 'pos_')} from ({_ahead('pos_months', 'true')}) a group by 1) x left join
            (select SK_ID_CURR, {aggs(AHEAD_RECENT, 'pos12_')} from ({_ahead('pos_months', 'MONTHS_BALANCE >= -12')}) a group by 1) y
            using (SK_ID_CURR)""",
        "pos_running": f"""select l.*, pr.* exclude (SK_ID_PREV, SK_ID_CURR, DAYS_FIRST_DUE, DAYS_LAST_DUE_1ST_VERSION),
            nullif(DAYS_FIRST_DUE, 365243) as DAYS_FIRST_DUE,
            nullif(DAYS_LAST_DUE_1ST_VERSION, 365243) as DAYS_LAST_DUE_1ST_VERSION,
            {YIELD}, AMT_ANNUITY * CNT_INSTALMENT_FUTURE as AMT_CREDIT_SUM_DEBT_POS,
            {div('AMT_GOODS_PRICE', 'AMT_CREDIT')} as CREDIT_TO_GOODS_RATIO
            from (select SK_ID_PREV, min(SK_ID_CURR) as SK_ID_CURR, min(CNT_INSTALMENT_FUTURE) as CNT_INSTALMENT_FUTURE
                  from ({_active('POS_CASH_balance')}) a group by 1) l left join previous_application pr using (SK_ID_PREV)""",
        "pos_active": f"""select * from (select SK_ID_CURR, {aggs(p.ACTIVE_STATS, 'pos_active_')
              .replace('pos_active_sum(AMT_CREDIT_SUM_DEBT_POS)', p.DEBT)} from pos_running group by 1) t left join
            (select SK_ID_CURR, {best} from pos_running qualify row_number() over (partition by SK_ID_CURR
               order by AMT_ANNUITY desc nulls last, SK_ID_PREV desc) = 1) b using (SK_ID_CURR)""",
        "pos_features": "select * from pos_sliced left join pos_ahead using (SK_ID_CURR) left join pos_active using (SK_ID_CURR)",
    }


def _card() -> dict[str, str]:
    c = credit_card
    return {
        "card_months": f"""select * replace (nullif(AMT_CREDIT_LIMIT_ACTUAL, 0) as AMT_CREDIT_LIMIT_ACTUAL),
            {div('nullif(AMT_BALANCE, 0)', 'nullif(AMT_CREDIT_LIMIT_ACTUAL, 0)')} as AMT_BALANCE_PER_LMT
            from credit_card_balance""",
        "card_sliced": sliced(
            "card_months",
            [
                ("credit_", "true", c.STATS + [("MONTHS_BALANCE", "size")]),
                ("credit12_", "MONTHS_BALANCE >= -12", c.STATS_12),
                ("credit6_", "MONTHS_BALANCE >= -6", c.STATS_6),
            ],
        ).replace("credit_size(MONTHS_BALANCE)", "CC_COUNT"),
        "card_limits": f"""select SK_ID_CURR, avg({div('last', 'least_')}) as "credit_prev_mean(CREDIT_LIMIT_LAST_BY_MIN)" from
            (select SK_ID_PREV, SK_ID_CURR, min(AMT_CREDIT_LIMIT_ACTUAL) as least_ from card_months group by 1, 2) m left join
            (select SK_ID_PREV, AMT_CREDIT_LIMIT_ACTUAL as last from card_months where AMT_CREDIT_LIMIT_ACTUAL is not null
             qualify row_number() over (partition by SK_ID_PREV order by MONTHS_BALANCE desc, AMT_CREDIT_LIMIT_ACTUAL desc) = 1) l
            using (SK_ID_PREV) group by 1""",
        "card_running": f"""select l.*, pr.* exclude (SK_ID_PREV, SK_ID_CURR, DAYS_FIRST_DUE),
            nullif(DAYS_FIRST_DUE, 365243) as DAYS_FIRST_DUE, {YIELD} from
            (select SK_ID_PREV, SK_ID_CURR, AMT_BALANCE as AMT_CREDIT_SUM_DEBT_CREDIT from ({_active('card_months')}) a
             qualify row_number() over (partition by SK_ID_PREV order by MONTHS_BALANCE desc, AMT_BALANCE desc nulls last, SK_ID_CURR desc) = 1) l
            left join previous_application pr using (SK_ID_PREV)""",
        "card_active": f"""select SK_ID_CURR, {aggs(c.ACTIVE_STATS, 'credit_active_')
              .replace('credit_active_sum(AMT_CREDIT_SUM_DEBT_CREDIT)', c.DEBT)} from card_running group by 1""",
        "card_features": "select * from card_sliced left join card_limits using (SK_ID_CURR) left join card_active using (SK_ID_CURR)",
    }


def _pooled(by: str, postfix: str) -> str:
    targets = application.POOLED_TARGETS
    means = ", ".join(f"avg({t}) as {t}_BY_{postfix}" for t in targets)
    out = ", ".join(
        f"m.{t}_BY_{postfix}, {div('a.' + t, f'm.{t}_BY_{postfix}')} as {t}_BY_{postfix}_RATIO, "
        f"a.{t} - m.{t}_BY_{postfix} as {t}_BY_{postfix}_DIFF"
        for t in targets
    )
    columns = f"{by}, NAME_CONTRACT_TYPE, {', '.join(targets)}"
    return f"""select a.SK_ID_CURR, {out} from app a left join
        (select {by}, NAME_CONTRACT_TYPE, {means} from
          (select {columns} from app union all
           select {columns} from prev_rows left join (select SK_ID_CURR, {by} from app) o using (SK_ID_CURR)) u
         where {by} is not null and NAME_CONTRACT_TYPE is not null group by 1, 2) m using ({by}, NAME_CONTRACT_TYPE)"""


def _cross() -> dict[str, str]:
    means, ratios = [], []
    for value, infix in {None: "", "Cash loans": "CASH_", "Revolving loans": "REVOLVING_"}.items():
        for short in ["ANNUITY", "CREDIT"]:
            kept = f"AMT_{short}" if value is None else f"case when NAME_CONTRACT_TYPE = '{value}' then AMT_{short} end"
            means.append(f"avg({kept}) as MEAN_PREV_{infix}{short}")
    for kind in ["CASH", "REVOLVING"]:
        for short in ["CREDIT", "ANNUITY"]:
            ratios.append(f"{div(f'AMT_{short}', f'MEAN_PREV_{kind}_{short}')} as PREV_TO_CURR_{short}_RATIO_{kind}")
    pos, card = q(pos_cash.DEBT), q(credit_card.DEBT)
    debt = f"coalesce({pos}, 0) + coalesce({card}, 0)"
    return {
        "prev_means": f"""select app.SK_ID_CURR, m.* exclude (SK_ID_CURR), {', '.join(ratios)} from app left join
            (select SK_ID_CURR, {', '.join(means)} from prev_rows where AMT_ANNUITY > 0 group by 1) m using (SK_ID_CURR)""",
        "debts": f"""select SK_ID_CURR, {debt} as "SUM(AMT_DEBT_ACTIVE_ALL)",
            {div(debt, 'AMT_CREDIT')} as CURRENT_DEBT_TO_CREDIT_RATIO, {div(debt, 'AMT_ANNUITY')} as CURRENT_DEBT_TO_ANNUITY_RATIO
            from app left join (select SK_ID_CURR, {pos} from pos_active) p using (SK_ID_CURR)
            left join (select SK_ID_CURR, {card} from card_active) c using (SK_ID_CURR)""",
        "pooled_org": _pooled("ORGANIZATION_TYPE", "ORG_CONTRACT"),
        "pooled_occ": _pooled("OCCUPATION_TYPE", "OCC_CONTRACT"),
        "cross_features": """select * from prev_means left join debts using (SK_ID_CURR)
            left join pooled_org using (SK_ID_CURR) left join pooled_occ using (SK_ID_CURR)""",
        "matrix": """select * from app left join card_features using (SK_ID_CURR) left join bureau_features using (SK_ID_CURR)
            left join prev_features using (SK_ID_CURR) left join ins_features using (SK_ID_CURR)
            left join pos_features using (SK_ID_CURR) left join cross_features using (SK_ID_CURR)""",
    }


CTES: dict[str, str] = {
    **selects("duckdb"), **_app(), **_bureau(), **_prev(), **_install(), **_pos(), **_card(), **_cross()
}


def needed(name: str, text: str | None = None) -> list[str]:
    """The CTEs a query mentions, directly or not, in order of definition."""
    found: set[str] = set()
    todo = [CTES[name] if text is None else text]
    while todo:
        words = set("".join(ch if ch.isalnum() or ch == "_" else " " for ch in todo.pop()).split())
        for other in CTES:
            if other in words and other not in found:
                found.add(other)
                todo.append(CTES[other])
    return [n for n in CTES if n in found]


def with_ctes(text: str) -> str:
    names = needed("", text)
    if not names:
        return text
    return "with " + ",\n".join(f"{n} as materialized ({CTES[n]})" for n in names) + "\n" + text


def _names(spec: Spec, *prefixes: str) -> list[str]:
    return [feature_name(p, fn, c) for p in prefixes for c, fn in spec]


def columns(name: str) -> list[str]:
    """The columns of a feature table besides its key."""
    c, p, i = credit_card, pos_cash, installments
    if name == "bureau_features":
        kinds = ["active_", "closed_", "consumer_", "credit_", "car_", "mortage_", "micro_", "720_", "365_"]
        return _names(bureau.STATS, "b_", *["b_" + k for k in kinds])
    if name == "prev_features":
        return _names(previous.STATS, "p_", "p_approved", "p_refused", "p_cash", "p_cunsumer")
    if name == "ins_features":
        out = _names(i.STATS, "ins_", "ins_consumer_", "ins_cash_", "ins_credit_")
        out += _names(i.STATS_365, "ins365_") + _names(i.STATS_180, "ins180_")
        return out + [f"ins365_{fn}(DAYS_ENTRY_PAYMENT_INTERVAL)" for fn in ["mean", "min"]]
    if name == "pos_features":
        out = _names(p.STATS, "pos_", "pos12_") + _names(p.AHEAD, "pos_") + _names(AHEAD_RECENT, "pos12_")
        out += _names(p.ACTIVE_STATS[:-1], "pos_active_") + [p.DEBT]
        return out + ["p" + x for x in p.REPRESENTATIVE]
    if name == "card_features":
        out = _names(c.STATS, "credit_") + ["CC_COUNT"] + _names(c.STATS_12, "credit12_") + _names(c.STATS_6, "credit6_")
        out += ["credit_prev_mean(CREDIT_LIMIT_LAST_BY_MIN)"]
        return out + _names(c.ACTIVE_STATS[:-1], "credit_active_") + [c.DEBT]
    if name == "app":
        out = [line.split()[0] for line in SCHEMAS["application_all"].split(",")][1:]
        out += [line.split()[-1].rstrip(",") for line in BASIC.strip().splitlines()[1:]]
        return out + ["SOURCES_STD", *application.BY_OCCUPATION.values()]
    if name == "cross_features":
        kinds, shorts = ["", "CASH_", "REVOLVING_"], ["ANNUITY", "CREDIT"]
        out = [f"MEAN_PREV_{k}{s}" for k in kinds for s in shorts]
        out += [f"PREV_TO_CURR_{s}_RATIO_{k}" for k in ["CASH", "REVOLVING"] for s in shorts]
        out += ["SUM(AMT_DEBT_ACTIVE_ALL)", "CURRENT_DEBT_TO_CREDIT_RATIO", "CURRENT_DEBT_TO_ANNUITY_RATIO"]
        for t in application.POOLED_TARGETS:
            for postfix in ["ORG_CONTRACT", "OCC_CONTRACT"]:
                out += [f"{t}_BY_{postfix}{end}" for end in ["", "_RATIO", "_DIFF"]]
        return out
    parts = ["app", "card_features", "bureau_features", "prev_features", "ins_features", "pos_features", "cross_features"]
    dropped = {*STRICT, *USELESS}
    return [x for part in parts for x in columns(part) if x not in dropped]


def digits(name: str) -> int | None:
    """Decimals kept before comparing; only results that depend on summation order are rounded."""
    if "var(" in name:
        return -4 if "DIFF" in name else 6
    if "std(" in name:
        return 3
    return 6 if "mean(" in name or name in ("SOURCES_MEAN", "SOURCES_STD") else None


def settle(value: str, name: str) -> str:
    """SQL text for both engines: a result rounded where it depends on summation order.

    Ratios of small numbers often have a true mean half-way between two rounded
    values, where the last bit decides; the small shift moves them off that point.
    """
    d = digits(name)
    return value if d is None else f"round({value} + {0.033 * 10.0**-d:.2e}, {d}) + 0e0"


def feature_sql(name: str) -> str:
    """A whole feature table with plain column names."""
    out = ["SK_ID_CURR as sk_id_curr"]
    for c in columns(name):
        out.append(f"{settle(q(c), c)} as {plain_name(c)}")
    return with_ctes(f"select {', '.join(out)} from {name}")

"""Applicant-level features and the features that combine all sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import blank_when, named, ratio, row_mean, row_std
from riskloom.operators.groups import fill_with_mean, mean_by_type, pooled_group_mean, relative_to_median
from riskloom.operators.joins import add_columns, attach

KEY = "SK_ID_CURR"

# The "no date" sentinel, the score columns, the columns compared
# with the median of the applicant's occupation, and the names they get.
NO_DATE = 365243
SOURCES = ["EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3"]
BY_OCCUPATION = {
    "AMT_INCOME_TOTAL": "REL_AMT_INCOME_BY_OCCUPATION",
    "AMT_CREDIT": "REL_AMT_CREDIT_BY_OCCUPATION",
    "AMT_ANNUITY": "REL_AMT_ANNUITY_BY_OCCUPATION",
    "DAYS_BIRTH": "REL_DAYS_BIRTH_BY_OCCUPATION",
}
GROUPINGS = {"ORG_CONTRACT": "ORGANIZATION_TYPE", "OCC_CONTRACT": "OCCUPATION_TYPE"}
POOLED_TARGETS = ["AMT_ANNUITY", "AMT_CREDIT", "AMT_GOODS_PRICE"]


def basic_features(app: DataFrame) -> DataFrame:
    """Ratios and score statistics of one application; also used on earlier loans."""
    app = app.withColumn("DAYS_EMPLOYED", blank_when("DAYS_EMPLOYED", NO_DATE))
    app = app.withColumns(
        {
            "CREDIT_TO_ANNUITY_RATIO": ratio("AMT_CREDIT", "AMT_ANNUITY"),
            "CREDIT_TO_GOODS_RATIO": ratio("AMT_CREDIT", "AMT_GOODS_PRICE"),
            "INC_PER_CHLD": ratio("AMT_INCOME_TOTAL", 1 + F.col("CNT_CHILDREN")),
            "EMPLOY_TO_BIRTH_RATIO": ratio("DAYS_EMPLOYED", "DAYS_BIRTH"),
            "ANNUITY_TO_INCOME_RATIO": ratio("AMT_ANNUITY", 1 + F.col("AMT_INCOME_TOTAL")),
            "SOURCES_PROD": F.col(SOURCES[0]) * F.col(SOURCES[1]) * F.col(SOURCES[2]),
            "SOURCES_MEAN": row_mean(SOURCES),
            "SOURCES_STD": row_std(SOURCES),
            "CAR_TO_BIRTH_RATIO": ratio("OWN_CAR_AGE", "DAYS_BIRTH"),
            "CAR_TO_EMPLOY_RATIO": ratio("OWN_CAR_AGE", "DAYS_EMPLOYED"),
            "PHONE_TO_BIRTH_RATIO": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
            "PHONE_TO_BIRTH_RATIO_EMPLOYER": ratio("DAYS_LAST_PHONE_CHANGE", "DAYS_EMPLOYED"),
            "CREDIT_TO_INCOME_RATIO": ratio("AMT_CREDIT", "AMT_INCOME_TOTAL"),
        }
    )
    return fill_with_mean(app, "SOURCES_STD")


def application(app: DataFrame) -> DataFrame:
    """The base of the matrix: one row per applicant of known gender code."""
    known = app.where(F.coalesce(F.col("CODE_GENDER") != "XNA", F.lit(True)))
    return relative_to_median(basic_features(known), "OCCUPATION_TYPE", BY_OCCUPATION)


def previous_means(base: DataFrame, prev: DataFrame) -> DataFrame:
    """Earlier average annuity and credit, in total and per contract type, against the request."""
    means = mean_by_type(
        prev.where(F.col("AMT_ANNUITY") > 0),
        KEY,
        "NAME_CONTRACT_TYPE",
        {None: "", "Cash loans": "CASH_", "Revolving loans": "REVOLVING_"},
        {"AMT_ANNUITY": "ANNUITY", "AMT_CREDIT": "CREDIT"},
    )
    joined = attach(base.select(KEY, "AMT_CREDIT", "AMT_ANNUITY"), means, KEY)
    for kind in ["CASH", "REVOLVING"]:
        for short in ["CREDIT", "ANNUITY"]:
            joined = joined.withColumn(
                f"PREV_TO_CURR_{short}_RATIO_{kind}", ratio(f"AMT_{short}", f"MEAN_PREV_{kind}_{short}")
            )
    return joined.drop("AMT_CREDIT", "AMT_ANNUITY")


def debt_ratios(df: DataFrame) -> DataFrame:
    """Outstanding debt over all active loans, against the request."""
    pos, card = named("SUM(AMT_DEBT_ACTIVE_LOAN_POS)"), named("SUM(AMT_DEBT_ACTIVE_LOAN_CREDIT)")
    debt = F.coalesce(pos, F.lit(0.0)) + F.coalesce(card, F.lit(0.0))
    df = df.withColumn("SUM(AMT_DEBT_ACTIVE_ALL)", debt)
    return df.withColumns(
        {
            "CURRENT_DEBT_TO_CREDIT_RATIO": ratio("SUM(AMT_DEBT_ACTIVE_ALL)", "AMT_CREDIT"),
            "CURRENT_DEBT_TO_ANNUITY_RATIO": ratio("SUM(AMT_DEBT_ACTIVE_ALL)", "AMT_ANNUITY"),
        }
    )


def pooled_features(base: DataFrame, prev: DataFrame) -> DataFrame:
    """The request against the mean of similar contracts, now and earlier.

    Similar means the same employer type and contract type, and separately the
    same occupation and contract type.
    """
    earlier = attach(
        prev.select(KEY, "NAME_CONTRACT_TYPE", *POOLED_TARGETS), base.select(KEY, *GROUPINGS.values()), KEY
    )
    return pooled_group_mean(base, earlier, KEY, GROUPINGS, "NAME_CONTRACT_TYPE", POOLED_TARGETS)


def cross_features(base: DataFrame, prev: DataFrame, narrow: DataFrame | None = None) -> DataFrame:
    """Add everything that needs more than one source.

    ``narrow`` may be the applicant table alone; the group comparisons then run
    on it and the wide base is joined once per result.
    """
    narrow = base if narrow is None else narrow
    out = add_columns(base, previous_means(narrow, prev), KEY)
    out = debt_ratios(out)
    return add_columns(out, pooled_features(narrow, prev), KEY)

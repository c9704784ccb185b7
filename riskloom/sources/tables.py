"""The seven input tables and how they are read.

Column types are declared.  Columns a plan does not touch are pruned from the scan
by Catalyst.  NaN becomes NULL here and nowhere else.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from riskloom.functions import quoted, without_nan
from riskloom.operators.checks import require_columns

# Column names and types of the input tables.
SCHEMAS: dict[str, str] = {
    "application_all": """
        SK_ID_CURR bigint, TARGET double, CODE_GENDER string, OCCUPATION_TYPE string,
        ORGANIZATION_TYPE string, NAME_CONTRACT_TYPE string, NAME_TYPE_SUITE string,
        HOUSETYPE_MODE string, AMT_CREDIT double, AMT_ANNUITY double, AMT_GOODS_PRICE double,
        AMT_INCOME_TOTAL double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, EXT_SOURCE_3 double,
        OWN_CAR_AGE double, DAYS_LAST_PHONE_CHANGE double, CNT_CHILDREN int, DAYS_BIRTH int,
        DAYS_EMPLOYED int, FLAG_MOBIL int, FLAG_CONT_MOBILE int, FLAG_DOCUMENT_2 int,
        FLAG_DOCUMENT_4 int, FLAG_DOCUMENT_5 int, FLAG_DOCUMENT_6 int, FLAG_DOCUMENT_7 int,
        FLAG_DOCUMENT_8 int, FLAG_DOCUMENT_9 int, FLAG_DOCUMENT_10 int, FLAG_DOCUMENT_11 int,
        FLAG_DOCUMENT_12 int, FLAG_DOCUMENT_13 int, FLAG_DOCUMENT_14 int, FLAG_DOCUMENT_15 int,
        FLAG_DOCUMENT_16 int, FLAG_DOCUMENT_17 int, FLAG_DOCUMENT_18 int, FLAG_DOCUMENT_19 int,
        FLAG_DOCUMENT_20 int, FLAG_DOCUMENT_21 int, REG_REGION_NOT_LIVE_REGION int,
        AMT_REQ_CREDIT_BUREAU_HOUR double, AMT_REQ_CREDIT_BUREAU_DAY double,
        AMT_REQ_CREDIT_BUREAU_WEEK double, AMT_REQ_CREDIT_BUREAU_MON double,
        AMT_REQ_CREDIT_BUREAU_QRT double
    """,
    "bureau": """
        SK_ID_BUREAU bigint, SK_ID_CURR bigint, CREDIT_ACTIVE string, CREDIT_TYPE string,
        DAYS_CREDIT int, CREDIT_DAY_OVERDUE int, CNT_CREDIT_PROLONG int, DAYS_CREDIT_UPDATE int,
        DAYS_CREDIT_ENDDATE double, DAYS_ENDDATE_FACT double, AMT_CREDIT_MAX_OVERDUE double,
        AMT_CREDIT_SUM double, AMT_CREDIT_SUM_DEBT double, AMT_CREDIT_SUM_LIMIT double,
        AMT_CREDIT_SUM_OVERDUE double, AMT_ANNUITY double
    """,
    "bureau_balance": "SK_ID_BUREAU bigint, MONTHS_BALANCE int, STATUS string",
    "previous_application": """
        SK_ID_PREV bigint, SK_ID_CURR bigint, FLAG_LAST_APPL_PER_CONTRACT string,
        NAME_CONTRACT_TYPE string, NAME_CONTRACT_STATUS string, NAME_YIELD_GROUP string,
        NAME_GOODS_CATEGORY string, NAME_TYPE_SUITE string, WEEKDAY_APPR_PROCESS_START string,
        PRODUCT_COMBINATION string, AMT_ANNUITY double, AMT_APPLICATION double, AMT_CREDIT double,
        AMT_DOWN_PAYMENT double, AMT_GOODS_PRICE double, RATE_DOWN_PAYMENT double,
        CNT_PAYMENT double, HOUR_APPR_PROCESS_START int, DAYS_DECISION int,
        DAYS_FIRST_DRAWING double, DAYS_FIRST_DUE double, DAYS_LAST_DUE_1ST_VERSION double,
        DAYS_LAST_DUE double, DAYS_TERMINATION double
    """,
    "installments_payments": """
        SK_ID_PREV bigint, SK_ID_CURR bigint, NUM_INSTALMENT_NUMBER int,
        NUM_INSTALMENT_VERSION double, DAYS_INSTALMENT double, DAYS_ENTRY_PAYMENT double,
        AMT_INSTALMENT double, AMT_PAYMENT double
    """,
    "POS_CASH_balance": """
        SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE int, CNT_INSTALMENT double,
        CNT_INSTALMENT_FUTURE double, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int
    """,
    "credit_card_balance": """
        SK_ID_PREV bigint, SK_ID_CURR bigint, MONTHS_BALANCE int, AMT_BALANCE double,
        AMT_CREDIT_LIMIT_ACTUAL double, AMT_DRAWINGS_ATM_CURRENT double, AMT_DRAWINGS_CURRENT double,
        AMT_DRAWINGS_OTHER_CURRENT double, AMT_DRAWINGS_POS_CURRENT double,
        AMT_INST_MIN_REGULARITY double, AMT_PAYMENT_CURRENT double, CNT_DRAWINGS_ATM_CURRENT double,
        CNT_DRAWINGS_CURRENT double, CNT_DRAWINGS_POS_CURRENT double,
        CNT_INSTALMENT_MATURE_CUM double, NAME_CONTRACT_STATUS string, SK_DPD int, SK_DPD_DEF int
    """,
}


@dataclass(frozen=True)
class Tables:
    """The raw input tables.  Plans clean what they need and leave these as read."""

    application_all: DataFrame
    bureau: DataFrame
    bureau_balance: DataFrame
    previous_application: DataFrame
    installments_payments: DataFrame
    POS_CASH_balance: DataFrame
    credit_card_balance: DataFrame


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table from ``<folder>/<name>.parquet``.

    Declared columns have to be there and get their declared types; further
    columns pass through, so an application keeps all of its attributes.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    declared = dict(c.split() for c in SCHEMAS[name].split(","))
    require_columns(df, declared)
    typed = [f"cast({quoted(c)} as {declared[c]}) as {quoted(c)}" if c in declared else quoted(c) for c in df.columns]
    return without_nan(df).selectExpr(*typed)


def read_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(**{f.name: read_table(spark, folder, f.name) for f in fields(Tables)})

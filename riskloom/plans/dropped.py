"""Columns the matrix leaves out."""

# Application columns that are always there and never used.
STRICT = """
    ORGANIZATION_TYPE AMT_REQ_CREDIT_BUREAU_HOUR AMT_REQ_CREDIT_BUREAU_DAY
    AMT_REQ_CREDIT_BUREAU_WEEK AMT_REQ_CREDIT_BUREAU_MON AMT_REQ_CREDIT_BUREAU_QRT
    FLAG_CONT_MOBILE FLAG_DOCUMENT_10 FLAG_DOCUMENT_11 FLAG_DOCUMENT_12
    FLAG_DOCUMENT_13 FLAG_DOCUMENT_14 FLAG_DOCUMENT_15 FLAG_DOCUMENT_17
    FLAG_DOCUMENT_19 FLAG_DOCUMENT_2 FLAG_DOCUMENT_20 FLAG_DOCUMENT_21
    FLAG_DOCUMENT_4 FLAG_DOCUMENT_7 FLAG_DOCUMENT_9 FLAG_MOBIL
""".split()

# Features found to be of no use; one per line, absent ones are ignored.
USELESS = [
    line.strip()
    for line in """
    b_365_mean(CNT_CREDIT_PROLONG)
    b_365_sum(CNT_CREDIT_PROLONG)
    b_720_sum(CNT_CREDIT_PROLONG)
    b_720_sum(CREDIT_DAY_OVERDUE)
    b_active_mean(DAYS_ENDDATE_FACT)
    b_active_mean(ENDDATE_DIFF)
    b_car_count(DAYS_CREDIT)
    b_car_mean(AMT_CREDIT_SUM_LIMIT)
    b_car_mean(AMT_CREDIT_SUM_OVERDUE)
    b_car_mean(CNT_CREDIT_PROLONG)
    b_car_mean(CREDIT_DAY_OVERDUE)
    b_car_nunique(CREDIT_TYPE)
    b_car_sum(AMT_CREDIT_SUM_LIMIT)
    b_car_sum(AMT_CREDIT_SUM_OVERDUE)
    b_car_sum(CNT_CREDIT_PROLONG)
    b_closed_mean(CREDIT_DAY_OVERDUE)
    b_closed_sum(AMT_CREDIT_SUM_OVERDUE)
    b_closed_sum(CREDIT_DAY_OVERDUE)
    b_consumer_mean(CNT_CREDIT_PROLONG)
    b_consumer_nunique(CREDIT_TYPE)
    b_consumer_sum(AMT_CREDIT_SUM_LIMIT)
    b_consumer_sum(CNT_CREDIT_PROLONG)
    b_credit_nunique(CREDIT_TYPE)
    b_credit_sum(CREDIT_DAY_OVERDUE)
    b_micro_max(BB_DPD_MEAN)
    b_micro_max(BB_MONTHS_BALANCE_MAX)
    b_micro_mean(AMT_CREDIT_DEBT_DIFF)
    b_micro_mean(AMT_CREDIT_MAX_OVERDUE)
    b_micro_mean(AMT_CREDIT_SUM_LIMIT)
    b_micro_mean(AMT_CREDIT_SUM_OVERDUE)
    b_micro_mean(BB_DPD_MEAN)
    b_micro_mean(BB_MONTHS_BALANCE_SIZE)
    b_micro_mean(CNT_CREDIT_PROLONG)
    b_micro_mean(DAYS_ENDDATE_FACT)
    b_micro_mean(ENDDATE_DIFF)
    b_micro_min(BB_MONTHS_BALANCE_MIN)
    b_micro_nunique(CREDIT_TYPE)
    b_micro_sum(AMT_CREDIT_SUM_LIMIT)
    b_micro_sum(AMT_CREDIT_SUM_OVERDUE)
    b_micro_sum(CNT_CREDIT_PROLONG)
    b_micro_sum(CREDIT_DAY_OVERDUE)
    b_mortage_mean(AMT_CREDIT_MAX_OVERDUE)
    b_mortage_mean(AMT_CREDIT_SUM_LIMIT)
    b_mortage_mean(CNT_CREDIT_PROLONG)
    b_mortage_mean(ENDDATE_DIFF)
    b_mortage_nunique(CREDIT_TYPE)
    b_mortage_sum(AMT_CREDIT_SUM_LIMIT)
    b_mortage_sum(CNT_CREDIT_PROLONG)
    b_sum(CREDIT_DAY_OVERDUE)
    CC_COUNT
    ins_cash_min(DPD)
    ins_cash_min(DPD_RATIO)
    ins_cash_min(DPD_with_prev)
    ins_cash_min(DPD_without_prev)
    ins_consumer_min(DPD)
    ins_consumer_min(DPD_RATIO)
    ins_consumer_min(DPD_with_prev)
    ins_consumer_min(DPD_without_prev)
    ins_credit_max(N_PAYMENTS)
    ins_credit_max(PAYMENT_PERC)
    ins_credit_min(DBD)
    ins_credit_min(DPD)
    ins_credit_min(DPD_RATIO)
    ins_credit_min(DPD_with_prev)
    ins_credit_min(DPD_without_prev)
    ins_credit_min(PAYMENT_DIFF)
    ins_credit_nunique(NUM_INSTALMENT_VERSION)
    ins_min(DPD)
    ins_min(DPD_RATIO)
    ins_min(DPD_with_prev)
    ins_min(DPD_without_prev)
    p_cashmean(AMT_DOWN_PAYMENT)
    p_cashmean(RATE_DOWN_PAYMENT)
    b_365_max(BB_MONTHS_BALANCE_MAX)
    b_365_mean(CREDIT_DAY_OVERDUE)
    b_720_mean(CREDIT_DAY_OVERDUE)
    b_active_mean(CREDIT_DAY_OVERDUE)
    b_car_min(AMT_CREDIT_DEBT_PERC)
    b_car_sum(AMT_ANNUITY)
    b_car_sum(AMT_CREDIT_MAX_OVERDUE)
    b_car_sum(CREDIT_DAY_OVERDUE)
    b_closed_sum(CNT_CREDIT_PROLONG)
    b_consumer_mean(AMT_CREDIT_SUM_OVERDUE)
    b_credit_mean(AMT_CREDIT_SUM_OVERDUE)
    b_credit_mean(CREDIT_DAY_OVERDUE)
    b_credit_sum(AMT_CREDIT_SUM_OVERDUE)
    b_micro_mean(AMT_CREDIT_DEBT_PERC)
    b_micro_sum(AMT_CREDIT_DEBT_DIFF)
    b_micro_sum(AMT_CREDIT_MAX_OVERDUE)
    b_mortage_count(DAYS_CREDIT)
    b_mortage_max(BB_DPD_MEAN)
    b_mortage_max(BB_MONTHS_BALANCE_MAX)
    b_mortage_mean(BB_DPD_MEAN)
    b_mortage_sum(AMT_CREDIT_MAX_OVERDUE)
    b_mortage_sum(AMT_CREDIT_SUM_OVERDUE)
    b_sum(CNT_CREDIT_PROLONG)
    FLAG_DOCUMENT_5
    HOUSETYPE_MODE
    p_cashmax(AMT_DOWN_PAYMENT)
    REG_REGION_NOT_LIVE_REGION
    p_cashmean(NAME_GOODS_CATEGORY_Computers)
    p_cashmax(RATE_DOWN_PAYMENT)
    b_consumer_sum(CREDIT_DAY_OVERDUE)
    p_cashmean(NAME_GOODS_CATEGORY_Consumer Electronics)
    p_cashmean(NAME_GOODS_CATEGORY_Mobile)
    b_closed_mean(AMT_CREDIT_SUM_OVERDUE)
    p_cashmean(NAME_GOODS_CATEGORY_XNA)
""".strip().splitlines()
]

"""Named feature sets: a base table plus added and minus removed columns.

Later sets extend earlier ones, so each states only what it adds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.checks import require_columns
from riskloom.operators.joins import add_columns
from riskloom.operators.shape import drop_required

KEY = "SK_ID_CURR"


def _lines(text: str) -> tuple[str, ...]:
    return tuple(line.strip() for line in text.strip().splitlines())


# The columns each step adds or removes.
RARE_DOCUMENTS = _lines(
    """
    FLAG_DOCUMENT_5
    FLAG_DOCUMENT_6
    FLAG_DOCUMENT_8
    FLAG_DOCUMENT_16
    FLAG_DOCUMENT_18
    """
)
LATENESS = _lines(
    """
    ins_min(DPD_with_prev)
    ins_min(DPD_without_prev)
    ins_min(DPD_RATIO)
    ins_mean(DPD_RATIO)
    """
)
DEBT = _lines(
    """
    ins_min(AMT_CREDIT_DEBT_PERC_NZ)
    ins_max(AMT_CREDIT_DEBT_PERC_NZ)
    ins_sum(AMT_CREDIT_DEBT_DIFF_NZ)
    POS_PREDICTED
    """
)
AHEAD_AND_LIMITS = _lines(
    """
    pos_min(CNT_INSTALMENT_AHEAD_RATIO)
    pos12_mean(CNT_INSTALMENT_AHEAD_RATIO)
    pos_min(CNT_INSTALMENT_AHEAD)
    pos_max(CNT_INSTALMENT_AHEAD)
    credit_prev_mean(CREDIT_LIMIT_LAST_BY_MIN)
    credit_mean(AMT_CREDIT_LIMIT_ACTUAL)
    credit6_mean(AMT_CREDIT_LIMIT_ACTUAL)
    credit12_mean(AMT_CREDIT_LIMIT_ACTUAL)
    credit_max(AMT_BALANCE_PER_LMT)
    credit_mean(AMT_BALANCE_PER_LMT)
    credit6_min(AMT_BALANCE_PER_LMT)
    credit6_max(AMT_BALANCE_PER_LMT)
    credit12_mean(AMT_BALANCE_PER_LMT)
    credit12_max(AMT_BALANCE_PER_LMT)
    """
)
RECENT_AHEAD = _lines(
    """
    pos12_max(CNT_INSTALMENT_AHEAD_RATIO)
    pos12_min(CNT_INSTALMENT_AHEAD)
    pos12_max(CNT_INSTALMENT_AHEAD)
    ins365_sum(AMT_PAYMENT)
    ins365_mean(PAYMENT_PERC)
    """
)
RECENT_PAYMENTS = _lines(
    """
    ins180_max(AMT_PAYMENT)
    ins180_min(AMT_PAYMENT)
    ins180_sum(AMT_PAYMENT)
    ins180_std(AMT_PAYMENT)
    ins180_mean(AMT_PAYMENT)
    ins180_mean(PAYMENT_PERC)
    ins180_var(PAYMENT_PERC)
    ins180_std(PAYMENT_PERC)
    ins180_min(PAYMENT_PERC)
    ins365_min(PAYMENT_PERC)
    ins365_var(PAYMENT_PERC)
    ins365_std(PAYMENT_PERC)
    ins180_sum(AMT_INSTALMENT)
    ins180_mean(AMT_INSTALMENT)
    ins365_sum(AMT_INSTALMENT)
    ins365_std(AMT_INSTALMENT)
    ins365_max(AMT_INSTALMENT)
    ins180_max(PAYMENT_DIFF)
    ins180_mean(PAYMENT_DIFF)
    ins365_max(PAYMENT_DIFF)
    ins365_var(PAYMENT_DIFF)
    ins365_std(PAYMENT_DIFF)
    ins365_mean(PAYMENT_DIFF)
    ins180_max(DPD)
    ins180_mean(DPD)
    ins180_std(DPD)
    ins180_sum(DPD)
    ins365_max(DPD)
    ins365_mean(DPD)
    ins365_std(DPD)
    ins365_sum(DPD)
    ins180_sum(DBD)
    ins180_max(DBD)
    ins180_std(DBD)
    ins180_mean(DBD)
    ins365_mean(DBD)
    ins365_mean(DAYS_ENTRY_PAYMENT_INTERVAL)
    ins365_min(DAYS_ENTRY_PAYMENT_INTERVAL)
    ins180_sum(DAYS_ENTRY_PAYMENT)
    ins365_mean(DAYS_ENTRY_PAYMENT)
    """
)
COMBINED = _lines(
    """
    PREV_TO_CURR_ANNUITY_RATIO_CASH
    PREV_TO_CURR_CREDIT_RATIO_CASH
    AMT_CREDIT_BY_ORG_CONTRACT_RATIO
    PREV_TO_CURR_ANNUITY_RATIO
    AMT_ANNUITY_BY_ORG_CONTRACT_DIFF
    PREV_TO_CURR_ANNUITY_RATIO_REVOLVING
    AMT_ANNUITY_BY_ORG_CONTRACT
    PREV_TO_CURR_CREDIT_RATIO_REVOLVING
    MEAN_PREV_REVOLVING_ANNUITY
    MEAN_PREV_CREDIT
    AMT_CREDIT_BY_ORG_CONTRACT_DIFF
    AMT_ANNUITY_BY_ORG_CONTRACT_RATIO
    MEAN_PREV_CASH_ANNUITY
    MEAN_PREV_ANNUITY
    MEAN_PREV_REVOLVING_CREDIT
    AMT_GOODS_PRICE_BY_ORG_CONTRACT
    """
)


@dataclass(frozen=True)
class FeatureSet:
    name: str
    add: tuple[str, ...] = ()
    remove: tuple[str, ...] = ()
    known_gender: bool = True
    seed: int | None = None
    max_depth: int = 8
    folds: int = 5

    def apply(self, base: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
        """Join the added columns by key, drop the removed ones, and filter the rows."""
        out = base
        if self.add:
            if candidates is None:
                raise ValueError(f"{self.name} adds columns and needs a table of candidates")
            require_columns(candidates, self.add)
            out = add_columns(out.drop(*self.add), candidates, KEY, self.add)
        if self.known_gender:
            out = out.where(F.coalesce(F.col("CODE_GENDER") != "XNA", F.lit(True)))
        return drop_required(out, self.remove)


def _sets() -> dict[str, FeatureSet]:
    late = ("PREDICTED_DPD", *LATENESS)
    six = (*late, *DEBT)
    seven = (*six, *AHEAD_AND_LIMITS)
    eight = (*seven, *RECENT_AHEAD)
    nine = (*eight, *RECENT_PAYMENTS)
    ten = nine[1:]
    eleven = ("PREDICTED_X14Y-1", *ten, *COMBINED)

    def make(name: str, add: tuple[str, ...], **options) -> FeatureSet:
        return FeatureSet(name, add, RARE_DOCUMENTS, seed=2, **options)

    out = [
        FeatureSet("model1"),
        FeatureSet("model2", remove=RARE_DOCUMENTS, known_gender=False),
        make("model3", late),
        make("model4", late, max_depth=-1),
        make("model5", (*six, "ins_sum(AMT_CREDIT_DEBT_DIFF)")),
        make("model6", six),
        make("model7", seven),
        make("model8", eight),
        make("model9", nine),
        *[make(f"model10_x{x}y-1", (f"PREDICTED_X{x}Y-1", *ten)) for x in (21, 28, 35)],
        make("model11", eleven, folds=10),
        make("model12", eleven),
    ]
    return {s.name: s for s in out}


SETS = _sets()

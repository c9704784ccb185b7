"""The feature matrix: one wide row per applicant."""

from __future__ import annotations

import hashlib
import inspect
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame

from riskloom.operators import aggregate, groups, ordered
from riskloom.operators.joins import add_columns, attach
from riskloom.operators.shape import drop_if_present, drop_required, sorted_columns
from riskloom.plans import application, bureau, credit_card, installments, pos_cash, previous
from riskloom.plans.dropped import STRICT, USELESS
from riskloom.session import written
from riskloom.sources.store import Cache
from riskloom.sources.tables import Tables

KEY = "SK_ID_CURR"
# The part that takes most disk on its way is built while no other lies there.
LARGEST = "install"


def parts(t: Tables, without: Collection[str] = ()) -> dict[str, Callable[[], DataFrame]]:
    """The features of each source table, by the name they are cached under."""
    return {
        "credit": lambda: credit_card.features(t.credit_card_balance, t.previous_application, without),
        "bureau": lambda: bureau.features(t.bureau, t.bureau_balance, without),
        "prev": lambda: previous.features(t.previous_application, without),
        "install": lambda: installments.features(
            t.installments_payments, t.previous_application, t.credit_card_balance, without
        ),
        "cash": lambda: pos_cash.features(t.POS_CASH_balance, t.previous_application, without),
        "app": lambda: application.application(t.application_all),
    }


def sources(t: Tables) -> dict[str, tuple[list[DataFrame], list]]:
    """The tables that each part reads and the modules that build it."""
    return {
        "credit": ([t.credit_card_balance, t.previous_application], [credit_card, aggregate, ordered]),
        "bureau": ([t.bureau, t.bureau_balance], [bureau, aggregate]),
        "prev": ([t.previous_application], [previous, aggregate]),
        "install": ([t.installments_payments, t.previous_application, t.credit_card_balance], [installments, aggregate, ordered]),
        "cash": ([t.POS_CASH_balance, t.previous_application], [pos_cash, aggregate, ordered]),
        "app": ([t.application_all], [application, groups]),
    }


def _digest(modules: list, without: Collection[str]) -> str:
    text = "".join(inspect.getsource(m) for m in modules) + ",".join(sorted(without))
    return hashlib.md5(text.encode()).hexdigest()


def full_matrix(t: Tables, cache: Cache | None = None, without: Collection[str] = ()) -> DataFrame:
    """Every generated column but those left out from the start.

    All parts are one row per applicant.  Each part of a child table is written to the shared folder before the next is
    built, so the disk holds the shuffles of one part at a time; those of all parts together take several times the
    matrix.  With a cache a failed run can resume.
    """
    read, spark = sources(t), t.application_all.sparkSession

    def part(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if cache:
            return cache.table(name, make, read[name][0], _digest(read[name][1], without))
        return make() if name == "app" else written(spark, make, f"matrix-{name}")

    makers = parts(t, without)
    built = {name: part(name, makers[name]) for name in sorted(makers, key=lambda name: name != LARGEST)}
    base = out = built["app"]
    for name in makers:
        if name != "app":
            out = attach(out, built[name], KEY)
    return application.cross_features(out, previous.loans(t.previous_application), narrow=base)


def feature_matrix(t: Tables, stacked: DataFrame | None = None, cache: Cache | None = None) -> DataFrame:
    """The matrix as models read it: stacked predictions in, unused columns out, columns sorted."""
    out = full_matrix(t, cache, USELESS)
    if stacked is not None:
        out = add_columns(out, stacked, KEY)
    out = drop_required(out, STRICT)
    return sorted_columns(drop_if_present(out, USELESS))

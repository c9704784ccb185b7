"""Feature selection by re-scoring with columns removed or added.

Every step may be logged when it is done (``log``), so that a broken run keeps its finished steps; ``skip`` resumes
after that many groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from riskloom.models.folds import FOLDS
from riskloom.models.prepare import Prepared
from riskloom.models.train import SELECTION_ROUNDS, Cv, cross_validate

RESULT = "step string, changed string, fold_auc array<double>, auc double, abandoned boolean"


def chunks(columns: Sequence[str], n: int) -> list[list[str]]:
    """All columns in groups of n; the last group may be smaller."""
    return [list(columns[i : i + n]) for i in range(0, len(columns), n)]


def _row(step: str, changed: Sequence[str], result: Cv | dict[int, float]) -> tuple:
    if isinstance(result, Cv):
        return step, ",".join(changed), [result.fold_auc.get(i) for i in sorted(result.fold_auc)], result.auc, False
    return step, ",".join(changed), [result[i] for i in sorted(result)], None, True


Log = Callable[[tuple], None]


def _silent(row: tuple) -> None:
    pass


def backward(data: Prepared, params: dict, n: int = 5, skip: int = 0, k: int = FOLDS, log: Log = _silent, **options) -> DataFrame:
    """Leave out n columns at a time."""
    rows = [_row("baseline", [], cross_validate(data, params, k, **options))]
    log(rows[-1])
    for group in chunks(data.features, n)[skip:]:
        rest = [c for c in data.features if c not in group]
        rows.append(_row("drop", group, cross_validate(data, params, k, features=rest, **options)))
        log(rows[-1])
    return data.table.sparkSession.createDataFrame(rows, RESULT)


def losing(baseline: dict[int, float | None], k: int):
    """The abandon rule: more than half of the folds lost and the sum of differences negative.

    A fold with one class has no AUC and decides nothing.
    """

    def rule(done: dict[int, float | None]) -> bool:
        diffs = [done[i] - baseline[i] for i in done if done[i] is not None and baseline.get(i) is not None]
        return sum(d < 0 for d in diffs) > k / 2 and sum(diffs) < 0

    return rule


def forward(
    data: Prepared, params: dict, base: Sequence[str], candidates: Sequence[str], n: int = 2,
    abandon: bool = True, k: int = FOLDS, skip: int = 0, log: Log = _silent,
) -> DataFrame:
    """Add n candidate columns at a time to the base columns, with a fixed number of rounds and no early stopping."""
    params = {**params, "n_estimators": min(params.get("n_estimators", SELECTION_ROUNDS), SELECTION_ROUNDS)}
    baseline = cross_validate(data, params, k, features=base, early_stop=False)
    rows = [_row("baseline", [], baseline)]
    log(rows[-1])
    watch = losing(baseline.fold_auc, k) if abandon else None
    for group in chunks(candidates, n)[skip:]:
        result = cross_validate(data, params, k, features=[*base, *group], early_stop=False, watch=watch)
        rows.append(_row("add", group, result))
        log(rows[-1])
    return data.table.sparkSession.createDataFrame(rows, RESULT)

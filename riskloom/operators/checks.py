"""Checks on the shape of the data.

``require_rows`` and ``require_some`` run a job; ``Observed`` counts rows while they are written for another reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Observed:
    """A table whose rows are counted by the action that uses ``rows``; the checks hold afterwards and run no job."""

    def __init__(self, df: DataFrame, name: str):
        self.name, self._seen = name, Observation()
        self.rows = df.observe(self._seen, F.count(F.lit(1)).alias("rows"))

    def count(self) -> int:
        return self._seen.get["rows"]

    def require_some(self) -> Observed:
        if not self.count():
            raise ValueError(f"table {self.name} is empty")
        return self

    def require_rows(self, expected: int) -> Observed:
        if self.count() != expected:
            raise ValueError(f"table {self.name}: expected {expected} rows, found {self.count()}")
        return self


def require_rows(df: DataFrame, expected: int) -> DataFrame:
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, found {found}")
    return df


def require_some(**tables: DataFrame) -> None:
    for name, df in tables.items():
        if df.isEmpty():
            raise ValueError(f"table {name} is empty")


def require_same_columns(a: DataFrame, b: DataFrame) -> None:
    """Both tables must carry the same columns; compared from the schemas alone."""
    if set(a.columns) != set(b.columns):
        raise ValueError(f"columns differ: {sorted(set(a.columns) ^ set(b.columns))}")


def require_columns(df: DataFrame, columns) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {absent}")

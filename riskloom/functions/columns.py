"""Row-level column expressions.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation.  A missing value is SQL NULL, never NaN.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

__all__ = [
    "blank_when",
    "code_value",
    "flag",
    "gated",
    "member_flag",
    "named",
    "one_hot",
    "positive_part",
    "quoted",
    "ratio",
    "row_mean",
    "row_std",
    "without_nan",
]


def quoted(name: str) -> str:
    """A column name as SQL text; spaces, dots and parentheses are kept."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """A column reference that survives spaces, dots and parentheses."""
    return F.col(quoted(name))


def _column(c: Column | str) -> Column:
    return named(c) if isinstance(c, str) else c


def without_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating-point column (done once, at the source)."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.select(
        *[F.nanvl(named(c), F.lit(None)).alias(c) if c in floats else named(c) for c in df.columns]
    )


def blank_when(c: Column | str, sentinel) -> Column:
    """NULL where the column holds its "missing" sentinel."""
    return F.nullif(_column(c), F.lit(sentinel))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as a double, NULL when b is 0 or either side is missing."""
    return F.try_divide(_column(a).cast("double"), _column(b).cast("double"))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-null values of one row."""
    cols = [_column(c).cast("double") for c in columns]
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols])
    return F.try_divide(total, _present(cols).cast("double"))


def row_std(columns: Sequence[str]) -> Column:
    """Sample standard deviation of the non-null values of one row; NULL below two values."""
    cols = [_column(c).cast("double") for c in columns]
    mean = row_mean(columns)
    squares = reduce(add, [F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cols])
    n = _present(cols)
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def _present(cols: Sequence[Column]) -> Column:
    return reduce(add, [c.isNotNull().cast("int") for c in cols])


def positive_part(c: Column | str) -> Column:
    """The value where it is above 0, otherwise 0; a missing value also gives 0."""
    c = _column(c)
    return F.greatest(c, F.lit(0).cast("double"))


def code_value(c: Column | str, mapping: dict) -> Column:
    """Look a code up in a small fixed mapping; unknown codes give NULL."""
    c = _column(c)
    first, *rest = mapping.items()
    expr = F.when(c == first[0], F.lit(first[1]))
    for code, value in rest:
        expr = expr.when(c == code, F.lit(value))
    return expr


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or cannot be decided."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def member_flag(c: Column | str, values: Iterable) -> Column:
    return flag(_column(c).isin(*values))


def one_hot(c: Column | str, values: Sequence[str], prefix: str) -> dict[str, Column]:
    """One 0/1 column per declared value, named ``prefix_value``; all 0 for NULL."""
    return {f"{prefix}_{v}": flag(_column(c) == v) for v in values}


def gated(c: Column | str, gate: Column) -> tuple[Column, Column]:
    """Split a column by a gate: its value where the gate is closed, and where it is open.

    An undecidable gate counts as closed.  The other half is 0; a missing value
    stays missing in both.
    """
    c = _column(c)
    is_open = F.coalesce(gate, F.lit(False))
    return c * (~is_open).cast("int"), c * is_open.cast("int")

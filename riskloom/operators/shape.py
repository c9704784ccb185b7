"""Column lists, unions and top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import named, quoted
from riskloom.operators.checks import require_columns


def drop_required(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that have to be there."""
    require_columns(df, columns)
    return df.drop(*columns)


def drop_if_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[quoted(c) for c in sorted(df.columns)])


def plain_name(name: str) -> str:
    """A lower-case name without parentheses or spaces: ``b_mean(AMT_X)`` to ``b_mean_amt_x``."""
    out = "".join(ch if ch.isalnum() else "_" for ch in name.lower())
    while "__" in out:
        out = out.replace("__", "_")
    return out.strip("_")


def plain_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[plain_name(c) for c in df.columns])


def stack_sources(**sources: DataFrame) -> DataFrame:
    """All rows of several tables with a ``source`` marker; absent columns become NULL."""
    parts = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def top_rows(df: DataFrame, by: str, tie: str, n: int) -> DataFrame:
    """The n rows with the largest value, ties in the order of ``tie``."""
    return df.orderBy(named(by).desc(), named(tie)).limit(n)

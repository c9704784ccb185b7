"""Key joins.  Every join is an equi-join; Spark picks broadcast from measured sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions import named, quoted
from riskloom.session import computed


# A measured lookup is broadcast up to this size (as JSON text, which is larger
# than the rows in memory).
BROADCAST_BYTES = 8 * 1024 * 1024


def _keys(key: Sequence[str] | str) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def attach(base: DataFrame, features: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Left-join one-row-per-key features onto the base; absent keys get NULL."""
    return base.join(features, _keys(key), "left")


def attach_small(
    df: DataFrame, lookup: DataFrame, key: Sequence[str] | str, how: str = "left", ready: bool = False
) -> DataFrame:
    """Join a lookup that is expected to be small, such as one row per category.

    The lookup is computed (unless ``ready``) and measured first.  Within the bound it is
    broadcast, so the rows are not shuffled by a key with few, very unequal
    values; beyond it a shuffle join runs, where Spark splits hot partitions.
    """
    lookup = lookup if ready else computed(lookup)
    text = F.length(F.to_json(F.struct(*[named(c) for c in lookup.columns])))
    size = lookup.agg(F.coalesce(F.sum(text), F.lit(0))).first()[0]
    if size <= BROADCAST_BYTES:
        return df.join(F.broadcast(lookup), _keys(key), how)
    return df.join(lookup, _keys(key), how)


def enrich(child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Give each child row its parent's attributes.

    Without a column list every parent column comes along, except those the
    child already has (the child's own values win).
    """
    if columns is None:
        columns = [c for c in parent.columns if c not in child.columns]
    columns = [c for c in columns if c != key]
    return child.join(parent.select(named(key), *[named(c) for c in columns]), [key], "left")


def only_keys(df: DataFrame, ids: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Rows whose key is among ``ids``."""
    return df.join(ids.select(*_keys(key)), _keys(key), "left_semi")


def without_keys(df: DataFrame, ids: DataFrame, key: Sequence[str] | str) -> DataFrame:
    """Rows whose key is not among ``ids``; rows without a key stay."""
    return df.join(ids.select(*_keys(key)), _keys(key), "left_anti")


def mark_keys(df: DataFrame, ids: DataFrame, key: str, name: str) -> DataFrame:
    """A 0/1 column telling whether the key occurs in ``ids``."""
    known = ids.select(named(key)).where(named(key).isNotNull()).distinct().withColumn(name, F.lit(1))
    joined = df.join(known, [key], "left")
    return joined.withColumn(name, F.coalesce(named(name), F.lit(0)))


def override_columns(child: DataFrame, parent: DataFrame, key: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The parent's row for each child row, with ``columns`` taken from the child."""
    own = child.select(named(key), *[named(c) for c in keep], *[named(c) for c in columns])
    return own.join(parent.drop(*columns), [key], "left")


def add_columns(base: DataFrame, extra: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Join candidate columns by key, leaving out those the base already has."""
    if columns is None:
        columns = [c for c in extra.columns if c not in base.columns]
    columns = [c for c in columns if c != key]
    return attach(base, extra.selectExpr(quoted(key), *[quoted(c) for c in columns]), key)

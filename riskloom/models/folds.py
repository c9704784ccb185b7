"""Deterministic shuffled folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import named
from riskloom.session import computed

# The seed and number of folds used throughout.
SEED = 47
FOLDS = 5


def fold_of(ident: Column | str, k: int = FOLDS, seed: int = SEED) -> Column:
    """A fold number from a hash of the id: the same on every run and partitioning.

    Folding by an entity's id instead of the row's keeps all rows of the entity
    in one fold.
    """
    c = named(ident) if isinstance(ident, str) else ident
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % k).cast("int")


def with_folds(df: DataFrame, ident: str, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", fold_of(ident, k, seed))


# Entities with at least this part of a fold's rows are placed one by one; there are at most HEAVY * k of them.
HEAVY = 2000


def with_balanced_folds(df: DataFrame, entity: str, k: int = FOLDS, seed: int = SEED) -> DataFrame:
    """Folds that keep all rows of an entity together and are about equally large, however unequal the entities are.

    Light entities go by the hash of their id.  The few heavy ones are placed by their counted rows, the heaviest first,
    each into the fold that has least.  Rows without entity have no fold.
    """
    sizes = computed(df.where(named(entity).isNotNull()).groupBy(named(entity).alias("_e")).agg(F.count("*").alias("n")))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    heavy = F.col("n") * HEAVY * k >= total
    load = [0] * k
    for r in sizes.where(~heavy).groupBy(fold_of(F.col("_e"), k, seed).alias("fold")).agg(F.sum("n").alias("n")).collect():
        load[r["fold"]] += r["n"]
    placed = []
    for r in sorted(sizes.where(heavy).collect(), key=lambda r: (-r["n"], str(r["_e"]))):
        lightest = min(range(k), key=lambda i: (load[i], i))
        load[lightest] += r["n"]
        placed.append((r["_e"], lightest))
    kind = df.schema[entity].dataType.simpleString()
    found = df.sparkSession.createDataFrame(placed, f"_e {kind}, _fold int")
    out = df.join(F.broadcast(found), named(entity) == F.col("_e"), "left")
    return out.withColumn("fold", F.coalesce("_fold", fold_of(entity, k, seed))).drop("_e", "_fold")


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(named(label).isNotNull())


def unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(named(label).isNull())

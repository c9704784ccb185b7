"""Mixing sources to target weights in a tree of domains, languages and sources.

The token budget flows down the tree by weight.  No node gets more than its documents can give in ``EPOCHS`` passes; what
one cannot take goes to its siblings in proportion to their weights, and only what the siblings cannot take stays with
the parent, whose own capacity was settled the same way one level up.  Each leaf then fills its quota: whole passes first,
then the longest beginning of one more pass, in an order drawn from the seed, the pass and the id, that fits.

Everything is counted over all documents.  The running sums of a pass are taken over 4096 ranges of the order first, and
inside the one range of each leaf where the quota ends, so a leaf with a third of all rows is never sorted whole.

* Tokens are words here.  Null and empty texts have none and are never drawn.
* A missing level value is the value ''; a value without a stated weight has the weight of ``OTHER``.
* Rows without id are drawn like one with the id ''; rows of equal rank in the order are ranked by tokens, fewest first,
  and drawn together if all else is equal.
* An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD
from riskloom.operators.joins import attach_small
from riskloom.session import computed

OTHER = "*"
EPOCHS, SHARE, SEED, DIGITS = 2, 0.5, 7, 3
#: Target weights of the levels, by value; sources count alike.
WEIGHTS = {"domain": {"web": 5, "reference": 3, "forum": 2, OTHER: 1}, "lang": {"en": 6, "de": 2, "fr": 1, "es": 1, OTHER: 1}, "source": {OTHER: 1}}
LEVELS = list(WEIGHTS)
NAMED_DOMAINS = ("web", "reference", "forum")


def domain_of(source: Column) -> Column:
    """Sources carry no domain; their trailing number deals them to three, others have none."""
    number = F.regexp_extract(source, r"(\d+)$", 1)
    return F.when(number != "", F.element_at(F.array(*[F.lit(d) for d in NAMED_DOMAINS]), (F.right(number, F.lit(1)).cast("int") % 3) + 1)).otherwise("")


def _weight(level: str) -> Column:
    known = WEIGHTS[level]
    out = F.lit(known[OTHER])
    for value, w in known.items():
        out = F.when(F.col(level) == value, w).otherwise(out)
    return out.cast("decimal(38,0)")


def _filled(nodes: DataFrame, parent: list[str], level: str) -> DataFrame:
    """Give each child of every parent its part of the parent's ``budget``; ``cap`` is what it can take at most.

    Children are looked at in the order of capacity by weight: while the next one can take no more than its part of
    what is left, it gets its capacity; the others share the rest.
    """
    by = [F.col(p) for p in parent]
    order = Window.partitionBy(*by).orderBy((F.col("cap").cast("double") / F.col("weight").cast("double")), level)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*by)
    wide = nodes.withColumn("weight", _weight(level)).withColumn("cap", F.col("cap").cast("decimal(38,0)"))
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    wide = wide.withColumn("full", (F.col("cap") * F.sum("weight").over(from_here) <= F.col("weight") * left).cast("int"))
    wide = wide.withColumn("full", F.min("full").over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    spare = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0))
    shared = F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole)
    part = F.when(F.col("full"), F.col("cap")).otherwise(F.floor(F.col("weight") * spare / shared))
    return wide.withColumn("part", F.least(F.col("cap"), part).cast("long")).select(*parent, level, "part")


def quotas(leaves: DataFrame, budget: int) -> DataFrame:
    """(levels, tokens, quota) of each leaf; ``leaves`` has a row of levels and tokens for each."""
    quota = None
    for depth, level in enumerate(LEVELS):
        parent = LEVELS[:depth]
        nodes = leaves.groupBy(*parent, level).agg((F.sum("tokens") * EPOCHS).alias("cap"))
        if quota is None:
            nodes = nodes.withColumn("budget", F.lit(budget).cast("decimal(38,0)"))
        else:
            nodes = nodes.join(quota.withColumnRenamed("part", "budget"), parent)
        quota = _filled(nodes, parent, level)
    return leaves.join(quota.withColumnRenamed("part", "quota"), LEVELS)


def mixed_sources(docs: DataFrame, share: float = SHARE, seed: int = SEED, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """A row for every drawing of a document: id, levels, n_tokens and epoch; ``share`` is the budget in passes of all tokens."""
    tokens = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD)).cast("long")
    named = F.coalesce(F.col(f"`{source}`"), F.lit(""))
    body = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    rows = docs.select(F.col(f"`{key}`").alias("id"), body.alias("body"), domain_of(named).alias("domain"), F.coalesce(F.col(f"`{lang}`"), F.lit("")).alias("lang"), named.alias("source"), tokens.alias("n_tokens"))
    rows = computed(rows.where("n_tokens > 0"))
    leaves = computed(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")))
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    passes = F.expr("quota div tokens").alias("passes"), F.expr("quota % tokens").alias("rest")
    quota = computed(quotas(leaves, int(total * share)).select(*LEVELS, *passes))
    drawn = attach_small(rows, quota, LEVELS, "inner", ready=True)
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.coalesce(F.col("id").cast("string"), F.lit("")), "body"))
    drawn = drawn.withColumn("rank", rank).withColumn("range", F.substring("rank", 1, DIGITS))
    # Where each leaf's last pass ends: the range, and the tokens before it.
    sums = drawn.groupBy(*LEVELS, "rest", "range").agg(F.sum("n_tokens").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("range"))
    ends = sums.withColumn("before", upto - F.col("n")).where(F.col("before") <= F.col("rest"))
    cut = ends.groupBy(*LEVELS).agg(F.max(F.struct("range", "before")).alias("cut"))
    at = attach_small(drawn, cut, LEVELS)
    early = at.where(F.col("range") < F.col("cut.range")).withColumn("more", F.lit(1))
    late = at.where(F.col("range") > F.col("cut.range")).withColumn("more", F.lit(0))
    inside = at.where(F.col("range") == F.col("cut.range"))
    # Equal rows have one rank and are drawn or not together, so a rank is one row of the window, however many rows it has.
    ranks = inside.groupBy(*LEVELS, "cut", "rest", "rank").agg(F.sum("n_tokens").alias("n"))
    run = F.sum("n").over(Window.partitionBy(*LEVELS).orderBy("rank"))
    last = ranks.withColumn("fits", F.col("cut.before") + run <= F.col("rest")).groupBy(*LEVELS).agg(F.max(F.when(F.col("fits"), F.col("rank"))).alias("last"))
    inside = attach_small(inside, last, LEVELS).withColumn("more", F.coalesce((F.col("rank") <= F.col("last")).cast("int"), F.lit(0))).drop("last")
    every = early.unionByName(late).unionByName(inside)
    times = F.col("passes") + F.col("more")
    return every.where(times > 0).select(F.col("id").alias(key), *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)).alias("epoch"))

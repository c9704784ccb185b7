"""Feature-map aggregates: one groupBy per map, or one pass for many named slices."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import named, quoted
from riskloom.operators.groups import BRACKET_ERRORS, QUANTILE_ACCURACY, medians_by
from riskloom.operators.joins import attach, attach_small
from riskloom.session import computed

# A sum over a group whose values are all missing is 0; a group that does not
# exist stays NULL because the result is left-joined afterwards.
FUNCTIONS = {
    "count": "count({c})",
    "size": "count(1)",
    "sum": "coalesce(sum({c}), 0)",
    "mean": "avg({c})",
    "min": "min({c})",
    "max": "max({c})",
    "std": "stddev_samp({c})",
    "var": "var_samp({c})",
    "nunique": "count(distinct {c})",
}
# Not an expression of its own: see ``grouped``.
MEDIAN = "median"
# Up to this many values of a group its quantile summary holds them all.
SUMMARY_ROWS = 1000
# Distinct values of a column that are counted by bits, and the bits of one number.
BIT_VALUES, BITS = 1008, 63
# Rows of a key up to which they are brought together in one task.
HEAVY_ROWS = 1_000_000

Spec = list[tuple[str, str]]


def stat(fn: str, column: str) -> Column:
    """One statistic of a column as an aggregate expression."""
    return F.expr(FUNCTIONS[fn].format(c=quoted(column)))


def read_spec(text: str) -> Spec:
    """Read a feature map written as lines of ``column | fn fn ...``."""
    spec = []
    for line in text.strip().splitlines():
        column, _, fns = line.partition("|")
        spec += [(column.strip(), fn) for fn in fns.split()]
    return spec


def feature_name(prefix: str, fn: str, column: str) -> str:
    return f"{prefix}{fn}({column})"


def grouped(rows: DataFrame, by: Sequence[str], stats: dict[str, Column], medians: dict[str, str] | None = None) -> DataFrame:
    """One row per group of ``by``: the aggregates of ``stats`` and exact medians (name -> column), from one pass.

    A median's mergeable quantile summary rides along with the other aggregates.  It holds every value of a group of up to
    ``SUMMARY_ROWS``, and for larger ones the values between which the middle lies; only groups where these differ
    are read again, counted inside their bracket.
    """
    exprs = [c.alias(name) for name, c in stats.items()]
    if not medians:
        return rows.groupBy(*by).agg(*exprs)
    margin = BRACKET_ERRORS / QUANTILE_ACCURACY
    ends = [0.5 - margin, 0.5 + margin]
    at = {name: f"_q{i}" for i, name in enumerate(medians)}
    summaries = [
        F.struct(F.percentile_approx(named(c).cast("double"), ends, QUANTILE_ACCURACY).alias("b"), F.count(named(c)).alias("n")).alias(at[name])
        for name, c in medians.items()
    ]
    found = computed(rows.groupBy(*by).agg(*exprs, *summaries))
    low, high = {n: F.col(f"{q}.b")[0] for n, q in at.items()}, {n: F.col(f"{q}.b")[1] for n, q in at.items()}
    unsure = {n: (F.col(f"{q}.n") > SUMMARY_ROWS) & (low[n] < high[n]) for n, q in at.items()}
    large = found.where(F.greatest(*[c.cast("int") for c in unsure.values()], F.lit(0)) > 0).select(*by)
    out = found.withColumns({n: low[n] + (high[n] - low[n]) / 2 for n in medians}).drop(*at.values())
    if large.isEmpty():
        return out
    again = attach_small(rows, large, by, "inner").withColumn("_group", F.struct(*by))
    exact = medians_by(again, "_group", {c: f"_m{i}" for i, c in enumerate(dict.fromkeys(medians.values()))})
    place = {c: f"_m{i}" for i, c in enumerate(dict.fromkeys(medians.values()))}
    exact = exact.select("_group.*", *place.values(), F.lit(True).alias("_again"))
    both = out.join(exact, list(by), "left")
    return both.withColumns({n: F.when(F.col("_again"), F.col(place[c])).otherwise(named(n)) for n, c in medians.items()}).drop("_again", *place.values())


def compile_spec(spec: Spec, prefix: str = "") -> tuple[dict[str, Column], dict[str, str]]:
    """The aggregates of a feature map and the columns of its medians, by feature name."""
    names = {feature_name(prefix, fn, c): (c, fn) for c, fn in spec}
    return {n: stat(fn, c) for n, (c, fn) in names.items() if fn != MEDIAN}, {n: c for n, (c, fn) in names.items() if fn == MEDIAN}


def aggregate(child: DataFrame, key: str, spec: Spec, prefix: str = "", size_as: str | None = None) -> DataFrame:
    """One row per key.  Rows without a key are left out before the shuffle."""
    stats, medians = compile_spec(spec, prefix)
    if size_as:
        stats[size_as] = F.count(F.lit(1))
    found = grouped(child.where(named(key).isNotNull()), [key], stats, medians)
    names = [feature_name(prefix, fn, c) for c, fn in spec] + ([size_as] if size_as else [])
    return found.select(named(key), *[named(n) for n in dict.fromkeys(names)])


def group_stat(df: DataFrame, by: Sequence[str] | str, target: str, fn: str, name: str, merge: bool = True) -> DataFrame:
    """One statistic per group, either on its own or attached to every row.

    Attaching is a group aggregate joined back rather than a window: the
    aggregate combines before its shuffle, and the join lets Spark split a hot
    group, whereas a window would put the whole group into one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    present = df.dropna(subset=by) if by else df
    stats = grouped(present, by, {} if fn == MEDIAN else {name: stat(fn, target)}, {name: target} if fn == MEDIAN else None)
    return attach(df, stats, by) if merge else stats


@dataclass(frozen=True)
class Slice:
    """A named subset of the child rows and the features wanted from it.

    ``extra`` holds further aggregates under their final names.
    """

    prefix: str
    where: Column | None
    spec: Spec = field(default_factory=list)
    extra: dict[str, Column] = field(default_factory=dict)


def aggregate_slices(child: DataFrame, key: str, slices: Sequence[Slice], without: Collection[str] = (), heavy: DataFrame | None = None) -> DataFrame:
    """All slices of a child table in one scan; one wide row per key.

    Features named in ``without`` are left out before anything is computed: Catalyst cannot prune them later,
    as the results of a key pass through one map.

    The rows of a key are first brought together by a rebalancing shuffle of the
    narrow rows.  Each row is then tagged with the slices it falls into, the tags
    are exploded, and a partial aggregate on (key, slice) runs on the spot; a
    wide partial result leaves a task once per key and slice, not once per row.
    Rebalancing goes by a hash of the key, which the aggregate does not take for
    its own partitioning, so adaptive execution may split the partition of a hot
    key over many tasks and their partial results still meet in the next shuffle.

    A second groupBy on the key packs the at most ``len(slices)`` results of a
    key into a map; its shuffle also places the result for the join on the key.
    A key outside a slice has NULL there.

    With ``heavy``, the keys of very many rows (see ``heavy_keys``), only their rows go that way.  Those of all other
    keys are brought together by the key itself, and nothing wide is moved.
    """
    slices = [_pruned(s, without) for s in slices]
    slices = [s for s in slices if s.spec or s.extra]
    wanted: dict[tuple | str, Column | None] = {}
    for s in slices:
        wanted |= {(c, fn): None for c, fn in s.spec} | s.extra
    position = {feature: f"f{j}" for j, feature in enumerate(wanted)}

    tags = F.array_compact(
        F.array(*[F.when(_holds(s), F.lit(i)).cast("int") for i, s in enumerate(slices)])
    )
    coded, bits = _with_bits(child, dict.fromkeys(f[0] for f in wanted if isinstance(f, tuple) and f[1] == "nunique"))
    kept = coded.where(named(key).isNotNull())
    exprs, medians = {}, {}
    for feature, column in wanted.items():
        if column is not None:
            exprs[position[feature]] = column
        elif feature[1] == MEDIAN:
            medians[position[feature]] = feature[0]
        elif feature[1] == "nunique" and feature[0] in bits:
            exprs[position[feature]] = _bits_set(bits[feature[0]])
        else:
            exprs[position[feature]] = stat(feature[1], feature[0])

    def packed(near: DataFrame) -> DataFrame:
        stats = grouped(near.withColumn("_slice", F.explode(tags)), [key, "_slice"], exprs, medians)
        return stats.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("_slice", F.struct(*position.values())))).alias("_all"))

    def rebalanced(rows: DataFrame) -> DataFrame:
        return packed(rows.withColumn("_place", F.xxhash64(named(key))).hint("rebalance", F.col("_place")))

    if heavy is None:
        whole = rebalanced(kept)
    elif heavy.isEmpty():
        whole = packed(kept.repartition(named(key)))
    else:
        light = kept.join(F.broadcast(heavy), [key], "left_anti").repartition(named(key))
        whole = packed(light).unionByName(rebalanced(kept.join(F.broadcast(heavy), [key], "left_semi")))
    wide = whole.selectExpr(quoted(key), *[f"try_element_at(_all, {i}) as _s{i}" for i in range(len(slices))])
    # plain text keeps building several hundred columns cheap
    out = [quoted(key)]
    for i, s in enumerate(slices):
        names = {(c, fn): feature_name(s.prefix, fn, c) for c, fn in s.spec} | {e: e for e in s.extra}
        out += [f"_s{i}.{position[f]} as {quoted(name)}" for f, name in names.items()]
    return wide.selectExpr(*out)


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """The keys with more than ``HEAVY_ROWS`` rows, computed; fewer than a millionth of the rows."""
    sizes = rows.where(named(key).isNotNull()).groupBy(named(key)).agg(F.count(F.lit(1)).alias("_n"))
    return computed(sizes.where(F.col("_n") > HEAVY_ROWS).select(named(key)))


def _with_bits(child: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, dict[str, list[str]]]:
    """The child with a bit for each row's value of the given columns, in as many numbers as there are values for.

    Bits merge like sums, so a distinct count needs no partial result for each value.  The values of a column are
    coded first; one with more than ``BIT_VALUES`` is left to Spark's distinct aggregate.
    """
    bits: dict[str, list[str]] = {}
    for i, c in enumerate(columns):
        values = computed(child.select(named(c).alias("_v")).where("_v IS NOT NULL").distinct())
        n = values.limit(BIT_VALUES + 1).count()
        if n > BIT_VALUES:
            continue
        code = F.row_number().over(Window.orderBy("_v")) - 1  # BIT_VALUES rows at most
        words = -(-n // BITS)
        coded = values.withColumn("_c", code).select(F.col("_v").alias(f"_v{i}"), *[
            F.when(F.floor(F.col("_c") / BITS) == w, F.expr(f"shiftleft(1L, cast(_c % {BITS} as int))")).alias(f"_b{i}_{w}") for w in range(words)
        ])
        child = child.join(F.broadcast(coded), named(c) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
        bits[c] = [f"_b{i}_{w}" for w in range(words)]
    return child, bits


def _bits_set(names: Sequence[str]) -> Column:
    total = F.lit(0).cast("long")
    for b in names:
        total = total + F.coalesce(F.bit_count(F.bit_or(b)).cast("long"), F.lit(0))
    return total


def aggregate_slices_by_join(child: DataFrame, base: DataFrame, key: str, slices: Sequence[Slice]) -> DataFrame:
    """The same features with one filter, groupBy and left join per slice.

    Reads the child once per slice; kept for a few slices on a small child and
    as the cross-check of :func:`aggregate_slices`.
    """
    out = base
    for s in slices:
        rows = child if s.where is None else child.where(s.where)
        out = attach(out, aggregate(rows, key, s.spec, s.prefix), key)
    return out


def _pruned(s: Slice, without: Collection[str]) -> Slice:
    spec = [(c, fn) for c, fn in s.spec if feature_name(s.prefix, fn, c) not in without]
    return replace(s, spec=spec, extra={n: c for n, c in s.extra.items() if n not in without})


def _holds(s: Slice) -> Column:
    return F.lit(True) if s.where is None else s.where

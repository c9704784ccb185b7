"""From a feature table to a table of vectors."""

from __future__ import annotations

import copy
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskloom.functions import named, quoted
from riskloom.operators.joins import attach_small
from riskloom.session import computed

# Trees send missing values to one side of a split: below every real value.
MISSING = -1.7e308
# A text column of up to this many values is split by sets of values, a wider one by ranges of its codes, as a learner keeps
# statistics for each value of the former in every node.  The codes are the same either way.
CATEGORY_VALUES = 1000


def value_codes(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place, value, code) of all values of text columns without nulls; ``place`` is the column's in ``columns``.

    Codes count from 0, the most frequent value first, equally frequent ones in the order of the text: a dense rank of any
    width.  Values are counted, cut into ranges in that order, and ranked inside each range; the sizes of the ranges
    before, one row for each range and column, are added.
    """
    values = F.array(*[F.struct(F.lit(i).alias("place"), named(c).alias("value")) for i, c in enumerate(columns)])
    counts = computed(table.select(F.explode(values).alias("x")).select("x.*").groupBy("place", "value").agg(F.count("*").alias("n")))
    order = [F.desc("n"), "value"]
    ranged = computed(counts.repartitionByRange("place", *order).withColumn("range", F.spark_partition_id()))
    before = Window.partitionBy("place").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("place", "range").agg(F.count("*").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    inside = F.row_number().over(Window.partitionBy("place", "range").orderBy(*order)) - 1
    coded = ranged.withColumn("inside", inside).join(F.broadcast(sizes), ["place", "range"])
    return coded.select("place", "value", (F.col("inside") + F.col("before")).cast("double").alias("code"))


class Prepared:
    """A computed table of ``key``, ``label``, further columns and numeric inputs.

    Text is coded over labelled and unlabelled rows together, so both get the same codes; missing text is a
    value of its own, apart from empty text.
    """

    def __init__(self, df: DataFrame, key: str, label: str, keep: Sequence[str] = (), drop: Sequence[str] = (), category_values: int = CATEGORY_VALUES):
        self.key, self.label = key, label
        held = [key, label, *keep]
        inputs = [c for c in df.columns if c not in held and c not in drop]
        texts = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.name in inputs]
        self.features = sorted(inputs)
        self._names = {c: f"x{i}" for i, c in enumerate(self.features)}

        codes = {c: f"c{i}" for i, c in enumerate(texts)}
        numbers = [
            f"coalesce(cast({quoted(c)} as double), {MISSING}d) as {self._names[c]}"
            for c in self.features
            if c not in codes
        ]
        # A letter in front keeps empty text apart from missing text.
        categories = [f"coalesce(concat('=', {quoted(c)}), '') as {codes[c]}" for c in texts]
        table = df.selectExpr(*[quoted(c) for c in held], *categories, *numbers)
        self.bins, self._values = 32, {}
        if texts:
            table = computed(table)  # the plan above may be long and is read several times from here on
            found = computed(value_codes(table, list(codes.values())))
            widths = {r["place"]: r["count"] for r in found.groupBy("place").count().collect()}  # one row a column
            for i, c in enumerate(texts):
                lookup = found.where(F.col("place") == i).select(F.col("value").alias(codes[c]), F.col("code").alias(self._names[c]))
                table = attach_small(table, lookup, codes[c], "inner")
                if 0 < widths.get(i, 0) <= category_values:
                    self._values[self._names[c]] = widths[i]
            self.bins = max(32, *self._values.values(), 0)
            table = table.drop(*codes.values())
        self.table = computed(table)

    def vectors(self, features: Sequence[str] | None = None) -> DataFrame:
        """The table with the given features (default: all) assembled into ``features``."""
        chosen = self.features if features is None else list(features)
        inputs = [self._names[c] for c in chosen]
        about = {x: {"ml_attr": {"type": "nominal", "num_vals": self._values[x]}} for x in inputs if x in self._values}
        table = self.table.select(*[F.col(f"`{c}`").alias(c, metadata=about[c]) if c in about else F.col(f"`{c}`") for c in self.table.columns])
        out = VectorAssembler(inputCols=inputs, outputCol="features").transform(table)
        return out.drop(*self._names.values())

    def labelled_by(self, label: str) -> Prepared:
        """The same table with another of its kept columns as the label."""
        out = copy.copy(self)
        out.label = label
        return out

    def with_table(self, table: DataFrame) -> Prepared:
        """Other rows of the same table, such as some of them."""
        out = copy.copy(self)
        out.table = table
        return out

    def columns(self) -> DataFrame:
        """The table with its inputs under their own names."""
        return self.table.withColumnsRenamed({x: c for c, x in self._names.items()})

"""License scan by diagonal voting, in DataFrame functions only.

Every pair of neighbouring words of every text is hashed; the hashes are joined to the places of the same pairs in the
templates; a match votes for its diagonal (place in the text less place in the template).  Votes are counted per text,
template and diagonal, neighbouring diagonals are merged (a few inserted or missing words move the rest to the next
diagonals), and a merged span is verified by its best stretch of limited length: that must hold enough *different* pairs of
the template, and those that tell it from its neighbours (``tell``).  So words that are said again count once, and what stands
close behind a notice does no harm.

* A null or empty text has no words, no places and score 0.
* Rows are told apart by their place in the table, so repeated rows and rows without id each give their own result.
* The templates are a fixed list, so the broadcast side of the join does not grow with the data.
* ``score`` is the largest share of a template's different pairs found in a stretch, 1 for a full match.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Merged diagonals lie this close; a verified span has this share of the pairs and is at most this much longer.
SLACK, SHARE, STRETCH = 3, 0.7, 1.5


@dataclass(frozen=True)
class Template:
    """A passage and its label.  ``phrase`` templates count only where all their words stand consecutively.

    ``tell`` are words of the passage without which it is not that passage.
    """

    label: str
    text: str
    phrase: bool = False
    tell: str = ""

    def telling(self) -> list[int]:
        """Places of the pairs of ``tell``."""
        own, wanted = self.text.split(), self.tell.split()
        at = next(i for i in range(len(own)) if own[i : i + len(wanted)] == wanted)
        return list(range(at, at + len(wanted) - 1))


BASE = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
)
#: Notices in common use, worded as their licenses advise (fixed values).
MORE = (
    Template("mit", "released under the mit license", tell="mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", tell="hereby granted free of charge"),
    Template("apache-2.0", "licensed under the apache license version 2 0", tell="apache license"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", tell="source and binary forms"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", tell="gnu general public license"),
    Template("lgpl", "gnu lesser general public license", tell="lesser general public"),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", tell="mozilla public license"),
    Template("cc-by-nc", "licensed under cc by nc", tell="by nc"),
    Template("cc-by-sa", "licensed under cc by sa", tell="by sa"),
    Template("cc-by", "this work is licensed under a creative commons attribution license", tell="creative commons attribution"),
    Template("cc0", "cc0 1 0 universal public domain dedication", tell="public domain dedication"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", tell="free and unencumbered software"),
)
TEMPLATES = BASE + MORE


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, GAPS), "")


def _pairs(of: Column) -> Column:
    """Hashes of neighbouring words, one less than there are words."""
    n = F.size(of)
    both = F.zip_with(of, F.slice(of, F.lit(2), n), lambda a, b: F.xxhash64(a, b))
    return F.slice(both, F.lit(1), F.greatest(n - 1, F.lit(0)))


def _places(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """A row for each pair of each template."""
    listed = F.array(*[F.struct(F.lit(n).alias("_template"), F.lit(t.text).alias("t")) for n, t in enumerate(templates)])
    each = spark.range(1).select(F.inline(listed))
    return each.select("_template", F.posexplode(_pairs(words(F.col("t")))).alias("_there", "_pair"))


def license_scan(docs: DataFrame, keys: list[str], text: str = "text", templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row for each row of ``docs``: its ``keys``, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    spark = docs.sparkSession
    kept = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    row = ["_row", "_words", *[f"_key{i}" for i in range(len(keys))]]
    split = docs.select(F.monotonically_increasing_id().alias("_row"), *kept, words(F.col(f"`{text}`")).alias("_list"))
    # The last element stands for the text itself, so that texts without a match keep a row.
    hashed = split.select(*[c for c in row if c != "_words"], F.size("_list").alias("_words"), F.concat(_pairs(F.col("_list")), F.array(F.lit(0).cast("long"))).alias("_pairs"))
    each = hashed.select(*row, F.posexplode("_pairs").alias("_here", "_pair"))
    end = spark.range(1).select(F.lit(-1).alias("_template"), F.lit(0).alias("_there"), F.lit(0).cast("long").alias("_pair"))
    votes = each.join(F.broadcast(_places(spark, templates).unionByName(end)), "_pair")
    votes = votes.where((F.col("_template") >= 0) | (F.col("_here") >= F.col("_words") - 1))

    diagonals = votes.groupBy(*row, "_template", (F.col("_here") - F.col("_there")).alias("_diagonal")).agg(F.collect_list("_here").alias("_at"))
    along = Window.partitionBy(*row, "_template").orderBy("_diagonal")
    apart = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(along) > _of(templates, "_template", lambda t: 0 if t.phrase else SLACK), F.lit(True))
    merged = (
        diagonals.withColumn("_new", apart.cast("int"))
        .withColumn("_span", F.sum("_new").over(along))
        .groupBy(*row, "_template", "_span")
        .agg(F.flatten(F.collect_list(F.transform("_at", lambda x: F.struct(x.alias("here"), (x - F.col("_diagonal")).alias("there"))))).alias("_votes"), F.min("_diagonal").alias("_begin"))
        .withColumn("_at", F.array_distinct(F.transform("_votes", lambda x: x.here)))
    )
    pairs = _of(templates, "_template", lambda t: len(t.text.split()) - 1)
    phrase = _of(templates, "_template", lambda t: int(t.phrase)) == 1
    merged = merged.withColumn("_best", F.when(phrase | (F.col("_template") < 0), F.array().cast("array<struct<places:int,tells:boolean>>")).otherwise(_stretches(templates, pairs)))
    share = F.when(phrase, F.size("_at") / pairs).otherwise(F.coalesce(F.array_max(F.transform("_best", lambda x: x.places)), F.lit(0)) / pairs)
    told = F.exists("_best", lambda x: x.tells & (x.places / pairs >= SHARE))
    verified = (F.col("_template") >= 0) & F.when(phrase, F.size("_at") == pairs).otherwise(told)
    place = F.when(verified & phrase, F.col("_begin").cast("long"))
    label = F.when(verified, _of(templates, "_template", lambda t: t.label))
    spans = merged.select(*row, place.alias("_place"), label.alias("_label"), F.when(F.col("_template") >= 0, share).otherwise(0.0).alias("_share"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    found = spans.groupBy(*row).agg(
        F.count("_place").alias("n_base"),
        F.min("_place").alias("first_word"),
        F.max("_place").alias("last_word"),
        joined(F.when(F.col("_place").isNotNull(), F.col("_label"))).alias("base_labels"),
        joined(F.col("_label")).alias("labels"),
        F.max("_share").alias("score"),
    )
    return found.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], F.col("_words").cast("long").alias("n_words"), "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def _stretches(templates: tuple[Template, ...], pairs: Column) -> Column:
    """For the stretch of the allowed length from each vote on: how many different places of the template it has, and
    whether the telling ones are among them."""

    def most_votes(t: Template) -> int:
        listed = t.text.split()
        return int(STRETCH * (len(listed) - 1)) * max(Counter(zip(listed, listed[1:])).values())

    votes, most = F.array_sort("_votes"), _of(templates, "_template", most_votes)
    telling = _of(templates, "_template", lambda t: [] if t.phrase else t.telling(), "array<int>")

    def stretch(of: Column) -> Column:
        near = F.transform(F.filter(of, lambda x: x.here - of[0].here + 1 <= STRETCH * pairs), lambda x: x.there)
        return F.struct(F.size(F.array_distinct(near)).alias("places"), (F.size(F.array_except(telling, near)) == 0).alias("tells"))

    # The array of one keeps the votes from being sorted again for each stretch.
    return F.flatten(F.transform(F.array(votes), lambda v: F.transform(F.sequence(F.lit(1), F.size(v)), lambda i: stretch(F.slice(v, i, most)))))


def _of(templates: tuple[Template, ...], number: str, value, kind: str = "") -> Column:
    """A value of the template with that number; of the row that stands for the text itself, that of the first."""
    listed = F.array(*[F.lit(value(t)) for t in templates])
    return F.element_at(listed.cast(f"array<{kind}>") if kind else listed, F.greatest(F.col(number), F.lit(0)) + 1)

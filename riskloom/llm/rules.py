"""Quality rules whose cutoffs are chosen so that few good documents fall, in DataFrame functions only.

A rule gives every text a whole number that is larger the worse the text looks; a rule rejects texts above its cutoff.
For each stratum and rule, the holdout is the labelled good documents that pass the base rules.  A cutoff is safe if so few
of them lie above it that a true share of more than the rule's part of ``risk`` would give that few only with a probability
(exact binomial) of at most ``error`` divided by the number of rules and strata.  Each rule has an equal part of ``risk``.
Cutoffs are tried from lenient to strict up to the first that is not safe, and the strictest safe one is used.  So with
probability 1 - ``error`` all rules together reject at most ``risk`` of the good documents of every stratum.  A rule
without a safe cutoff rejects nothing there.

* A null or empty text has no words and fails the base rules.
* A missing stratum value is a stratum of its own, named by the empty text.
* Rows without id have no label but are judged like others; several labels of one id count once, good if any is good.
* Repeated rows get equal results; a labelled id that stands in several rows counts with each of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, WORD
from riskloom.operators.joins import attach_small
from riskloom.session import computed

#: The share of a stratum's good documents that all rules together may reject, and the probability that it is exceeded anywhere.
RISK, ERROR = 0.05, 0.05
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"
#: For each rule the cutoffs to try, strict first.  Values are thousandths; of "short", 1000 / words; of "long_words", letters.
CUTOFFS = {
    "symbols": (0, 1, 2, 5, 10, 15, 20, 30, 50, 80, 120, 200),
    "dup_lines": (0, 20, 50, 100, 150, 200, 300, 400, 500),
    "repeated": (0, 10, 20, 30, 50, 80, 120, 160, 200, 250),
    "long_words": (5000, 5500, 6000, 6500, 7000, 7500, 8000, 9000, 10000, 12000),
    "short": (5, 8, 10, 12, 15, 20, 25, 30, 40),
}


def features(text: Column) -> dict[str, Column]:
    """Word and line counts that need one look at the text each."""
    words = F.array_remove(F.split(text, f"[{SPACE}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {"_words": words, "_lines": F.size(lines), "_dup_lines": F.size(lines) - F.size(F.array_distinct(lines))}


def _windows(words: Column) -> Column:
    """Hash of every run of eight words, by joining runs of one, two and four."""
    n = F.size(words)
    runs = words
    for reach in (1, 2, 4):
        runs = F.zip_with(runs, F.slice(runs, F.lit(reach + 1), n), lambda a, b: F.xxhash64(a, b))
    return F.slice(runs, F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))


def _covered(starts: Column) -> Column:
    """Words in windows with these sorted starts."""
    first = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("sum"))
    step = F.aggregate(starts, first, lambda acc, x: F.struct(x.alias("last"), (acc.sum + F.least(x - acc.last, F.lit(WINDOW))).alias("sum")))
    return step.sum


def measured(docs: DataFrame, keys: list[str], text: str = "text", stratum: str = "lang") -> DataFrame:
    """The base counts of every row, its stratum and its keys (as ``_key0`` ...)."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kept = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    names = [f"_key{i}" for i in range(len(keys))]
    first = docs.select(
        *kept,
        F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")).alias("_stratum"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).alias("_symbols"),
        *[c.alias(name) for name, c in features(whole).items()],
    )
    hashed = first.withColumn("_runs", _windows(F.col("_words"))).withColumn("_chars", F.length(F.array_join("_words", ""))).withColumn("_n", F.size("_words")).drop("_words")
    # Only texts in which some window occurs twice have their windows sorted.
    twice = F.size(F.array_distinct("_runs")) < F.size("_runs")
    pairs = F.when(twice, F.sort_array(F.transform("_runs", lambda x, i: F.struct(x.alias("run"), i.alias("at")))))
    ordered = hashed.withColumn("_pairs", pairs).drop("_runs")
    same = F.transform(
        F.col("_pairs"),
        lambda x, i: F.when((F.get("_pairs", i - 1).run == x.run) | (F.get("_pairs", i + 1).run == x.run), x["at"]),
    )
    found = ordered.withColumn("_starts", F.when(F.col("_pairs").isNotNull(), F.sort_array(F.array_compact(same))))
    return found.select(
        *names, "_stratum", F.col("_n").cast("long"), F.col("_chars").cast("long"), F.col("_symbols").cast("long"),
        F.col("_lines").cast("long"), F.col("_dup_lines").cast("long"),
        F.coalesce(F.when(F.col("_starts").isNotNull(), _covered(F.col("_starts"))), F.lit(0)).cast("long").alias("_repeated"),
    )


def base_failed() -> Column:
    return (F.col("_n") < LEAST_WORDS) | (100 * F.col("_repeated") > MOST_REPEATED * F.col("_n"))


def values() -> dict[str, Column]:
    def per(a: Column, b: Column) -> Column:
        return F.floor(a * 1000 / F.greatest(b, F.lit(1)))

    n = F.col("_n")
    return {
        "symbols": per(F.col("_symbols"), F.col("_chars")),
        "dup_lines": per(F.col("_dup_lines"), F.col("_lines")),
        "repeated": per(F.col("_repeated"), n),
        "long_words": per(F.col("_chars"), n),
        "short": per(F.lit(1), n),
    }


def binomial_tail(most: Column, trials: Column, share: float) -> Column:
    """Probability of at most ``most`` hits in that many trials, summed term by term in logarithms."""
    first = trials * F.log(F.lit(1 - share))
    begin = F.struct(first.alias("term"), first.alias("sum"))

    def add(acc: Column, i: Column) -> Column:
        term = acc.term + F.log((trials - i + 1) / i) + F.log(F.lit(share / (1 - share)))
        high = F.greatest(acc["sum"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc["sum"] - high) + F.exp(term - high))).alias("sum"))

    steps = F.when(most > 0, F.sequence(F.lit(1).cast("long"), most)).otherwise(F.array().cast("array<long>"))
    return F.exp(F.aggregate(steps, begin, add)["sum"])


def cutoffs(holdout: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """For each stratum the strictest safe cutoff of each rule, NULL where there is none."""
    value, part = values(), risk / len(CUTOFFS)
    tests = [(rule, c) for rule, cs in CUTOFFS.items() for c in cs]
    counted = holdout.groupBy("_stratum").agg(F.count("*").alias("good"), *[F.count_if(value[rule] > c).alias(f"t{i}") for i, (rule, c) in enumerate(tests)])
    strata = holdout.agg(F.count_distinct("_stratum")).first()[0]
    listed = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"t{i}").alias("lost")) for i, (rule, c) in enumerate(tests)])
    each = counted.select("_stratum", "good", F.inline(listed)).where(F.col("lost") < part * F.col("good"))
    safe = each.where(binomial_tail(F.col("lost"), F.col("good"), part) <= error / (len(CUTOFFS) * max(strata, 1)))
    return safe.groupBy("_stratum").agg(*[F.min(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_cut_{rule}") for rule in CUTOFFS])


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", stratum: str = "lang", risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Key, base counts, ``base_failed`` and ``kept`` of every row of ``docs``."""
    counts = computed(measured(docs, [key], text, stratum))
    good = labels.groupBy(F.col(key).alias("_key0")).agg(F.max("quality").alias("_quality")).where(F.col("_quality") == 1).select("_key0")
    safe = cutoffs(counts.join(good, "_key0", "left_semi").where(~base_failed()), risk, error)
    judged = attach_small(counts, safe, "_stratum")
    rejected = reduce(Column.__or__, [F.coalesce(v > F.col(f"_cut_{rule}"), F.lit(False)) for rule, v in values().items()])
    return judged.select(
        F.col("_key0").alias(key),
        F.col("_n").alias("n_words"),
        F.col("_chars").alias("word_chars"),
        F.col("_symbols").alias("n_symbols"),
        F.col("_dup_lines").alias("n_dup_lines"),
        F.col("_repeated").alias("n_repeat_words"),
        base_failed().alias("base_failed"),
        (~base_failed() & ~rejected).alias("kept"),
    )

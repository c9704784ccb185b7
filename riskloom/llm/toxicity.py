"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Learning: n-grams of the labelled texts are hashed to buckets; Spark counts in how many toxic and other texts each
bucket occurs; the buckets that tell the classes apart best (chi-square) become features.  A feature's value in a text
is the log ratio of its smoothed class frequencies if the text has it, else 0.  Logistic regression on these values is
fitted on the driver.  ``rows`` bounds the labelled texts used, chosen by a hash of id and text; ``features`` bounds the model (n-grams in fewer than five texts are left out).

* Null and empty texts have no n-grams and get the score of the bias alone.
* Rows without id are scored, but have no label to learn from.  Rows that share id and text count once for each label that differs.
* With no labelled rows of both classes every score is the smoothed share of toxic labels (0.5 without labels).
* Texts are read whole; repeated rows get equal scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import mixed, slices, whole
from riskloom.llm.linear import fit, sigmoid
from riskloom.session import computed

GRAMS = (4, 5, 6)
BITS = 20
TRAIN_ROWS, FEATURES, LEAST, SMOOTH, L2 = 20_000, 1024, 5, 1.0, 3.0


def plain(text: str | None) -> bytes:
    return (" " + " ".join((text or "").lower().split()) + " ").encode()


def buckets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, bucket) for every n-gram of every text."""
    sizes = np.array([len(x) for x in texts], np.int64)
    raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    to_end = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    value = np.zeros(len(raw), np.uint64)
    rows, found = [], []
    for n in range(1, max(GRAMS) + 1):
        if n > len(raw):
            break
        value[: len(raw) - n + 1] = value[: len(raw) - n + 1] * np.uint64(257) + raw[n - 1 :] + np.uint64(1)
        if n in GRAMS:
            inside = np.flatnonzero(to_end >= n)
            rows.append(owner[inside])
            found.append((mixed(value[inside] + np.uint64(n << 56)) >> np.uint64(64 - BITS)).astype(np.int32))
    return (np.concatenate(rows), np.concatenate(found)) if rows else (np.zeros(0, np.int32), np.zeros(0, np.int32))


def present(texts: list[bytes], slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text number, feature) pairs."""
    row, bucket = buckets(texts)
    feature = slot[bucket]
    hit = feature >= 0
    width = int(slot.max()) + 1 if len(slot) else 0
    pair = np.unique(row[hit].astype(np.int64) * max(width, 1) + feature[hit])
    return pair // max(width, 1), pair % max(width, 1)


@dataclass
class Model:
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def slots(self) -> np.ndarray:
        out = np.full(1 << BITS, -1, np.int32)
        out[self.buckets] = np.arange(len(self.buckets))
        return out


def learned_from(doc_id: Column) -> Column:
    """Rows of two of three folds; the third is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 != 1, F.lit(False))


def _labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    labelled = (
        labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(learned_from(F.col("_id")) & F.col("_label").isin(0, 1))
        .distinct()
    )
    texts = docs.select(F.col("doc_id").alias("_id"), F.unhex(F.md5(whole().cast("binary"))).alias("_node"), F.col("text").alias("_text"))
    picked = texts.select("_id", "_node").distinct().join(labelled, "_id").orderBy(F.xxhash64("_id", "_node"), "_id", "_node", "_label").limit(rows)
    sample = texts.join(F.broadcast(computed(picked)), ["_id", "_node"])  # no more than ``rows`` narrow rows
    return computed(sample.groupBy("_id", "_node", "_label").agg(F.max("_text").alias("_text")))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS, features: int = FEATURES) -> Model:
    sample = _labelled(docs, labels, label, rows)
    total = {r["_label"]: r["n"] for r in sample.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    bad, good = total.get(1, 0), total.get(0, 0)
    bias = float(np.log((bad + 1) / (good + 1)))
    if not bad or not good:
        return Model(np.zeros(0, np.int32), np.zeros(0), bias)

    def counts(batches):
        for batch in batches:
            texts, toxic = [plain(x) for x in batch["_text"]], batch["_label"].to_numpy()
            for a, b in slices(texts):
                row, bucket = buckets(texts[a:b])
                pair = np.unique(row.astype(np.int64) << BITS | bucket)
                one = toxic[a:b][pair >> BITS] == 1
                of = pair & ((1 << BITS) - 1)
                has, n_bad = np.unique(of, return_counts=False), np.bincount(of, one, 1 << BITS)
                n_all = np.bincount(of, minlength=1 << BITS)
                yield pd.DataFrame({"bucket": has.astype(np.int32), "bad": n_bad[has].astype(np.int64), "good": (n_all - n_bad)[has].astype(np.int64)})

    count = sample.mapInPandas(counts, "bucket int, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    both = F.col("bad") + F.col("good")
    gap = F.col("bad") * (good) - F.col("good") * bad
    odds = gap.cast("double") * gap / (both * (bad + good - both) + 1.0)
    best = count.where(both >= LEAST).orderBy(odds.desc(), "bucket").limit(features).collect()
    best = sorted(best, key=lambda r: r["bucket"])
    chosen = np.array([r["bucket"] for r in best], np.int32)
    log_ratio = np.log([(r["bad"] + SMOOTH) / (bad + 2 * SMOOTH) for r in best]) - np.log([(r["good"] + SMOOTH) / (good + 2 * SMOOTH) for r in best])
    slot = sample.sparkSession.sparkContext.broadcast(Model(chosen, log_ratio, 0.0).slots())

    def rows_of(batches):
        for batch in batches:
            texts = [plain(x) for x in batch["_text"]]
            for a, b in slices(texts):
                row, feature = present(texts[a:b], slot.value)
                cut = np.searchsorted(row, np.arange(1, b - a))
                yield pd.DataFrame({"id": batch["_id"].astype(str).to_numpy()[a:b], "label": batch["_label"].to_numpy()[a:b], "has": np.split(feature.astype(np.int32), cut)})

    data = sorted(sample.mapInPandas(rows_of, "id string, label int, has array<int>").collect(), key=lambda r: (r["id"], r["label"], r["has"]))
    column = np.concatenate([np.array(r["has"], np.int64) for r in data])
    row = np.repeat(np.arange(len(data)), [len(r["has"]) for r in data])
    target = np.array([r["label"] for r in data], float)
    weights, bias = fit(row, column, log_ratio[column], target, len(chosen), L2)
    return Model(chosen, weights * log_ratio, bias)


def score(spark: SparkSession, text: Column, model: Model) -> Column:
    """Probability that a text is toxic."""
    shared = spark.sparkContext.broadcast((model.slots(), model.weights, model.bias))

    def scores(texts: pd.Series) -> pd.Series:
        slot, weights, bias = shared.value
        values, out = [plain(x) for x in texts], []
        for a, b in slices(values):
            row, feature = present(values[a:b], slot)
            out.append(np.bincount(row, weights[feature], minlength=b - a) if len(weights) else np.zeros(b - a))
        z = np.concatenate(out) + bias if out else np.zeros(0)
        return pd.Series(sigmoid(z))

    return F.pandas_udf(scores, "double")(F.coalesce(text, F.lit("")))

"""Quality scores learned from heuristic labellers that overlap and disagree, without a label.

Eight labellers vote good, bad or abstain on every text.  Spark counts how often each combination of votes occurs (3 ** 8 at
most), and expectation-maximisation on these counts estimates the share of good texts and how each labeller votes on
good and on bad ones; each combination's posterior follows.  The posteriors of a sample of ``rows`` texts, chosen by a
hash of id and text, train a logistic regression on hashed features: words, word shapes, and words that repeat the one
before.  The scorer sees every text whole, also where labellers abstain.

* Null and empty texts have no features; their votes are those of a text without words, and their score is the bias's.
* Rows without id, repeated rows and extra columns change nothing for others; repeated rows get equal scores.
* Texts that share an id are told apart, each with its own votes; rows that share id and text are learned from once.
* On an empty table nothing is learned, and the model scores 0.5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import Words, mixed, slices
from riskloom.llm.linear import fit, sigmoid
from riskloom.session import computed

TRAIN_ROWS, BITS, L2, ROUNDS = 4_000, 15, 2.0, 200
#: Labellers: a signal, the range in which it votes good, the range outside which it votes bad (fixed values).
LABELLERS = {
    "words": ((50, np.inf), (20, np.inf)),
    "distinct": ((0.35, 1.0), (0.2, 1.0)),
    "repeats": ((0.0, 0.03), (0.0, 0.15)),
    "symbols": ((0.0, 0.001), (0.0, 0.02)),
    "letters": ((3.5, 7.5), (2.5, 11.0)),
    "dup_lines": ((0.0, 0.05), (0.0, 0.3)),
    "stops": ((0.02, 0.35), (0.004, 0.6)),
    "digits": ((0.0, 0.02), (0.0, 0.15)),
}
_SYMBOL, _STOP, _DIGIT, _UPPER, _HIGH = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>{}[]\\^~_=+@")] = True
_STOP[list(b".!?")] = True
_DIGIT[list(b"0123456789")] = True
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_HIGH[128:] = True


def _of_words(words: Words) -> dict[str, np.ndarray]:
    """Facts about each word."""
    raw = np.frombuffer(words.data, np.uint8)

    def inside(kind: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(kind[raw])))
        return sums[words.end] - sums[words.start]

    owner = words.owner()
    same = np.zeros(len(owner), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1])
    return {
        "owner": owner, "same": same, "size": words.end - words.start, "symbols": inside(_SYMBOL), "digits": inside(_DIGIT),
        "stop": _STOP[raw[words.end - 1]], "upper": _UPPER[raw[words.start]], "high": inside(_HIGH),
    }


def signals(texts: list[bytes]) -> dict[str, np.ndarray]:
    """What the labellers look at, for each text."""
    words = Words(texts)
    w = _of_words(words)
    n = np.maximum(words.count, 1)

    def per_text(x: np.ndarray) -> np.ndarray:
        return np.bincount(w["owner"], x, minlength=len(texts))

    pair = np.lexsort((words.hash, w["owner"]))
    fresh = np.ones(len(pair), bool)
    fresh[1:] = (words.hash[pair][1:] != words.hash[pair][:-1]) | (w["owner"][pair][1:] != w["owner"][pair][:-1])
    letters = np.maximum(per_text(w["size"]), 1)
    lines = [[y for y in x.split(b"\n") if y.strip()] for x in texts]
    return {
        "words": words.count.astype(float),
        # Long texts repeat words more; the square root makes lengths comparable.
        "distinct": np.minimum(np.bincount(w["owner"][pair], fresh, minlength=len(texts)) / n * np.sqrt(np.maximum(n, 100) / 100), 1.0),
        "repeats": per_text(w["same"]) / n,
        "symbols": per_text(w["symbols"]) / letters,
        "letters": (per_text(w["size"]) - per_text(w["high"]) / 2) / n,
        "dup_lines": np.array([1 - len(set(x)) / len(x) if x else 0.0 for x in lines]),
        "stops": per_text(w["stop"]) / n,
        "digits": per_text(w["digits"]) / letters,
    }


def votes(texts: list[bytes]) -> np.ndarray:
    """The combination of votes of each text as one number, a digit of base 3 for each labeller: 0 abstain, 1 good, 2 bad."""
    found, out = signals(texts), np.zeros(len(texts), np.int64)
    for name, (good, fair) in LABELLERS.items():
        x = found[name]
        vote = np.where((x >= good[0]) & (x <= good[1]), 1, np.where((x < fair[0]) | (x > fair[1]), 2, 0))
        out = out * 3 + vote
    return out


def posteriors(combination: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Probability that a text with these votes is good, by expectation-maximisation over the counts.

    It starts from the majority of votes, so that "good" is the class that the labellers call good on the whole.
    """
    k = len(LABELLERS)
    vote = combination[:, None] // 3 ** np.arange(k - 1, -1, -1) % 3
    ups, downs = (vote == 1).sum(axis=1), (vote == 2).sum(axis=1)
    good = (ups + 1) / (ups + 3 * downs + 2)  # a bad vote is rarer and weighs more
    for _ in range(ROUNDS):
        share = (good @ count + 1) / (count.sum() + 2)
        log_odds = np.full(len(count), np.log(share / (1 - share)))
        for j in range(k):
            for v in range(3):
                hit = vote[:, j] == v
                among_good = ((good * count)[hit].sum() + 1) / (good @ count + 3)
                among_bad = (((1 - good) * count)[hit].sum() + 1) / ((1 - good) @ count + 3)
                log_odds[hit] += np.log(among_good / among_bad)
        new = sigmoid(log_odds)
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return good


def entries(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, feature, value) of the hashed features of every text; a value is the root of the feature's share of words."""
    words = Words(texts)
    w = _of_words(words)
    shape = (
        np.minimum(w["size"], 15) + 16 * np.minimum(w["symbols"], 3) + 64 * np.minimum(w["digits"], 3) + 256 * w["stop"] + 512 * w["upper"] + 1024 * w["same"]
    ).astype(np.uint64)
    hashed = np.concatenate([words.hash, mixed(shape + np.uint64(1 << 40)), mixed(w["same"].astype(np.uint64) + np.uint64(1 << 41))])
    feature = (hashed >> np.uint64(64 - BITS)).astype(np.int64)
    key, many = np.unique(np.tile(w["owner"], 3) << BITS | feature, return_counts=True)
    row = key >> BITS
    return row, key & ((1 << BITS) - 1), np.sqrt(many / words.count[row])


def _bytes(values: pd.Series) -> list[bytes]:
    return [bytes(x) for x in values]


def voted(text: Column) -> Column:
    def of(values: pd.Series) -> pd.Series:
        texts = _bytes(values)
        parts = [votes(texts[a:b]) for a, b in slices(texts)]
        return pd.Series(np.concatenate(parts) if parts else [], dtype="int64")

    return F.pandas_udf(of, "long")(F.coalesce(text, F.lit("")).cast("binary"))


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Weights of the hashed features and the bias."""
    bytes_of = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    node = F.unhex(F.md5(bytes_of)).alias("node")
    seen = computed(docs.select(F.col(f"`{key}`").alias("id"), node, voted(F.col(f"`{text}`")).alias("votes")))
    counts = sorted((r["votes"], r["n"]) for r in seen.groupBy("votes").agg(F.count("*").alias("n")).collect())
    if not counts:
        return np.zeros(1 << BITS), 0.0
    combination, count = (np.array(x) for x in zip(*counts))
    good = dict(zip(combination.tolist(), posteriors(combination, count.astype(float)).tolist()))

    chosen = computed(seen.where(F.col("id").isNotNull()).dropDuplicates(["id", "node"]).orderBy(F.xxhash64("id", "node"), "id", "node").limit(rows))
    body = docs.select(F.col(f"`{key}`").alias("id"), node, bytes_of.alias("text"))
    sample = body.join(F.broadcast(chosen), ["id", "node"])  # ``rows`` narrow rows at most
    sample = sample.groupBy("id", "node").agg(F.max("votes").alias("votes"), F.max("text").alias("text"))

    def listed(batches):
        for batch in batches:
            texts = _bytes(batch["text"])
            for a, b in slices(texts):
                row, feature, value = entries(texts[a:b])
                cut = np.searchsorted(row, np.arange(1, b - a))
                yield pd.DataFrame({
                    "id": batch["id"].astype(str).to_numpy()[a:b], "votes": batch["votes"].to_numpy()[a:b],
                    "feature": np.split(feature.astype(np.int32), cut), "value": np.split(value.astype(np.float32), cut),
                })

    data = sorted(sample.mapInPandas(listed, "id string, votes long, feature array<int>, value array<float>").toLocalIterator(), key=lambda r: (r["id"], r["votes"]))
    if not data:
        return np.zeros(1 << BITS), 0.0
    row = np.repeat(np.arange(len(data)), [len(r["feature"]) for r in data])
    column = np.concatenate([np.array(r["feature"], np.int64) for r in data])
    value = np.concatenate([np.array(r["value"], float) for r in data])
    return fit(row, column, value, np.array([good[r["votes"]] for r in data]), 1 << BITS, L2)


def score(spark: SparkSession, text: Column, model: tuple[np.ndarray, float]) -> Column:
    """Probability that a text is good."""
    shared = spark.sparkContext.broadcast(model)

    def of(values: pd.Series) -> pd.Series:
        weights, bias = shared.value
        texts, out = _bytes(values), []
        for a, b in slices(texts):
            row, feature, value = entries(texts[a:b])
            out.append(np.bincount(row, value * weights[feature], minlength=b - a) + bias)
        return pd.Series(sigmoid(np.concatenate(out)) if out else [], dtype="float64")

    return F.pandas_udf(of, "double")(F.coalesce(text, F.lit("")).cast("binary"))

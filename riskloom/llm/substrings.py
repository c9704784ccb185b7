"""Removal of repeated passages through the de Bruijn graph of the corpus, compacted by Spark joins.

The edges of the graph are the runs of ``WINDOW`` = 20 words.  Writing one row for each would be far too much, so the
graph is compacted from the start, in the way large assemblies are: consecutive edges of a text whose smallest run of
``SEED`` words (by hash) is the same form one *piece*, about one for every seven words.  Equal edges have equal seeds, so

1. pieces whose seed occurs in one piece only cannot repeat; a count and a join drop them;
2. a seed all of whose pieces have the same words is a path without branches: the pieces stay compact, and all but the
   first are repeats from end to end;
3. only where the pieces of a seed differ (the graph branches: repeats begin or end there) or a piece repeats itself are
   its distinct pieces taken apart into edges, and each edge is joined to its first place in the corpus.

Every repeat carries its source coordinates (id and word number of the first place); they verify a repeat: a piece or
edge counts only if its source is a different, earlier place with the same seed and the same words, each by a hash of
64 bits.  Repeats are judged on the input, never on what others leave.

* A null or empty text has no words; a text of fewer than 20 words loses none.
* Places are ordered by id, then text, then word number; a missing id comes first.
* Rows that share both id and text are one document: each of them gets that document's result.
* Texts are read whole; a text repeated in a third of all rows costs rows in proportion, and its hot keys are joined
  by joins that Spark can split.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Words, gram_hashes, id_filter, mixed, powers, slices
from riskloom.session import computed

WINDOW, SEED = 20, 8
_BASE = 0xA0761D6478BD642F
_INVERSE = pow(_BASE, -1, 1 << 64)


class Runs:
    """Hashes of runs of words of any length, from running sums of the words' hashes."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(hashes * powers(_BASE, n)[:n])))
        self.back = powers(_INVERSE, n + 1)

    def hash(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def pieces(words: Words, window: int) -> dict[str, np.ndarray]:
    """Maximal runs of edges of one text with the same smallest seed.

    ``text`` is the text number, ``start`` the first edge's word number, ``edges`` their number; ``again`` tells that
    the seed occurs more than once in the piece, without which no edge can repeat inside it.
    """
    reach = window - SEED + 1
    grams = gram_hashes(words.hash, SEED)
    n = len(grams) - reach + 1
    owner = words.owner()
    if n <= 0:
        return {k: np.zeros(0, np.int64) for k in ("text", "start", "edges", "seed", "again", "words")}
    low, done = grams, 1
    while done < reach:
        step = min(done, reach - done)
        low = np.minimum(low[: len(low) - step], low[step:])
        done += step
    valid = owner[:n] == owner[window - 1 : window - 1 + n]
    fresh = np.append(True, (low[1:] != low[:-1]) | (owner[1:n] != owner[: n - 1]) | ~valid[:-1]) & valid
    starts = np.flatnonzero(fresh)
    inside = np.cumsum(fresh) - 1
    edges = np.bincount(inside[valid], minlength=len(starts)).astype(np.int64)
    seeds = low[starts]
    span = edges + reach - 1  # places where a seed of the piece can stand
    ends = np.cumsum(span)
    at = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - span, span) + np.repeat(starts, span)
    hits = np.add.reduceat(grams[at] == np.repeat(seeds, span), ends - span, dtype=np.int64) if len(ends) else np.zeros(0, np.int64)
    runs = Runs(words.hash)
    return {
        "text": owner[starts], "start": starts - words.first[owner[starts]], "edges": edges,
        "seed": seeds, "again": hits > 1, "words": runs.hash(starts, starts + edges + window - 1),
    }


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [x.as_py() for x in batch.column("text")]


def _rows(batch: pa.RecordBatch, who: list[str], which: np.ndarray, seed: np.ndarray, words: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    values = [pa.array(x.astype(np.int64, copy=False) if x.dtype != np.uint64 else x.view(np.int64)) for x in (seed, words, place)]
    return pa.RecordBatch.from_arrays([*values[:2], *[batch.column(c).take(pa.array(which)) for c in who], values[2]], names=["seed", "words", *who, "place"])


def _pieces_of(window: int, who: list[str]):
    def rows(batches):
        for batch in batches:
            texts = _texts(batch)
            for a, b in slices(texts):
                p = pieces(Words(texts[a:b]), window)
                yield _rows(batch, who, p["text"] + a, p["seed"], p["words"], p["start"] << 32 | p["edges"] << 1 | p["again"])

    return rows


def _edges_of(window: int, who: list[str]):
    """Single edges of the pieces that a text is to be taken apart at."""

    def rows(batches):
        for batch in batches:
            texts, at = _texts(batch), batch.column("at")
            for a, b in slices(texts):
                words = Words(texts[a:b])
                runs = Runs(words.hash)
                seeds, text, place = [], [], []
                for i in range(a, b):
                    for p in at[i].as_py():
                        n = p["place"] >> 1 & 0x7FFFFFFF
                        seeds.append(np.full(n, p["seed"]))
                        text.append(np.full(n, i))
                        place.append((p["place"] >> 32) + np.arange(n))
                seeds, text, place = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (seeds, text, place))
                begin = words.first[text - a] + place
                yield _rows(batch, who, text, seeds, runs.hash(begin, begin + window), place << 32 | 2)

    return rows


def _kept_of(window: int):
    def rows(batches):
        for batch in batches:
            spans, counts, lost, texts = batch.column("spans"), [], [], []
            for i, x in enumerate(_texts(batch)):
                words = x.split()
                counts.append(len(words))
                cut = np.zeros(len(words) + 1, np.int64)
                for p in spans[i].as_py() or ():
                    cut[p >> 32] += 1
                    cut[(p >> 32) + (p >> 1 & 0x7FFFFFFF) + window - 1] -= 1
                gone = np.cumsum(cut)[:-1] > 0
                lost.append(int(gone.sum()))
                texts.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if lost[-1] else words))
            kept = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()), pa.array(lost, pa.int64()), kept], names=["id", "n_words", "n_removed", "kept_text"])

    return rows


class Repeats:
    """The repeats of a table: ``spans`` with source coordinates, ``kept`` with what is left of every text."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW):
        self.window = window
        body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
        self.docs = docs.select(F.col(f"`{key}`").alias("id"), body.alias("text"))
        id_type = self.docs.schema["id"].dataType.simpleString()
        self.who = ["id"]
        if not self.docs.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            # Only ids that stand in several rows need the text to tell documents apart.
            self.docs = self.docs.withColumn("text_key", F.xxhash64("text"))
            self.who = ["id", "text_key"]
        self.id_type = id_type
        keys = f"id {id_type}" + ", text_key long" * (len(self.who) - 1)
        self.row = f"seed long, words long, {keys}, place long"

    def _with_text(self, about: DataFrame, how: str) -> DataFrame:
        """Join what is known of some texts to the texts that may have candidates.

        The join is always on the same keys, so that these texts move only once; others do not move.
        """
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.who])
        about = about.withColumnsRenamed({c: f"_{c}" for c in self.who})
        return self.docs.where(self.possible).join(about, same, how).drop(*[f"_{c}" for c in self.who])

    def candidates(self) -> DataFrame:
        """Pieces whose seed stands in more than one piece, or more than once in one."""
        every = self.docs.mapInArrow(_pieces_of(self.window, self.who), self.row)
        weight = F.col("place").bitwiseAND(F.lit(1)) + 1
        often = every.select("seed", weight.alias("w")).groupBy("seed").agg(F.sum("w").alias("w")).where("w > 1").select("seed")
        return computed(every.join(often, "seed"))

    def spans(self) -> DataFrame:
        """Repeated runs of edges: who, place and, as ``source``, the place of the first equal run."""
        found = self.candidates()
        self.possible = id_filter(found, self.who)
        own = F.struct(*self.who, "place")
        first = found.groupBy("seed", "words").agg(F.min(own).alias("source"), F.count("*").alias("n"))
        paths = self._repeats(found, first.where("n > 1"))
        branching = first.groupBy("seed").agg((F.count("*") + F.max(F.col("source.place").bitwiseAND(F.lit(1)))).alias("n")).where("n > 1").select("seed")
        apart = first.join(branching, "seed").select(*[f"source.{c}" for c in self.who], F.struct("seed", "source.place").alias("p"))
        at = apart.groupBy(*self.who).agg(F.collect_set("p").alias("at"))
        edges = self._with_text(at, "inner").mapInArrow(_edges_of(self.window, self.who), self.row)
        origin = edges.groupBy("seed", "words").agg(F.min(own).alias("source"), F.count("*").alias("n")).where("n > 1")
        return paths.unionByName(self._repeats(edges, origin))

    def _repeats(self, runs: DataFrame, first: DataFrame) -> DataFrame:
        """Runs with their first place, without the first ones themselves."""
        joined = runs.join(first.select("seed", "words", "source"), ["seed", "words"])
        here = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"source.{c}")) for c in [*self.who, "place"]])
        return joined.where(~here).select(*self.who, "place", "source")

    def kept(self) -> DataFrame:
        """id, n_words, n_removed and kept_text of every row."""
        # Rows that share id and text each tell the same places; a text has no more than its words.
        spans = self.spans().groupBy(*self.who).agg(F.collect_set("place").alias("spans"))
        touched = self._with_text(spans, "left").select("id", "text", "spans")
        rest = self.docs.where(~self.possible).select("id", "text", F.array().cast("array<long>").alias("spans"))
        return touched.unionByName(rest).mapInArrow(_kept_of(self.window), f"id {self.id_type}, n_words long, n_removed long, kept_text string")

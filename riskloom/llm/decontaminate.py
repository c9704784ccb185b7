"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping pieces of at most ``PIECE`` characters.  Text that equals a piece of m characters
but for k edits shares at least m + 1 - q (k + 1) of its q-grams with it, all on k + 1 neighbouring diagonals (place in
the text less place in the piece).  Every task looks up all q-grams of its texts, counts the distinct shared ones of
each piece in overlapping bands of 2 (k + 1) diagonals, keeps the bands that reach that number, and verifies the kept regions
by alignment inside the band.  Nothing is shuffled.

Texts and items are compared in lower case with every run of white space as one space; places are code points of that form.

* Null and empty texts and items match nothing, and so do items of fewer than ``Q`` characters.
* Rows are judged one by one: rows without id and repeated rows get their own results.  Repeated items each match, and an item
  without id is looked for as well: its rows have no item_id.
* Equal pieces of different items are one piece in the index.  Pieces are broadcast in blocks of a bounded number, one block at
  a time; a larger benchmark takes more passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.align import best_place
from riskloom.llm.common import slices
from riskloom.session import computed

Q, RATE, PIECE = 12, 0.06, 120
BLOCK_PIECES = 20_000
_TABLE_BITS = 22
_B = 0x9E3779B97F4A7C15


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(text: str | None) -> list[tuple[int, str]]:
    """Overlapping pieces (place, text) that cover an item; its last piece ends where it ends."""
    x = plain(text)
    if len(x) < Q:
        return []
    starts = [*range(0, max(len(x) - PIECE, 0), PIECE // 2), max(len(x) - PIECE, 0)]
    return [(s, x[s : s + PIECE]) for s in dict.fromkeys(starts)]


def budget(m: int) -> int:
    """Edits allowed in a piece of m characters; small enough for the lemma to ask for a shared q-gram."""
    return min(int(RATE * m), (m - Q) // Q)


def gram_codes(codes: np.ndarray) -> np.ndarray:
    """Hash of the q = 12 code points from each place on, from hashes of 2, 4 and 8."""
    b = np.uint64(_B)
    x = codes.astype(np.uint64)
    with np.errstate(over="ignore"):
        two = x[:-1] * b + x[1:]
        b2 = b * b
        four = two[:-2] * b2 + two[2:]
        b4 = b2 * b2
        eight = four[:-4] * b4 + four[4:]
        return eight[:-4] * b4 + four[8:]


def _slot(gram: np.ndarray) -> np.ndarray:
    return (gram * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - _TABLE_BITS)


@dataclass
class Index:
    """q-grams of the different pieces of one block; ``items`` has those that hold each piece."""

    items: list[list]
    texts: list[str]

    def arrays(self) -> dict:
        grams, piece, place = [], [], []
        for n, t in enumerate(self.texts):
            own = gram_codes(np.frombuffer(t.encode("utf-32-le"), np.uint32))
            grams.append(own)
            piece.append(np.full(len(own), n))
            place.append(np.arange(len(own)))
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        distinct, first, count = np.unique(grams[order], return_index=True, return_counts=True)
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[_slot(distinct)] = True
        long = np.array([len(t) for t in self.texts])
        most = np.array([budget(m) for m in long])
        return {
            "items": self.items, "texts": self.texts, "table": table, "distinct": distinct, "first": first, "count": count,
            "piece": np.concatenate(piece)[order], "place": np.concatenate(place)[order],
            "most": most, "least": long + 1 - Q * (most + 1),
        }


def regions(texts: list[str], index: dict) -> list[tuple[int, int, int, int]]:
    """(text, piece, begin, end) of the bands that share enough q-grams with a piece; places count within the text."""
    sizes = np.array([len(x) for x in texts])
    joined = "\0".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if len(codes) < Q:
        return []
    gram = gram_codes(codes)
    at = np.flatnonzero(index["table"][_slot(gram)])
    entry = np.minimum(np.searchsorted(index["distinct"], gram[at]), len(index["distinct"]) - 1)
    same = index["distinct"][entry] == gram[at]
    at, entry = at[same], entry[same]
    many = index["count"][entry]
    if not len(at):
        return []
    begins = np.cumsum(many) - many
    post = np.arange(many.sum()) - np.repeat(begins - index["first"][entry], many)
    here, piece, place = np.repeat(at, many), index["piece"][post], index["place"][post]
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.searchsorted(starts, here, side="right") - 1
    step = index["most"][piece] + 1
    diagonal = here - starts[text] - place + PIECE
    band = diagonal // step
    text, piece, place, step = (np.concatenate([x, x]) for x in (text, piece, place, step))
    votes = np.unique(np.column_stack([text, piece, np.concatenate([band, band - 1]), place]), axis=0)
    groups, first, count = np.unique(votes[:, :3], axis=0, return_index=True, return_counts=True)
    kept = groups[count >= index["least"][groups[:, 1]]]
    out = []
    for t, p, b in kept.tolist():
        most = int(index["most"][p])
        begin = b * (most + 1) - PIECE
        end = begin + 2 * (most + 1) + len(index["texts"][p]) + most
        out.append((t, p, max(begin - most, 0), min(end, int(sizes[t]))))
    return out


def found(texts: list[str], index: dict) -> list[dict]:
    """For each text the items found in it: item -> (first begin, last end, pieces found, fewest edits)."""
    out: list[dict] = [{} for _ in texts]
    for t, p, begin, end in regions(texts, index):
        hit = best_place(index["texts"][p], texts[t][begin:end], int(index["most"][p]))
        if hit:
            edits, a, b = hit[0], begin + hit[1], begin + hit[2]
            for item in index["items"][p]:
                have = out[t].setdefault(item, [a, b, set(), edits])
                have[0], have[1], have[3] = min(have[0], a), max(have[1], b), min(have[3], edits)
                have[2].add(p)
    return out


def piece_blocks(benchmark: DataFrame, item: str = "item_id", passage: str = "text") -> Iterator[list[tuple[list, str]]]:
    """Different pieces of all items, each with the items that hold it, some at a time.

    The pieces are counted first and dealt to as many blocks as they ask for; each block comes to the driver when it is its turn.
    """
    kind = benchmark.schema[item].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            found = [(i, p) for i, t in enumerate(batch.column("passage")) for _, p in pieces(t.as_py())]
            items = batch.column("item").take(pa.array([i for i, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([items, pa.array([p for _, p in found], pa.string())], names=["item", "piece"])

    named = benchmark.select(F.col(f"`{item}`").alias("item"), F.col(f"`{passage}`").alias("passage"))
    every = computed(named.mapInArrow(cut, f"item {kind}, piece string").distinct())
    blocks = max(1, -(-every.count() // BLOCK_PIECES))
    for block in range(blocks):
        held: dict[str, list] = {}
        for row in every.where(F.pmod(F.xxhash64("piece"), F.lit(blocks)) == block).toLocalIterator():
            held.setdefault(row["piece"], []).append(row["item"])
        if held:
            yield [(sorted(held[p], key=str), p) for p in sorted(held)]


def leaks(benchmark: DataFrame, block: list[tuple[list, str]], text: Column, item: str = "item_id") -> Column:
    """Items of a block of pieces found in a text column, as an array of (item, begin, end, pieces, edits)."""
    result = f"array<struct<item:{benchmark.schema[item].dataType.simpleString()},begin:long,end:long,pieces:long,edits:long>>"
    shared = benchmark.sparkSession.sparkContext.broadcast(Index([i for i, _ in block], [p for _, p in block]).arrays())
    return F.pandas_udf(_scan(shared), result)(F.coalesce(text, F.lit("")))


def _scan(shared):
    def scan(texts: pd.Series) -> pd.Series:
        values = [plain(x) for x in texts]
        out = []
        for a, b in slices(values):
            for hits in found(values[a:b], shared.value):
                out.append([{"item": i, "begin": h[0], "end": h[1], "pieces": len(h[2]), "edits": h[3]} for i, h in hits.items()])
        return pd.Series(out, dtype=object)

    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """A row for each row of ``docs`` and item found in it: the keys, item_id, begin, end, pieces, edits.

    A benchmark of several blocks is looked for in one pass over ``docs`` for each, of which only the hits are kept.
    """
    kept = [F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), *kept, F.col(f"`{text}`").alias("_text"))
    hit = [F.col("_hit.item").alias("item_id"), *[F.col(f"_hit.{c}").alias(c) for c in ("begin", "end", "pieces", "edits")]]
    passes, own = [], [f"_key{i}" for i in range(len(keys))]
    for block in piece_blocks(benchmark):
        each = numbered.select("_row", *own, F.explode(leaks(benchmark, block, F.col("_text"))).alias("_hit")).select("_row", *own, *hit)
        passes.append(each if not passes else computed(each))
        if len(passes) == 2:
            passes[0] = computed(passes[0])
    if not passes:
        found = numbered.select("_row", *own, *[F.lit(None).cast(t).alias(c) for c, t in [("item_id", benchmark.schema["item_id"].dataType), *[(c, "long") for c in ("begin", "end", "pieces", "edits")]]]).limit(0)
    else:
        found = passes[0]
    if len(passes) > 1:
        for more in passes[1:]:
            found = found.union(more)
        found = found.groupBy("_row", *own, "item_id").agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.sum("pieces").alias("pieces"), F.min("edits").alias("edits"))
    return found.select(*[F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)], "item_id", "begin", "end", "pieces", "edits")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows in which no item is found, unchanged.

    A benchmark of several blocks takes a pass for each; rows that a pass drops are not looked at by the next.
    """
    rows = docs
    for n, block in enumerate(piece_blocks(benchmark)):
        rows = computed(rows) if n else rows
        rows = rows.where(F.size(leaks(benchmark, block, F.col(f"`{text}`"))) == 0)
    return rows

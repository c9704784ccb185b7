"""Ranked lexical search: the best documents for each item, by the Best Position Algorithm.

Items are taken in blocks of bounded size.  For each block

1. every document is read once; what is kept of it is its number of terms and how often the block's terms occur in it;
2. the numbers of documents and terms, and of documents for each of the block's terms, are summed over all documents;
3. each task makes impact lists (the documents of a term by falling share of the score) of the documents it holds, some
   ``POSTINGS`` entries at a time, and searches them for every item.  All lists of an item are read in step; a document met
   is scored by direct access to the other lists, which also tells its place there.  The *best position* of a list is the
   last one before its first unseen place, and an unseen document scores at most the sum of the lists' entries at their
   best positions.  The search of a part stops once that sum is strictly below the worst of the best k, those of
   the task's earlier parts included, so that no tie is lost;
4. the best of all tasks are ranked.  A task gives k rows for each item at most.

Only terms of items are indexed, as no other can score.

* A null text has no terms; a document without terms counts nowhere.  An item without terms finds nothing.
* Every row is a document and every row of the items an item, also if ids are repeated or null; documents without id come
  last among equal scores, and the order of rows that share id and score means nothing.
* The weight is in doubles, all else in 64-bit integers.  A term that stands in all documents may weigh 0; a document needs
  a score above 0 to be found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import computed

#: ASCII characters that are no part of a term; everything from U+0080 on is.
_SEPARATORS = bytes(x for x in range(128) if not chr(x).isalnum())
_FOLD = bytes.maketrans(_SEPARATORS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz")
#: Items and distinct terms of a block of items; a block is one pass over the documents.
BLOCK_ITEMS, BLOCK_TERMS = 2000, 100_000
#: Entries of impact lists that a task holds at a time.
POSTINGS = 2_000_000
#: Entries read from each list in the first step; a step reads twice as many as the one before.
STEP = 16
_AHEAD = np.arange(64)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _counted(wanted: dict[bytes, int]):
    """Rows (key, n, terms, counts): the last two hold numbers of wanted terms and their occurrences."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            at, n, found, often = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                count = Counter(terms(text.as_py()))
                if count:
                    own = [(wanted[x], c) for x, c in count.items() if x in wanted]
                    at.append(i)
                    n.append(count.total())
                    found.append(np.array([x for x, _ in own], np.int32).tobytes())
                    often.append(np.array([c for _, c in own], np.int64).tobytes())
            columns = [batch.column("key").take(pa.array(at, pa.int64())), pa.array(n, pa.int64()), pa.array(found, pa.binary()), pa.array(often, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n", "terms", "counts"])

    return run


def _documents_of_terms(batches):
    for batch in batches:
        found = np.concatenate([np.frombuffer(x.as_py(), np.int32) for x in batch.column("terms")] or [np.zeros(0, np.int32)])
        term, n = np.unique(found, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(n, pa.int64())], names=["term", "n"])


class ImpactLists:
    """Impact lists of some documents, with direct access from (term, document) to share and place."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, documents: int):
        order = np.lexsort((owner, term))
        term, self.owner, self.impact = term[order].astype(np.int64), owner[order], impact[order]
        self.documents = documents
        self.key = term * documents + self.owner
        self.ranked = np.lexsort((self.owner, -self.impact, term))
        self.place = np.empty(len(term), np.int64)
        self.place[self.ranked] = np.arange(len(term))
        self.term = term

    def best(self, wanted: np.ndarray, k: int, bar: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) among which all of the best k are that score over ``bar`` or as much."""
        begin, end = np.searchsorted(self.term, wanted), np.searchsorted(self.term, wanted, "right")
        wanted, begin, end = wanted[begin < end], begin[begin < end], end[begin < end]
        if not len(wanted):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen_place = np.zeros(len(self.key), bool)
        seen = np.zeros(self.documents, bool)
        documents, scores = [], []
        held = np.zeros(0, np.int64)
        read, position, step = begin.copy(), begin.copy(), STEP
        while True:
            # Sorted access to the next entries of every list.
            at = read[:, None] + np.arange(step)
            at = at[at < end[:, None]]
            read = np.minimum(read + step, end)
            step *= 2
            fresh = np.unique(self.owner[self.ranked[at]])
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            # Direct access to all lists for the documents just met.
            asked = (wanted[:, None] * self.documents + fresh).ravel()
            hit = np.minimum(np.searchsorted(self.key, asked), len(self.key) - 1)
            there = self.key[hit] == asked
            share = np.where(there, self.impact[hit], 0).reshape(len(wanted), -1).sum(axis=0)
            seen_place[self.place[hit[there]]] = True
            documents.append(fresh)
            scores.append(share)
            held = np.concatenate((held, share))
            if len(held) > k:
                held = np.partition(held, len(held) - k)[-k:]
            # Best positions: the first place of each list that was not seen, by either access.
            position = np.maximum(position, read)
            moving = np.flatnonzero(position < end)
            while len(moving):
                window = position[moving, None] + _AHEAD
                known = (window < end[moving, None]) & seen_place[np.minimum(window, len(seen_place) - 1)]
                far = np.where(known.all(axis=1), len(_AHEAD), known.argmin(axis=1))
                position[moving] += far
                moving = moving[far == len(_AHEAD)]
            open_ = position < end
            if not open_.any():
                break
            most = int(self.impact[self.ranked[position[open_] - 1]].sum())
            kth = max(bar, int(held.min()) if len(held) == k else 0)
            if most < kth:
                break
        return np.concatenate(documents), np.concatenate(scores)


def _searched(items: list[tuple[object, np.ndarray]], first: int, k: int, weight: np.ndarray, total: int, length: int, names: tuple, out):
    """Search a task's documents; rows (item_row, item_id, key, score)."""

    def order(entry):
        return -entry[0], entry[1] is None, 0 if entry[1] is None else entry[1]

    def search(part: list[pa.RecordBatch], best: list[list]) -> None:
        table = pa.Table.from_batches(part)
        found = [np.frombuffer(x.as_py(), np.int32) for x in table.column("terms")]
        size = np.array([len(x) for x in found], np.int64)
        term = np.concatenate(found)
        often = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column("counts")])
        # Documents are numbered in the order of their ids, so that ties fall as the ranking has them.
        ranked = pc.sort_indices(table.column("key"), null_placement="at_end").to_numpy()
        number = np.empty(len(ranked), np.int64)
        number[ranked] = np.arange(len(ranked))
        m = 100 - 50 + 50 * table.column("n").to_numpy() * total // length
        owner = np.repeat(np.arange(len(size)), size)
        impact = weight[term] * (1_000_000_000 * often // (1000 * often + 20 * m[owner]))
        lists = ImpactLists(number[owner], term, impact, len(size))
        for row, (_, wanted) in enumerate(items):
            bar = best[row][-1][0] if len(best[row]) == k else 0
            documents, scores = lists.best(wanted, k, bar)
            good = np.flatnonzero(scores > 0)
            top = good[np.lexsort((documents[good], -scores[good]))[:k]]
            keys = table.column("key").take(pa.array(ranked[documents[top]])).to_pylist()
            best[row] = sorted([*best[row], *zip(scores[top].tolist(), keys)], key=order)[:k]

    def run(batches: Iterator[pa.RecordBatch]):
        best: list[list] = [[] for _ in items]
        part, held = [], 0
        for batch in batches:
            if batch.num_rows:
                part.append(batch)
                held += sum(len(x.as_py()) for x in batch.column("terms")) // 4 + batch.num_rows
            if held >= POSTINGS:
                search(part, best)
                part, held = [], 0
        if part:
            search(part, best)
        for row, entries in enumerate(best):
            if entries:
                columns = [[first + row] * len(entries), [items[row][0]] * len(entries), [x for _, x in entries], [s for s, _ in entries]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """Items as (id, distinct terms), some at a time."""
    block, known = [], set()
    for row in items.toLocalIterator():
        own = sorted(set(terms(bytes(row["text"]))))
        if block and (len(block) >= BLOCK_ITEMS or len(known | set(own)) > BLOCK_TERMS):
            yield block
            block, known = [], set()
        block.append((row["item"], own))
        known |= set(own)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text", item: str = "item_id") -> DataFrame:
    """(item_row, item, rank, key, score): the ``k`` documents with the highest score above 0 for each row of ``items``.

    ``item_row`` numbers the rows of ``items``.
    """
    spark = docs.sparkSession

    def body(name: str):
        return F.coalesce(F.col(f"`{name}`"), F.lit("")).cast("binary").alias("text")

    own = docs.select(F.col(f"`{key}`").alias("key"), body(text))
    key_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, key), (items, item)))
    schema = f"item_row long, item {item_type}, key {key_type}, score long"
    out = pa.schema([("item_row", pa.int64()), ("item", _arrow(items, item)), ("key", _arrow(docs, key)), ("score", pa.int64())])
    results, first = [], 0
    for block in _blocks(computed(items.select(F.col(f"`{item}`").alias("item"), body(text)))):
        wanted = {x: i for i, x in enumerate(sorted({t for _, ts in block for t in ts}))}
        counted = computed(own.mapInArrow(_counted(wanted), f"key {key_type}, n long, terms binary, counts binary"))
        sums = counted.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        if not sums["documents"]:
            continue
        df = np.zeros(len(wanted), np.int64)
        # One row for each term of the block, whatever the number of documents.
        for row in counted.mapInArrow(_documents_of_terms, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
            df[row["term"]] = row["n"]
        weight = np.array([math.floor(1000 * math.log((2 * sums["documents"] + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        numbered = [(name, np.array([wanted[x] for x in ts], np.int64)) for name, ts in block]
        found = counted.mapInArrow(_searched(numbered, first, k, weight, sums["documents"], sums["length"], (item, key), out), schema)
        results.append(computed(found))
        first += len(block)
    if not results:
        return spark.createDataFrame([], f"item_row long, item {item_type}, rank int, key {key_type}, score long")
    every = results[0]
    for more in results[1:]:
        every = every.union(more)
    best = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_row", "item", "rank", "key", "score")


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)

"""Reading, text and identity helpers shared by the operators.

Rules that hold for every operator of this package:

* the text column may be null and then counts as the empty text;
* an operator reads only the columns it names, so extra columns of any name do no harm;
* the row order of a table means nothing; ties are broken by values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import tune

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
#: Characters of text that a task works on at a time; bounds the arrays built from it.
SLICE_CHARS = 500_000


#: Rows that go to a Python worker at a time; texts are long, so that fewer than Spark's default bound its memory.
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: str = "text") -> Column:
    return F.coalesce(F.col(f"`{text}`"), F.lit(""))


def slices(texts: list, limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of together about ``limit`` characters; a longer text stands alone."""
    begin = size = 0
    for i, x in enumerate(texts):
        if size and size + len(x) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(texts):
        yield begin, len(texts)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finishing steps of a well-known integer hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    step = np.full(max(n - 1, 0), base, np.uint64)
    np.multiply.accumulate(step, out=out[1:]) if n > 1 else None
    return out


class Words:
    """Words of several texts in one buffer: hash, place and text of every word."""

    _BASE = 0x9E3779B97F4A7C15
    _IS_SPACE = np.zeros(256, bool)
    _IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

    def __init__(self, texts: list[bytes]):
        sizes = np.array([len(x) for x in texts], np.int64)
        data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        gap = self._IS_SPACE[raw]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], gap)).astype(np.int8)))
        self.data, self.start, self.end = data, edge[0::2], edge[1::2]
        self.text_end = np.cumsum(sizes + 1) - 1
        self.text_start = self.text_end - sizes
        first = np.searchsorted(self.start, self.text_start)
        self.first = np.append(first, len(self.start))
        self.count = np.diff(self.first)
        self.hash = self._hashes(raw)

    def _hashes(self, raw: np.ndarray) -> np.ndarray:
        """A polynomial in the word's bytes, then mixed with its length."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        total = int(length.sum())
        ends = np.cumsum(length)
        inside = np.arange(total) - np.repeat(ends - length, length)
        value = (raw[np.repeat(self.start, length) + inside].astype(np.uint64) + np.uint64(1)) * powers(self._BASE, int(length.max()))[inside]
        return mixed(np.add.reduceat(value, ends - length) + length.astype(np.uint64))

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values; runs across texts are the caller's to leave out."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mixed(total)


def encoded(texts: pd.Series) -> list[bytes]:
    return [b"" if x is None else bytes(x) for x in texts]


#: A lookup is broadcast if its rows, counted, take at most this much; else a shuffle join runs, which Spark can split.
BROADCAST_BYTES = 16 * 1024 * 1024


def joined_small(df: DataFrame, lookup: DataFrame, on: Column, how: str, row_bytes: int = 128) -> DataFrame:
    """Join a computed lookup of rows of at most ``row_bytes``; it is broadcast only if its count proves it small."""
    if lookup.count() * row_bytes <= BROADCAST_BYTES:
        return df.join(F.broadcast(lookup), on, how)
    return df.join(lookup, on, how)


#: Bits of the set of ids that may be wanted: 8 MB at most, whatever the size of the data.
FILTER_BITS = 26
#: Bits for each wanted id that a filter of few ids keeps at least; every executor has a copy of it on disk.
BITS_EACH = 64


def slot_bits(slots: DataFrame) -> np.ndarray:
    """The set of a column ``slot`` of numbers below 2 ** ``FILTER_BITS`` as bits, of fixed size."""
    parts = slots.select((F.col("slot") + 1).alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for row in parts.collect():  # as many bytes at most as there are bits; one job, not one for each partition
        raw = np.frombuffer(row["bits"], np.uint8)
        begin = (row["part"] - 1) * len(raw)  # parts are numbered from 1, and so are the slots in them
        bits[begin : begin + len(raw)] |= raw
    return bits


def folded(bits: np.ndarray) -> np.ndarray:
    """The set with slots modulo a smaller power of two, of which ``BITS_EACH`` bits or more remain for each one that is set."""
    most = BITS_EACH * int(np.bitwise_count(bits).sum())
    while len(bits) > 1 and 4 * len(bits) >= most:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def in_bits(bits: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots & 8 * len(bits) - 1
    return (bits[slots >> 3] >> (slots & 7).astype(np.uint8) & 1).astype(bool)


def id_filter(wanted: DataFrame, who: list[str]):
    """A function of DataFrames that tells, as a column, whether a row's ids may be among the wanted ones.

    Wanted ids always pass; of others a share that grows with the number wanted.  So rows that fail need no join, and
    the join remains for the rest.  The filter is one bit for each hash value, of a size that few ids make smaller.
    """

    def slot() -> Column:
        return F.pmod(F.xxhash64(*who), F.lit(1 << FILTER_BITS))

    shared = wanted.sparkSession.sparkContext.broadcast(folded(slot_bits(wanted.select(slot().alias("slot")))))

    def passes(slots: pd.Series) -> pd.Series:
        return pd.Series(in_bits(shared.value, slots.to_numpy()))

    return F.pandas_udf(passes, "boolean")(slot())
